"""Approximate nearest neighbours by an adaptive dimension scan of probed lists.

Vectors lie in lists by their nearest centroid (spherical k-means on a bounded sample).  A query
probes the lists with the nearest centroids.  All vectors are rotated by one random rotation, so
that any block of ``COLUMNS`` columns tells about the whole distance: after s columns the distance to
a candidate is estimated as D/s times the partial one, and a hypothesis test abandons the
candidate once the estimate exceeds (1 + epsilon/sqrt(s))^2 times the query's bound.  Candidates that
survive all blocks are scored by cosine in double precision on the original vectors.

Two rounds: the first scans each query's nearest list whole, which gives its bound; the second scans
the other probed lists with that bound, lowered as each scan finds nearer ones.  A list's candidates
and the queries that probe it are dealt into blocks of ``block``, so a task holds one block of
either and a list that holds a third of all vectors is spread; each block returns at most ``k`` rows
per query.

The index holds every vector; only centroids come from a sample (``sample_size`` vectors).  Measured recall is
in the README.

Cases: vectors that are null, zero or hold null or non-finite components, or whose length is not the
most frequent one, take no part, as query or candidate; fewer than ``k`` candidates give fewer
rows; ties go to the smaller vec_id; repeated rows count as one vector; empty input gives empty
output; other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table
from .vectors import size_and_dimension, unit, unit_sample, usable

COLUMNS = 16
EPSILON = 2.1


def centroids_for(sample: np.ndarray, n: int, most_lists: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means; about one list for 100 vectors."""
    k = max(1, min(most_lists, n // 100, len(sample)))
    out = sample[:k].copy()
    for _ in range(rounds):
        near = (sample @ out.T).argmax(axis=1)
        for i in range(k):
            total = sample[near == i].sum(axis=0)
            if (total * total).sum() > 0:
                out[i] = total / np.sqrt((total * total).sum())
    return out


def rotation(dimension: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(9).normal(size=(dimension, dimension)))
    return q * np.sign(np.diag(r))


def listed(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(vec_id, embedding, lists)``: all lists, nearest centroid first."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)  # bounded: most_lists rows

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                order = np.argsort(-(unit(np.array(batch.column(1).to_pylist(), dtype=np.float64)) @ c.T), axis=1, kind="stable")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.ListArray.from_arrays(
                        pa.array(np.arange(0, order.size + 1, len(c)), pa.int32()), pa.array(order.ravel().astype(np.int32)))],
                    ["vec_id", "embedding", "lists"])

    kind = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return vectors.mapInArrow(apply, f"vec_id {kind['vec_id']}, embedding {kind['embedding']}, lists array<int>")


def survivors(queries: np.ndarray, bounds: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) of rotated unit vectors that no test abandons; bounds are squared distances."""
    d = queries.shape[1]
    q, c = np.divmod(np.arange(len(queries) * len(candidates)), len(candidates))
    partial = np.zeros(len(q))
    for first in range(0, d, COLUMNS):
        s = min(first + COLUMNS, d)
        a, b = queries[:, first:s], candidates[:, first:s]
        if first == 0:  # every pair is still there
            partial = ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T).ravel()
        else:
            gap = a[q] - b[c]
            partial = partial + (gap * gap).sum(axis=1)
        limit = bounds * (1 if s == d else s / d * (1 + EPSILON / math.sqrt(s)) ** 2) + 1e-9
        kept = partial <= limit[q]
        q, c, partial = q[kept], c[kept], partial[kept]
    return q, c


def scan(queries: DataFrame, candidates: DataFrame, k: int, block: int, turn: np.ndarray) -> DataFrame:
    """``(query_id, vec_id, score)``: at most ``k`` of each block for each query.

    ``queries`` has ``vec_id, embedding, list, bound``, ``candidates`` ``vec_id, embedding, list``.
    """
    def dealt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        per = df.groupBy("list").agg(F.ceil(F.count("*") / block).cast("int").alias("_n"))
        return df.join(per, "list").withColumn("_own", F.pmod(F.xxhash64("vec_id"), F.col("_n")).cast("int")).drop("_n"), per

    (queries, per_q), (candidates, per_c) = dealt(queries), dealt(candidates)
    spread = lambda per: F.explode(F.sequence(F.lit(0), per - 1))
    queries = queries.join(per_c, "list").select(
        "list", spread(F.col("_n")).alias("_i"), F.col("_own").alias("_j"), "vec_id", "embedding", "bound")
    candidates = candidates.join(per_q, "list").select(
        "list", F.col("_own").alias("_i"), spread(F.col("_n")).alias("_j"), "vec_id", "embedding", F.lit(None).cast("double").alias("bound"))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["bound"].notna().to_numpy()
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if asks.all() or not asks.any():
            return none
        ids = pdf["vec_id"].to_numpy()
        x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        norm = np.sqrt((x * x).sum(axis=1))
        turned = x / norm[:, None] @ turn
        at_q, at_c, bounds = np.flatnonzero(asks), np.flatnonzero(~asks), pdf["bound"].to_numpy()[asks].copy()
        out = []
        for first in range(0, len(at_q), 64):
            rows, limit = at_q[first:first + 64], bounds[first:first + 64]
            best: list[list[tuple[float, int]]] = [[] for _ in rows]
            for start in range(0, len(at_c), 512):
                cols = at_c[start:start + 512]
                q, c = survivors(turned[rows], limit, turned[cols])
                a, b = rows[q], cols[c]
                score = (x[a] * x[b]).sum(axis=1) / (norm[a] * norm[b])
                for i in np.unique(q):
                    mine = q == i
                    own = [(-s, v) for s, v in zip(score[mine], ids[b[mine]]) if v != ids[rows[i]]]
                    best[i] = sorted(best[i] + own)[:k]
                    if len(best[i]) == k:
                        limit[i] = min(limit[i], 2 + 2 * best[i][-1][0])
            out += [(ids[rows[i]], v, -s) for i, top in enumerate(best) for s, v in top]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]) if out else none

    return queries.union(candidates).groupBy("list", "_i", "_j").applyInPandas(search, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, probed: float = 0.7, least_probed: int = 8,
            most_lists: int = 128, sample_size: int = 16_384, block: int = 2000) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query its ``k`` nearest by cosine, itself left out."""
    vectors = usable(vectors.select("vec_id", "embedding"))
    n, dimension = size_and_dimension(vectors)
    if not n:
        return vectors.selectExpr("vec_id as query_id", "0 as rank", "vec_id", "0D as score").limit(0)
    vectors = vectors.where(F.size("embedding") == dimension)
    centroids = centroids_for(unit_sample(vectors, sample_size), n, most_lists)
    probes = max(min(least_probed, len(centroids)), math.ceil(probed * len(centroids)))
    turn = rotation(dimension)
    index = cut(listed(vectors, centroids))
    candidates = index.select("vec_id", "embedding", F.get("lists", F.lit(0)).alias("list"))
    queries = index.where(is_query)
    everything = 4.0  # the largest squared distance of unit vectors
    first = cut(scan(queries.select("vec_id", "embedding", F.get("lists", F.lit(0)).alias("list"), F.lit(everything).alias("bound")),
                     candidates, k, block, turn))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bounds = (first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
              .select(F.col("query_id").alias("vec_id"), (2 - 2 * F.col("score")).alias("bound")))
    others = queries.join(bounds, "vec_id", "left").select(
        "vec_id", "embedding", F.explode(F.slice("lists", 2, max(probes - 1, 1))).alias("list"),
        F.coalesce("bound", F.lit(everything)).alias("bound"))
    found = first.union(scan(others, candidates, k, block, turn))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op9_nearest(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
