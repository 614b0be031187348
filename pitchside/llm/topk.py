"""Exact top-k search by inner product with MaxScore over tiers of posting lists.

Components become integers (``floor(scale * x)``), so scores are exact.  Candidates are dealt into shards by a hash of their ids.  In a
shard each dimension is a posting list in order of impact, cut into ``TIERS`` tiers; a query's terms are the
tiers, each bounded by what its best member adds to the score.  A query's terms are split by these bounds: the
non-essential tiers are those with the smallest bounds, as many as together stay below
the query's threshold, so a candidate without an essential tier cannot enter the result.  Only essential tiers are
traversed, adding what each member has beyond the non-essential bound of its dimension; candidates that are still
competitive are probed in the other dimensions, block by block, the widest first, and drop out when their bound
falls below the threshold.  What has been probed everywhere has its exact score.  Shards return at most ``k`` rows a query, and
the shards' rows are merged.

A query's threshold is its k-th best score in a bounded sample of the candidates: a lower bound of the final one, so no result
depends on the sample.  Shards and blocks of queries hold about ``elements`` components, so a task holds one of
either; candidates are sent once to every block of queries, a product that grows with queries times
candidates by nature.

Cases: vectors that are null or hold null or non-finite components, and rows without id, take no part; zero and empty vectors do; of
vectors of different length the components that both have count, as if the shorter ended in zeros; repeated rows
count once, and where one id has several vectors its best one counts, as query and as candidate; a query is
no candidate of its own id; ties go to the smaller vec_id; fewer than ``k`` candidates give fewer rows; sums past 53 bits are
taken with integers of any size, and a score outside the long range is given as that range's end;
empty input gives empty output; other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

TIERS = 16
#: A dimension with more than one in so many tiers essential is read whole, as a column: most rows are in its postings.
FULL = 4
#: Dimensions probed between two looks at the threshold.
PROBED = 8
#: Sums of integers below this are exact in double precision.
EXACT = float(1 << 52)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def whole(rows: list, scale: float) -> np.ndarray:
    """Vectors of one length as a matrix of whole numbers."""
    return np.floor(scale * np.array(rows, dtype=np.float64).reshape(len(rows), -1))


def by_length(vectors: pa.Array, scale: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length among the vectors: which rows have it, and their matrix."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    return [(at, whole(vectors.take(pa.array(at)).to_pylist(), scale))
            for at in (np.flatnonzero(lengths == n) for n in np.unique(lengths))]


def exact(query: np.ndarray, most: float) -> bool:
    """Whether sums over vectors with components up to ``most`` are exact in double precision."""
    return len(query) * max(float(np.abs(query).max(initial=0)), 1) * max(most, 1) < EXACT


def plain_scores(query: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Scores as integers of any size."""
    q = [int(v) for v in query]
    return np.array([sum(a * int(b) for a, b in zip(q, row)) for row in x], dtype=object)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best, an id once; ties to the smaller id."""
    order = np.lexsort((ids, -scores)) if scores.dtype != object else np.array(
        sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), dtype=int)
    first = np.sort(np.unique(ids[order], return_index=True)[1])[:k]
    return ids[order[first]], scores[order[first]]


class Shard:
    """Posting lists of vectors of one length, in tiers of ascending components."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x, n = ids, x, len(x)
        self.most = float(np.abs(x).max(initial=0))
        self.order = np.argsort(x, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(x.T, self.order, 1)
        tiers = min(TIERS, n)
        self.edge = np.arange(tiers + 1) * n // tiers
        self.low, self.high = self.values[:, self.edge[:-1]], self.values[:, self.edge[1:] - 1]

    def search(self, query: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows that score ``threshold`` or more and their scores; ``query`` is no longer than the vectors."""
        dims = np.flatnonzero(query)
        q = query[dims]
        # of every dimension the bounds of its tiers, the weakest tier first
        up = q[:, None] * self.high[dims]
        down = q[:, None] * self.low[dims, ::-1]
        bounds = np.where(q[:, None] > 0, up, down)
        tiers = bounds.shape[1]
        gain = np.diff(bounds, axis=1)
        order = np.argsort((bounds[:, 1:] - bounds[:, :1]).ravel(), kind="stable")
        spent = bounds[:, 0].sum() + np.cumsum(gain.ravel()[order])
        idle = order[:int(np.searchsorted(spent, threshold, side="left"))]  # non-essential terms
        cut = np.bincount(idle // max(tiers - 1, 1), minlength=len(dims)) + 1  # the first essential tier of a dimension
        rest = bounds[np.arange(len(dims)), cut - 1]  # the most that non-essential tiers add
        full = tiers - cut > tiers // FULL
        query = np.zeros(self.x.shape[1])
        query[dims[full]] = q[full]
        total = self.x @ query + rest[~full].sum()
        for i in np.flatnonzero(~full & (cut < tiers)):
            d = dims[i]
            members = slice(self.edge[cut[i]], None) if q[i] > 0 else slice(None, self.edge[tiers - cut[i]])
            total[self.order[d, members]] += q[i] * self.values[d, members] - rest[i]
        kept = np.flatnonzero(total >= threshold)
        total = total[kept]
        others = np.flatnonzero(~full)
        others = others[np.argsort((bounds[:, 0] - rest)[others], kind="stable")]
        for k in range(0, len(others), PROBED):
            now = others[k:k + PROBED]
            total = total + np.minimum(self.x[np.ix_(kept, dims[now])] * q[now] - rest[now], 0).sum(axis=1)
            fine = total >= threshold
            kept, total = kept[fine], total[fine]
        return kept, total

    def top(self, query: np.ndarray, query_id: int, threshold: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        query = query[:self.x.shape[1]]
        if not exact(query, self.most):
            rows, scores = np.arange(len(self.x)), plain_scores(query, self.x)
        elif len(query) and query.any():
            rows, scores = self.search(query, threshold)
        else:
            rows, scores = np.arange(len(self.x)), np.zeros(len(self.x))
        other = self.ids[rows] != query_id
        return best(self.ids[rows[other]], scores[other], k)


def part_takers(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` of the rows that take part, equal ones once."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).distinct()


def with_thresholds(queries: DataFrame, sample: list, k: int, scale: float) -> DataFrame:
    """``queries`` with the k-th best score in the sample, or minus infinity if it has too few."""
    shared = queries.sparkSession.sparkContext.broadcast(sample)  # bounded, see top_k

    def apply(batches):
        ids = np.array([r[0] for r in shared.value], dtype=np.int64)
        offered = [(ids[at], x) for at, x in by_length(pa.array([r[1] for r in shared.value], pa.list_(pa.float64())), scale)]
        for batch in batches:
            out, own = np.full(batch.num_rows, -np.inf), batch.column(0).to_numpy()
            for at, x in by_length(batch.column(1), scale):
                for first in range(0, len(at), 256):
                    rows, some = at[first:first + 256], x[first:first + 256]
                    scores = []
                    for names, y in offered:
                        n = min(some.shape[1], y.shape[1])
                        if n * max(np.abs(some).max(initial=0), 1) * max(np.abs(y).max(initial=0), 1) < EXACT:
                            scores.append(np.where(own[rows, None] == names, -np.inf, some[:, :n] @ y[:, :n].T))
                    if sum(s.shape[1] for s in scores) >= k:
                        out[rows] = np.partition(np.concatenate(scores, axis=1), -k, axis=1)[:, -k]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], ["vec_id", "embedding", "threshold"])

    return queries.mapInArrow(apply, "vec_id long, embedding array<double>, threshold double")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, elements: int = 1 << 20,
          sampled: int = 4096, longest_sampled: int = 512) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query the ``k`` candidates of the highest scores."""
    vectors = part_takers(vectors.select("vec_id", "embedding"))
    size = F.sum(F.size("embedding").cast("long") + 1)
    counted = vectors.agg(size.alias("all"), F.sum(F.when(is_query, F.size("embedding").cast("long") + 1)).alias("asking")).first()
    n_shards, n_blocks = (1 + int(x or 0) // elements for x in counted)
    # the sample: at most sampled * longest_sampled numbers
    sample = vectors.where(F.size("embedding") <= longest_sampled).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sampled).collect()
    sample = list({r["vec_id"]: tuple(r) for r in sample}.values())  # an id counts once
    deal = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = with_thresholds(vectors.where(is_query), sample, k, scale)
    asked = (queries.withColumn("block", deal(n_blocks, 1)).withColumn("shard", every(n_shards))
             .select("shard", "block", "vec_id", "embedding", "threshold"))
    offered = (vectors.withColumn("shard", deal(n_shards, 2)).withColumn("block", every(n_blocks))
               .select("shard", "block", "vec_id", "embedding", F.lit(None).cast("double").alias("threshold")))

    def search(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asks = group["threshold"].is_valid().to_numpy(zero_copy_only=False)
        ask, offer = group.filter(pa.array(asks)), group.filter(pa.array(~asks))
        out: list[tuple] = []
        if ask.num_rows and offer.num_rows:
            ids = offer["vec_id"].to_numpy()
            shards = [Shard(ids[at], x) for at, x in by_length(offer["embedding"].combine_chunks(), scale)]
            who, limits = ask["vec_id"].to_numpy(), ask["threshold"].to_numpy()
            for at, x in by_length(ask["embedding"].combine_chunks(), scale):
                for row, query in zip(at, x):
                    for s in shards:
                        out += [(int(who[row]), int(v), max(LEAST, min(MOST, int(w)))) for v, w in zip(*s.top(query, who[row], limits[row], k))]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    found = asked.union(offered).groupBy("shard", "block").applyInArrow(search, "query_id long, vec_id long, score long")
    merged = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(list_inner_product(q.e, c.e))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id GROUP BY ALL),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""
