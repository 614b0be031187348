"""Embedding near-duplicates by a pivot-permutation index.

Equal vectors form a class; only classes go on.  A class is described by the ordered numbers of its ``nearest`` nearest pivots,
a bounded sample of the vectors from which near neighbours of one another are left out.  Nearness to pivots is
taken after the sample's mean is subtracted, so vectors in a narrow cone have as many pivots as any.  A class is posted under each of
them; members of a pivot's list that share at least ``least_shared`` pivots are candidates, each
pair in the list of its lowest common pivot, and are verified by cosine in double precision.

How many pivots there are, how many a class is posted under and how many candidates must share is fitted on the
sample: of the settings that find ``least_recall`` of its links (of vectors turned by the link angle towards one another,
if it has few) the one whose lists compare the fewest pairs, or the one that finds most if none finds so many.
Tables of any size go through the lists; small ones have fewer pivots.

A dense group of different near copies would fill lists with pairs, so vectors within half the link angle of the middle of
such a group (a ball, at least ``1 / most_balls`` of the sample) are not posted: any two of them are linked by the triangle
inequality, and no pair of them is ever formed.  Vectors outside that may reach into a ball are those within one and a
half link angles of its middle; they are compared with its members block by block.  That part loses
no link at all.  Lists, balls and fringes longer than ``block`` are split, so a task holds two blocks.

The index covers every vector; only the pivots and the setting come from a sample (about ``sampled`` vectors).
Vectors of each length have pivots of their own; lengths beyond the ``most_lengths`` most frequent ones have one list each.
Measured recall is in the README.

Cases: vectors that are null, zero, empty or hold null or non-finite components link with nothing; vectors of different
length are not linked; repeated rows count as one vector and give a row each; different vectors under one id are vectors of their
own that share a label; a null vec_id links with nothing and stays; empty input gives empty output; other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, cut, table
from .vectors import fine, unit

#: Numbers of one length's pivots and balls lie in a range of their own.
SPAN = 1 << 20


@dataclass
class Index:
    """What the vectors of one length are described by."""

    centre: np.ndarray
    pivots: np.ndarray
    balls: np.ndarray
    nearest: int
    least_shared: int

    def turned(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors as seen from the centre, at length one (or zero)."""
        y = x - self.centre
        size = np.sqrt((y * y).sum(axis=1, keepdims=True))
        return y / np.where(size > 1e-9, size, np.inf)

    def order(self, x: np.ndarray) -> np.ndarray:
        return nearest_pivots(self.turned(x), self.pivots, self.nearest)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    near = x @ pivots.T
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1)


def spaced(x: np.ndarray, wanted: int, spread: float) -> np.ndarray:
    """Up to ``wanted`` of the vectors, in order, none within cosine ``spread`` of another; if these are few, others after them."""
    near, kept = x @ x.T > spread, []
    for i in range(len(x)):
        if len(kept) < wanted and not near[i, kept].any():
            kept.append(i)
    rest = np.setdiff1d(np.arange(len(x)), kept)
    return x[np.r_[kept, rest].astype(int)[:wanted]]


def balls_for(sample: np.ndarray, cosine: float, most_balls: int) -> np.ndarray:
    """Middles of dense groups, the densest first, further apart than the link angle."""
    near = sample @ sample.T
    inside = (near >= math.cos(math.acos(cosine) / 2)).sum(axis=1)
    kept: list[int] = []
    for i in np.argsort(-inside, kind="stable"):
        if inside[i] < max(8, len(sample) / most_balls) or len(kept) == most_balls:
            break
        if not (near[i, kept] >= cosine).any():
            kept.append(int(i))
    return sample[kept]


def fit(sample: np.ndarray, n: int, cosine: float, most_pivots: int, most_balls: int, least_recall: float, spread: float = 0.7) -> Index:
    """The index of ``n`` vectors from a sample of them, unit vectors."""
    centre = sample.mean(axis=0)
    balls = balls_for(sample, cosine, most_balls)
    free = sample
    if len(balls):
        free = sample[(sample @ balls.T).max(axis=1) < math.cos(math.acos(cosine) / 2)]
    index = Index(centre, np.zeros((1, sample.shape[1])), balls, 1, 1)
    wanted = min(most_pivots, max(16, n // 16), len(free))
    if n < 256 or wanted < 16:  # one pivot and its list
        return index
    turned = index.turned(free)
    pivots = spaced(turned, wanted, spread)
    a, b = np.nonzero(np.triu(free @ free.T >= cosine, 1))
    if len(a) >= 200:
        some = np.linspace(0, len(a) - 1, min(len(a), 4000)).astype(int)
        x, y = turned[a[some]], turned[b[some]]
    else:
        y = np.roll(free, 1, axis=0)
        y = y - (free * y).sum(axis=1, keepdims=True) * free
        size = np.sqrt((y * y).sum(axis=1, keepdims=True))
        y = cosine * free + math.sqrt(1 - cosine * cosine) * y / np.where(size > 1e-6, size, np.inf)
        x, y = turned, index.turned(y / np.sqrt((y * y).sum(axis=1, keepdims=True)))
    best = None
    for p in sorted({min(1 << e, wanted) for e in range(4, 13)}):
        most = max(2, min(64, p // 2))
        lists, ours, theirs = (nearest_pivots(z, pivots[:p], most) for z in (turned, x, y))
        for k in [k for k in (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64) if k <= most]:
            cost = float(((np.bincount(lists[:, :k].ravel(), minlength=p) / len(lists)) ** 2).sum())
            shared = np.concatenate([(ours[i:i + 500, :k, None] == theirs[i:i + 500, None, :k]).sum(axis=(1, 2)) for i in range(0, len(ours), 500)])
            for least in (1, 2):
                recall = float((shared >= least).mean())
                rank = (recall >= least_recall, -cost if recall >= least_recall else recall, least)
                if best is None or rank > best[0]:
                    best = rank, Index(centre, pivots[:p], balls, k, least)
    return best[1]


def describe(vectors: DataFrame, indexes: dict[int, tuple[int, Index]], inner: float, outer: float) -> DataFrame:
    """``vectors`` with ``order, shares, ball, reach``: nearest pivots in order, how many of them candidates must
    share, the ball the vector lies in or null, and the other balls into which it may reach."""
    shared = vectors.sparkSession.sparkContext.broadcast(indexes)  # bounded: most_lengths times most_pivots rows
    kind = vectors.schema["embedding"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                lengths = batch.column(1).value_lengths().to_numpy()
                orders, shares, ball, reach = ([None] * batch.num_rows for _ in range(4))
                for d in np.unique(lengths):
                    rows = np.flatnonzero(lengths == d)
                    if d not in shared.value:
                        for r in rows:
                            orders[r], shares[r], reach[r] = [-int(d)], 1, []
                        continue
                    number, index = shared.value[d]
                    x = unit(np.array(batch.column(1).take(pa.array(rows)).to_pylist(), dtype=np.float64))
                    near = x @ index.balls.T if len(index.balls) else np.full((len(x), 1), -2.0)
                    order, best = index.order(x) + number * SPAN, near.argmax(axis=1)
                    for r, o, b, row in zip(rows, order, best, near):
                        inside = row[b] >= inner
                        orders[r], shares[r], ball[r] = o.tolist(), index.least_shared, number * SPAN + int(b) if inside else None
                        reach[r] = [number * SPAN + int(q) for q in np.flatnonzero(row >= outer) if not (inside and q == b)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(orders, pa.list_(pa.int64())), pa.array(shares, pa.int32()), pa.array(ball, pa.int64()),
                     pa.array(reach, pa.list_(pa.int64()))], [*batch.schema.names, "order", "shares", "ball", "reach"])

    return vectors.select("vec_id", "embedding", "weight").mapInArrow(
        apply, f"vec_id long, embedding {kind}, weight long, order array<long>, shares int, ball long, reach array<long>")


FOUND = "a long, b long, n long"


def found(counts: dict, edges: set) -> pd.DataFrame:
    rows = [(a, None, n) for a, n in counts.items()] + [(a, b, 0) for a, b in edges]
    return pd.DataFrame(rows, columns=["a", "b", "n"]).astype({"a": "int64", "b": "Int64", "n": "int64"})


def star(ids: np.ndarray, linked: np.ndarray) -> set:
    """Edges that connect what ``linked`` connects, one for each vector beyond the first of its group."""
    root = np.arange(len(ids))
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], len(ids)).min(axis=1, initial=len(ids)))
        new = new[new]
        if (new == root).all():
            return {(int(ids[i]), int(ids[r])) for i, r in enumerate(root) if i != r}
        root = new


def blocks(df: DataFrame, key: str, block: int) -> DataFrame:
    """``df`` with the number of blocks of its key's rows and the row's own."""
    per = df.groupBy(key).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    return df.join(per, key).withColumn("_own", F.pmod(F.xxhash64("vec_id"), F.col("_blocks")).cast("int"))


def links_in_lists(free: DataFrame, cosine: float, block: int) -> DataFrame:
    """Links among classes outside balls, as counts per class and edges that connect them."""
    posted = free.select("vec_id", "embedding", "weight", "order", "shares", F.explode("order").alias("pivot"))
    dealt = (blocks(posted, "pivot", block).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")}))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, own, here = pdf["vec_id"].to_numpy(), pdf["_own"].to_numpy(), pdf["pivot"].iat[0]
        order = np.stack(pdf["order"].to_numpy())
        names, place = np.unique(order, return_inverse=True)
        member = np.zeros((len(ids), len(names)), dtype=np.float32)
        np.put_along_axis(member, place.reshape(order.shape), 1, axis=1)
        x = unit(np.stack(pdf["embedding"].to_numpy()))
        lower = member[:, names < here]
        across = own[:, None] != own[None, :] if pdf["_i"].iat[0] != pdf["_j"].iat[0] else ~np.eye(len(ids), dtype=bool)
        linked = (x @ x.T >= cosine) & across & (member @ member.T >= pdf["shares"].iat[0]) & (lower @ lower.T == 0)
        n = linked @ pdf["weight"].to_numpy()
        return found({int(ids[i]): int(n[i]) for i in np.flatnonzero(n)}, star(ids, linked) if n.any() else set())

    return dealt.groupBy("pivot", "_i", "_j").applyInPandas(verify, FOUND)


def links_with_balls(described: DataFrame, heads: DataFrame, cosine: float, block: int) -> DataFrame:
    """Links between members of balls and classes outside them, exactly.

    Each class counts the members it links with; a member counts only classes outside all balls, as
    those inside another ball count it themselves.
    """
    members = blocks(described.where("ball is not null").select("vec_id", "embedding", "weight", F.col("ball").alias("pivot")), "pivot", block)
    fringe = described.select("vec_id", "embedding", "weight", F.col("ball").isNull().alias("outside"), F.explode("reach").alias("pivot"))
    fringe = blocks(fringe.join(heads, "pivot"), "pivot", block)
    m = members.groupBy("pivot").agg(F.first("_blocks").alias("_m"))
    f = fringe.groupBy("pivot").agg(F.first("_blocks").alias("_f"))
    members = (members.join(f, "pivot").withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_f") - 1)))
               .select("pivot", F.col("_own").alias("_i"), "_j", "vec_id", "embedding", "weight", F.lit(None).cast("boolean").alias("outside"),
                       F.lit(None).cast("long").alias("head")))
    fringe = (fringe.join(m, "pivot").withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
              .select("pivot", "_i", F.col("_own").alias("_j"), "vec_id", "embedding", "weight", "outside", "head"))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        inside = pdf["outside"].isna().to_numpy()
        ids, head = pdf["vec_id"].to_numpy(), pdf["head"].to_numpy()
        if inside.all() or not inside.any():
            return found({}, set())
        x = unit(np.stack(pdf["embedding"].to_numpy()))
        linked = x[~inside] @ x[inside].T >= cosine
        weight = pdf["weight"].to_numpy()
        outer, n = np.flatnonzero(~inside), linked @ weight[inside]
        counts = {int(ids[i]): int(k) for i, k in zip(outer, n) if k}
        free = pdf["outside"].to_numpy()[outer].astype(bool)
        for i, k in zip(np.flatnonzero(inside), weight[outer][free] @ linked[free]):
            if k:
                counts[int(ids[i])] = counts.get(int(ids[i]), 0) + int(k)
        return found(counts, {(int(ids[i]), int(head[i])) for i, k in zip(outer, n) if k})

    return members.union(fringe).groupBy("pivot", "_i", "_j").applyInPandas(verify, FOUND)


def same(embedding: str = "embedding") -> list[Column]:
    """128 bits that tell vectors apart."""
    return [F.xxhash64(embedding).alias("one"), F.xxhash64(F.lit(1), F.reverse(embedding), F.size(embedding)).alias("two")]


def samples(classes: DataFrame, sampled: int, most_lengths: int) -> dict[int, tuple[int, np.ndarray]]:
    """Of each of the most frequent lengths how many classes have it, and unit vectors of its share of ``sampled`` and 64 more."""
    rows = classes.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(most_lengths).collect()
    total = sum(r["count"] for r in rows)
    if not total:
        return {}
    share = F.create_map(*[F.lit(x) for r in rows for x in (r["d"], 64 + sampled * r["count"] // total)])
    order = Window.partitionBy("d").orderBy(F.xxhash64("one", "two"), "one", "two")
    picked = (classes.withColumn("d", F.size("embedding")).withColumn("n", F.row_number().over(order)).where(F.col("n") <= sampled + 64)
              .where(F.col("n") <= F.element_at(share, F.col("d"))).select("d", "embedding").collect())
    return {r["d"]: (r["count"], unit(np.array([p["embedding"] for p in picked if p["d"] == r["d"]], dtype=np.float64))) for r in rows}


def embedding_duplicates(vectors: DataFrame, cosine: float = 0.9, most_pivots: int = 2048, block: int = 2000, least_recall: float = 0.995,
                         sampled: int = 4096, most_balls: int = 256, most_lengths: int = 64) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row for each row of ``vectors``."""
    vectors = vectors.select("vec_id", "embedding")
    good = vectors.where(F.col("vec_id").isNotNull()).where(fine(F.col("embedding")))
    angle = math.acos(cosine)
    # the numbers are fixed with the checkpoint
    classes = cut(good.select("vec_id", "embedding", *same()).dropDuplicates(["vec_id", "one", "two"]).groupBy("one", "two")
                  .agg(F.first("embedding").alias("embedding"), F.count("*").alias("weight"), F.min("vec_id").alias("least"))
                  .withColumn("id", F.monotonically_increasing_id()))
    indexes = {d: (k, fit(x, n, cosine, most_pivots, most_balls, least_recall))
               for k, (d, (n, x)) in enumerate(samples(classes, sampled, most_lengths).items())}
    described = cut(describe(classes.select(F.col("id").alias("vec_id"), "embedding", "weight"), indexes,
                             math.cos(angle / 2) + 1e-9, math.cos(1.5 * angle) - 1e-9))
    heads = cut(described.where("ball is not null").groupBy(F.col("ball").alias("pivot")).agg(
        F.min("vec_id").alias("head"), F.sum("weight").alias("members")))  # a row per ball
    links = cut(links_in_lists(described.where("ball is null"), cosine, block).union(
        links_with_balls(described, heads.select("pivot", "head"), cosine, block)))
    counts = links.where("b is null").groupBy(F.col("a").alias("vec_id")).agg(F.sum("n").alias("n"))
    nodes = cut(described.join(heads, described["ball"] == heads["pivot"], "left").select(
        "vec_id", F.coalesce("head", "vec_id").alias("node"), (F.coalesce("members", "weight") - 1).alias("inside")))
    edges = links.where("b is not null").select("a", "b")
    edges = edges.join(nodes.select(F.col("vec_id").alias("a"), "node"), "a").select(F.col("node").alias("a"), "b")
    parts = components(nodes.select(F.col("node").alias("id")).distinct(), edges).withColumnRenamed("id", "node")
    labels = (classes.select("one", "two", "least", F.col("id").alias("vec_id")).join(nodes, "vec_id").join(counts, "vec_id", "left").join(parts, "node")
              .select("one", "two", "least", "component", (F.col("inside") + F.coalesce("n", F.lit(0))).alias("n_links")))
    labels = labels.join(labels.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("one", "two", "n_links", "component_id")

    # a class may hold a third of all rows: rows are spread over salts
    usable = F.coalesce(F.col("vec_id").isNotNull() & fine(F.col("embedding")), F.lit(False))
    rows = vectors.select("vec_id", *[F.when(usable, c).alias(n) for c, n in zip(same(), ("one", "two"))], F.pmod(F.xxhash64("vec_id"), F.lit(16)).alias("salt"))
    labels = labels.withColumn("salt", F.explode(F.expr("sequence(0L, 15L)")))
    done = rows.join(labels, ["one", "two", "salt"], "left")
    return done.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       F.coalesce("component_id", "vec_id").alias("component_id"),
                       F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"))


def op3_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"))
