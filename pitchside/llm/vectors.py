"""What the two vector operators share: which vectors count, and a bounded sample of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fine(embedding: Column) -> Column:
    """Without null or non-finite components and not zero."""
    return (F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(embedding, lambda x: x != 0))


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding)``: vectors with an id, without null or non-finite components and not zero.

    Rows that repeat a ``vec_id`` count as one vector, the least.
    """
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine(F.col("embedding")))
            .groupBy("vec_id").agg(F.min("embedding").alias("embedding")))


def size_and_dimension(vectors: DataFrame) -> tuple[int, int]:
    """The most frequent length of the vectors and how many have it (of equally frequent ones the smaller)."""
    row = vectors.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return (row["count"], row["d"]) if row else (0, 0)


def unit_sample(vectors: DataFrame, n: int) -> np.ndarray:
    """At most ``n`` vectors, the first by a hash of their ids, at length one."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).select("embedding").collect()
    return unit(np.array([r["embedding"] for r in rows], dtype=np.float64))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
