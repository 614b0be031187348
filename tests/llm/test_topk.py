"""Exact top-k against brute force: values, ties, copies, lengths, very large components and edge rows."""

import math

import numpy as np
import pytest

from pitchside.llm import registry, topk
from pitchside.llm.topk import F
from tests.compare import compare, duck

SF = "/root/testdata/sf0.01"


def brute(rows, k=5, modulus=50):
    fine = {(i, tuple(e)) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)}
    fine = {(i, tuple(int(np.floor(256 * np.float64(x))) for x in e)) for i, e in fine}
    out = set()
    for q in {i for i, _ in fine if i % modulus == 0}:
        scores = {}
        for i, e in fine:
            for j, f in fine:
                if i == q and j != q:
                    s = max(topk.LEAST, min(topk.MOST, sum(a * b for a, b in zip(e, f))))
                    scores[j] = max(scores.get(j, s), s)
        out |= {(q, r + 1, j, s) for r, (j, s) in enumerate(sorted(scores.items(), key=lambda t: (-t[1], t[0]))[:k])}
    return out


def got(df):
    return {tuple(r) for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1.0, 2) for i, e in rows], "vec_id long, embedding array<double>, threshold double, shard int")


@pytest.mark.parametrize("kind", ["random", "clusters", "sparse", "ties"])
def test_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 24))
    if kind == "clusters":
        x = rng.normal(size=(7, 24))[rng.integers(0, 7, 700)] * 3 + x * 0.2
    if kind == "sparse":
        x[rng.random(x.shape) < 0.85] = 0
    if kind == "ties":
        x = np.round(x[rng.integers(0, 40, 700)]) / 64
    rows = [(int(i), [float(v) for v in r]) for i, r in zip(rng.permutation(700) * 5 - 500, x)]
    for elements in (1 << 20, 3000):
        assert got(topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, elements=elements, sampled=64)) == brute(rows)


def test_essential_tiers_skip(spark):
    """With a threshold that few reach, most rows are never looked at, and none that counts is lost."""
    rng = np.random.default_rng(5)
    x = np.floor(256 * (rng.normal(size=(20, 32))[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 32)) * 0.1))
    shard = topk.Shard(np.arange(4000), x)
    scores = x @ x[17]
    limit = np.sort(scores)[-30]
    rows, found = shard.search(x[17], limit)
    assert sorted(rows) == sorted(np.flatnonzero(scores >= limit)) and (scores[rows] == found).all()


def test_cases(spark):
    rows = [(0, [0.5, -0.25, 0.1]), (0, [0.5, -0.25, 0.1]), (0, [-1.0, 2.0]), (50, [0.0, 0.0, 0.0]), (1, []), (2, [1e200, -1e150, 3.0]),
            (100, [1e300, 1.0]), (3, None), (4, [0.1, None]), (5, [float("nan")]), (6, [float("inf"), 1.0]), (None, [1.0, 2.0]),
            (7, [0.5, -0.25, 0.1, 9.0]), (8, [-0.001]), (9, [3.0e13, 1.0, 0.1]), (9, [-3.0e13, 1.0, 0.1]), (150, [2.0 ** 45 + 1, 1.0, 1.0])]
    for copies in (1, 2):
        assert got(topk.top_k(frame(spark, rows * copies), F.col("vec_id") % 50 == 0, k=4)) == brute(rows, 4)
    alone = frame(spark, [(0, [1.0])])
    assert got(topk.top_k(alone, F.col("vec_id") % 50 == 0)) == set()
    assert got(topk.top_k(alone.limit(0), F.col("vec_id") % 50 == 0)) == set()


def test_query(spark):
    ok, told = compare(registry.QUERIES["op13_top_k"](spark, SF), duck(SF), registry.ORACLE_SQL["op13_top_k"])
    assert ok, told
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(registry.QUERIES["op13_top_k"](spark, SF)) == brute(rows)
