"""Nearest neighbours against brute force: recall, scores, ties and edge rows."""

import numpy as np
import pytest

from pitchside.llm import ann, registry
from pitchside.llm.ann import F

SF = "/root/testdata/sf0.1"


def brute(ids, x, queries, k=5):
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for q in queries:
        s = (x * x[q]).sum(axis=1) / (norm * norm[q])
        order = [i for i in np.lexsort((ids, -s)) if i != q][:k]
        out[int(ids[q])] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        mine = out.setdefault(r["query_id"], [])
        mine.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(mine)
    return out


def recall(got, want):
    hits = sum(len({v for v, _ in got.get(q, [])} & {v for v, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows])
    got, want = found(registry.QUERIES["op9_nearest"](spark, SF)), brute(ids, x, np.flatnonzero(ids % 50 == 0))
    assert recall(got, want) >= 0.95
    place = {int(i): k for k, i in enumerate(ids)}
    for q, mine in got.items():
        a = x[place[q]].astype(np.float64)
        for v, s in mine:
            b = x[place[v]].astype(np.float64)
            assert s == pytest.approx((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum()), abs=1e-14)


def test_hot_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 64)).astype(np.float32)
    x[200:500] = x[200]  # one vector 300 times
    ids = rng.permutation(600) * 10
    df = spark.createDataFrame([(int(i), [float(v) for v in r], "q") for i, r in zip(ids, x)], "vec_id long, embedding array<float>, bound string")
    got = found(ann.nearest(df, F.col("vec_id") % 50 == 0, block=60))
    want = brute(ids, x, np.flatnonzero(ids % 50 == 0))
    hot = {int(i) for i in ids[200:500]}
    assert set(got) == set(want) and recall(got, want) >= 0.97
    for q in hot & set(want):
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]


def test_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (50, [float("nan"), 1.0]), (100, [1.0, None]),
            (150, [0.0, 1.0]), (None, [1.0, 1.0]), (200, [1.0]), (250, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(ann.nearest(df, F.col("vec_id") % 50 == 0))
    assert {q: [v for v, _ in w] for q, w in got.items()} == {0: [1, 150], 150: [0, 1]}
    assert ann.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert ann.nearest(df.where("vec_id = 150"), F.col("vec_id") % 50 == 0).count() == 0


def test_nothing_near_is_abandoned_often():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 64))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) @ ann.rotation(64)
    q, distance = x[:50], ((x[:50, None] - x[None]) ** 2).sum(axis=2)
    bound = np.sort(distance, axis=1)[:, 6]
    a, b = ann.survivors(q, bound, x)
    kept = set(zip(a.tolist(), b.tolist()))
    near = [(i, j) for i, j in zip(*np.nonzero(distance <= bound[:, None]))]
    assert np.mean([p in kept for p in near]) > 0.98 and len(kept) == sum(p in kept for p in near)
