"""Embedding near-duplicates against all pairs, dense groups, recall and edge rows."""

import numpy as np

from pitchside.llm import embdedup, registry

SF = "/root/testdata/sf0.01"


def brute(ids, x, cosine=0.9):
    x = x.astype(np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    root = np.array(ids)
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], 1 << 60).min(axis=1))
        if (new == root).all():
            break
        root = new
    return {int(i): (int(n), int(r)) for i, n, r in zip(ids, linked.sum(axis=1), root)}


def result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in row], 1) for i, row in zip(ids, x)], "vec_id long, embedding array<float>, node int")


def near(rng, base, cosine):
    z = rng.normal(size=base.shape)
    z -= (z * base).sum(axis=1, keepdims=True) * base
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return cosine * base + np.sqrt(1 - cosine ** 2) * z


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = brute([r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows]))
    assert result(registry.QUERIES["op3_embedding_dedup"](spark, SF)) == want


def test_dense_group_and_small_groups(spark):
    rng = np.random.default_rng(3)
    base = unit(rng.normal(size=(500, 64)))
    hot = near(rng, np.repeat(base[:1], 700, axis=0), 0.99)        # one ball
    wide = near(rng, np.repeat(base[:1], 60, axis=0), 0.93)        # its fringe
    loose = near(rng, np.repeat(base[1:2], 300, axis=0), 0.95)     # about the link angle wide
    small = near(rng, np.repeat(base[2:200], 2, axis=0), 0.98)
    x = np.concatenate([base, hot, wide, loose, small]).astype(np.float32)
    ids = rng.permutation(len(x)) + 7
    want = brute(ids, x)
    got = result(embdedup.embedding_duplicates(frame(spark, ids, x), block=150))
    for i in np.r_[0, 500:1200]:  # links of a ball's members are exact
        assert got[ids[i]] == want[ids[i]]
    inside = x[np.r_[0, 500:1200]].astype(float)
    for i in range(1200, 1260):  # and so are those of others with them
        assert got[ids[i]][0] >= (unit(x[i:i + 1].astype(float)) @ unit(inside).T >= 0.9).sum() and got[ids[i]][1] == want[ids[i]][1]
    total, have = sum(n for n, _ in want.values()), sum(n for n, _ in got.values())
    assert have >= 0.97 * total and all(got[i][0] <= want[i][0] for i in want)


def test_recall_near_the_limit(spark):
    rng = np.random.default_rng(4)
    base = unit(rng.normal(size=(3000, 64)))
    x = np.concatenate([base, near(rng, base[:1000], 0.905)]).astype(np.float32)
    want = brute(range(len(x)), x)
    got = result(embdedup.embedding_duplicates(frame(spark, range(len(x)), x)))
    assert sum(n for n, _ in got.values()) >= 0.95 * sum(n for n, _ in want.values())


def test_edges(spark):
    rows = [(5, [1.0, 0.0, 0.0]), (3, [2.0, 0.0, 0.0]), (3, [2.0, 0.0, 0.0]), (6, [0.0, 0.0, 0.0]), (7, None), (8, [1.0, None, 0.0]),
            (9, [float("nan"), 0.0, 1.0]), (10, [float("inf"), 0.0, 1.0]), (11, [1.0, 0.0]), (12, [0.0, 1.0, 0.0]), (13, []),
            (None, [1.0, 0.0, 0.0]), (14, [1e38, 1e30, 0.0]), (15, [-1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in embdedup.embedding_duplicates(df).collect())
    alone = {0, 6, 7, 8, 9, 10, 11, 12, 13, 15}
    assert len(got) == len(rows)
    assert [g for g in got if g[0] in alone] == [(i, 0, i, True) for i in sorted(alone)]
    assert [g for g in got if g[0] not in alone] == [(3, 2, 3, True), (3, 2, 3, True), (5, 2, 3, False), (14, 2, 3, False)]
    assert embdedup.embedding_duplicates(df.limit(0)).count() == 0
    assert {r["n_links"] for r in embdedup.embedding_duplicates(df.where("embedding is null")).collect()} == {0}


def cone(rng, n, mean):
    """Vectors whose pairs have about cosine ``mean``."""
    axis = unit(rng.normal(size=(1, 64)))
    return near(rng, np.repeat(axis, n, axis=0), np.sqrt(mean)).astype(np.float32)


def test_three_vectors(spark):
    """B and C are linked, neither is with A, whichever of them is the first pivot."""
    x = np.array([[1, 0, 0], [0.85, 0.5267827, 0], [0.85, 0.43206, 0.30139]], dtype=np.float32)
    g = unit(x.astype(float)) @ unit(x.astype(float)).T
    assert g[0, 1] < 0.86 and g[0, 2] < 0.86 and g[1, 2] > 0.94
    for ids in ((1, 2, 3), (2, 3, 1), (3, 1, 2), (10, 20, 30), (7, 5, 6)):
        assert result(embdedup.embedding_duplicates(frame(spark, ids, x))) == brute(ids, x)


def test_narrow_cones(spark):
    rng = np.random.default_rng(6)
    for mean, n in ((0.8, 2500), (0.86, 600)):
        x = cone(rng, n, mean)
        want = brute(range(n), x)
        got = result(embdedup.embedding_duplicates(frame(spark, range(n), x), block=400))
        assert sum(k for k, _ in got.values()) >= 0.95 * sum(k for k, _ in want.values()) > 0
        assert all(got[i][0] <= want[i][0] for i in want)


def test_wider_cones(spark):
    rng = np.random.default_rng(7)
    for mean in (0.4, 0.65):
        base = cone(rng, 2400, mean)
        x = np.concatenate([base, near(rng, unit(base[:600].astype(float)), 0.905)]).astype(np.float32)
        want = brute(range(len(x)), x)
        got = result(embdedup.embedding_duplicates(frame(spark, range(len(x)), x)))
        assert sum(k for k, _ in got.values()) >= 0.95 * sum(k for k, _ in want.values())


def test_settings():
    """Tables of every size and cones of every width go through lists that find the sample's links."""
    rng = np.random.default_rng(8)
    for x, n in ((unit(rng.normal(size=(4096, 64))), 100_000), (unit(rng.normal(size=(500, 64))), 500),
                 (cone(rng, 4096, 0.65).astype(float), 50_000), (cone(rng, 4096, 0.86).astype(float), 50_000)):
        index = embdedup.fit(unit(x), n, 0.9, 2048, 256, 0.98)
        assert len(index.pivots) >= 16 and 2 * index.nearest <= len(index.pivots) and not len(index.balls)
    assert len(embdedup.fit(unit(rng.normal(size=(3, 8))), 3, 0.9, 2048, 256, 0.98).pivots) == 1


def test_every_length(spark):
    """Lengths have lists of their own, the less frequent ones too, and those past the bound."""
    rng = np.random.default_rng(9)
    rows, want, at = [], {}, 0
    for d, n in ((5, 700), (2, 300), (3, 400), (1, 6), (9, 40)):
        x = unit(rng.normal(size=(n, d)))
        x[n // 2:] = near(rng, x[:n - n // 2], 0.97) if d > 1 else x[n // 2:]
        x = x.astype(np.float32)
        ids = list(range(at, at + n))
        at += n
        rows += [(i, [float(v) for v in r], 1) for i, r in zip(ids, x)]
        want |= brute(ids, x)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int")
    for most in (64, 2):
        got = result(embdedup.embedding_duplicates(df, most_lengths=most))
        assert set(got) == set(want) and all(got[i][0] <= want[i][0] for i in want)
        assert sum(n for n, _ in got.values()) >= 0.95 * sum(n for n, _ in want.values())


def test_vectors_that_share_an_id(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.0, 1.0, 0.01]), (4, [0.0, 0.0, 1.0]), (2, [1.0, 0.01, 0.0])]
    got = sorted(tuple(r) for r in embdedup.embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]


def test_one_vector_many_times(spark):
    """Equal vectors are counted, never compared."""
    rng = np.random.default_rng(10)
    x = unit(rng.normal(size=(1500, 16)))
    x[400:1400] = x[0]
    x[1400:] = near(rng, np.repeat(x[:1], 100, axis=0), 0.95)
    want = brute(range(1500), x.astype(np.float32))
    got = result(embdedup.embedding_duplicates(frame(spark, range(1500), x.astype(np.float32)), block=100))
    assert got[0][0] >= 0.97 * want[0][0] and all(got[i][0] <= want[i][0] for i in want) and got[400] == got[0]
