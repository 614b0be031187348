"""Near-duplicates against exhaustive comparison of shingle sets."""

import random

import pytest

from pitchside.llm import neardup, registry

SF = "/root/testdata/sf0.01"


def sets_of(texts):
    out = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        out[i] = {b" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def brute(texts, percent):
    sets = sets_of(texts)
    ids, root = sorted(sets), {}
    index = {}
    for i in ids:
        root[i] = i
        for s in sets[i]:
            index.setdefault(s, []).append(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in {j for s in sets[i] for j in index[s] if j < i}:
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def brute_rows(rows, percent):
    """Every row is a document: ``(doc_id, set size, label, kept)``, the label being the least doc_id of the component."""
    parts, out = brute([(k, t) for k, (_, t) in enumerate(rows)], percent), []
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(parts[k][1], []).append(i)
    for k, (i, _) in enumerate(rows):
        known = [x for x in ids[parts[k][1]] if x is not None]
        label = min(known) if known else None
        out.append((i, parts[k][0], label, i == label))
    return sorted(out, key=str)


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(registry.QUERIES["op4_minhash"](spark, SF)) == brute(texts, 85)


def family(rng, size, words, edits):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [base]
    for _ in range(size):
        w = list(rng.choice(out[:1 + len(out) // 2]))
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(5000)}"
        out.append(w)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize(("percent", "block"), [(80, 2000), (85, 16)])
def test_families_with_hot_lists(spark, percent, block):
    rng = random.Random(percent)
    texts = family(rng, 250, 150, 6) + family(rng, 30, 60, 3) + [" ".join(f"u{rng.randrange(90000)}" for _ in range(80)) for _ in range(60)]
    texts += [texts[0]] * 40 + [texts[5].upper()] * 3
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = result(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent, block))
    assert got == brute(rows, percent)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (7, "a b c d e"), (8, "a b c d e"), (8, "a b c d e"),
            (9, "word " * 700000), (10, "word " * 10), (11, "É b"), (12, "é b"), (13, "x y z"), (14, "x y z"), (None, "a b"), (None, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, component_id string, n int")
    assert sorted((tuple(r) for r in neardup.near_duplicates(df, 85).collect()), key=str) == brute_rows(rows, 85)
    assert neardup.near_duplicates(df.limit(0), 85).count() == 0


LONG = " ".join(f"v{k}" for k in range(200))
#: Texts that differ under one id, copies under several ids, near copies, and copies without id.
SHARED_IDS = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "a b c d e f"), (3, "u v w x y z"), (None, "no id at all here now"), (None, "no id at all here now"),
              (None, LONG), (7, LONG + " end"), (7, LONG), (7, "quite another text of seven words"), (8, LONG + " tail"), (None, "a b c d e f"),
              (9, "quite another text of seven words"), (10, "  "), (10, None), (None, ""), (11, "only one such text is here"), (-5, "u v w x y z")]


@pytest.mark.parametrize("times", [1, 2])
def test_ids_only_label(spark, times):
    rows = SHARED_IDS * times
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in neardup.near_duplicates(df, 80).collect()), key=str) == brute_rows(rows, 80)


def test_one_of_each_loses_no_text(spark):
    rows = [(i, t, k) for k, (i, t) in enumerate(SHARED_IDS * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _digest int").repartition(3)
    kept = [tuple(r) for r in neardup.one_of_each(df, 80).collect()]
    assert set(kept) <= set(rows) and len({k for _, _, k in kept}) == len(kept)
    parts = brute([(k, t) for _, t, k in rows], 80)
    worded = [k for k in parts if parts[k][0]]
    assert sorted(parts[k][1] for _, _, k in kept if parts[k][0]) == sorted({parts[k][1] for k in worded})
    assert {k for _, _, k in kept if not parts[k][0]} == {k for k in parts if not parts[k][0]}
    for i, _, k in kept:  # the least id stands for its component
        if parts[k][0]:
            assert (i is None, i) == min(((j is None, j) for j, _, m in rows if parts[m][1] == parts[k][1]), key=lambda x: (x[0], x[1] or 0))


def test_one_of_each_labels_no_row(spark):
    """Its last plan joins classes with their components and documents with those that stay, and nothing else."""
    df = spark.createDataFrame([(i, t) for i, t in SHARED_IDS], "doc_id long, text string")
    plan = neardup.one_of_each(df, 80)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2


def test_stated_chance_of_losing_a_pair_at_the_threshold():
    from math import comb

    for percent in (80, 85):
        p = percent / 100
        lost = [sum(comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(neardup.matches_for(percent, n)))
                for n in (neardup.COORDINATES, neardup.SKETCH)]
        assert lost[0] <= 1.2e-4 and sum(lost) < 2e-4
