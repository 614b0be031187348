"""Language identification: posteriors against a plain recursion, held-out accuracy, code switching, edge rows."""

import zlib

import numpy as np

from pitchside.llm import langid, registry

SF = "/root/testdata/sf0.01"


def plain(scores, moves):
    """Posteriors by the textbook recursion in logarithms."""
    n, k = scores.shape
    lse = lambda x, axis: np.log(np.exp(x - x.max(axis=axis, keepdims=True)).sum(axis=axis)) + x.max(axis=axis)
    a, b = np.zeros((n, k)), np.zeros((n, k))
    a[0] = lse(moves, 0) + scores[0]
    for t in range(1, n):
        a[t] = lse(a[t - 1][:, None] + moves, 0) + scores[t]
    for t in range(n - 2, -1, -1):
        b[t] = lse(moves + scores[t + 1] + b[t + 1], 1)
    p = a + b
    return np.exp(p - lse(p, 1)[:, None])


def test_posteriors():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 3, 64, 65, 128, 500, 2, 1000])
    scores, moves = rng.normal(size=(lengths.sum(), 4)) * 3, rng.normal(size=(4, 4))
    got = langid.posteriors(scores, lengths, moves)
    at = 0
    for n in lengths:
        assert np.allclose(got[at:at + n], plain(scores[at:at + n], moves), atol=1e-9)
        at += n


def test_query_held_out(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = registry.QUERIES["op6_language"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.97


def test_code_switching():
    rng = np.random.default_rng(2)
    a, b = [f"th{i}ing" for i in range(40)], [f"le{i}eau" for i in range(40)]
    texts = [("en", " ".join(rng.choice(a, 200))), ("fr", " ".join(rng.choice(b, 200)))] * 20
    model = langid.learn(texts)
    assert model["moves"][0, 0] > model["moves"][0, 1]
    mixed = " ".join([*rng.choice(a, 300), *rng.choice(b, 100)])
    (lang, score, _), = langid.Labeller(model).label([mixed])
    assert lang == "en" and abs(score - 0.75) < 0.03


def test_switch_points():
    """Spans end and begin where the language switches; words without letters go with the word before them."""
    rng = np.random.default_rng(4)
    a, b = [f"th{i}ing" for i in range(40)], [f"LE{i}eau" for i in range(40)]
    model = langid.learn([("en", " ".join(rng.choice(a, 200))), ("fr", " ".join(rng.choice(b, 200)).lower())] * 20)
    stretches = [("en", rng.choice(a, 120)), ("fr", rng.choice(b, 90)), ("en", rng.choice(a, 60))]
    parts = [" ".join(w) for _, w in stretches]
    text = f"  12\t{parts[0]} 34 5\n{parts[1]}\x0b{parts[2]} !! "
    found = langid.Labeller(model).label(["", text, parts[1], "7 8", text])
    assert found[0] == found[3] == ("und", 0.0, []) and found[1] == found[4]
    assert found[2][2] == [{"start": 0, "end": len(parts[1]), "lang": "fr"}]
    want = [("en", text.index("12"), text.index("5\n") + 1), ("fr", text.index(parts[1]), text.index("\x0b")),
            ("en", text.index("\x0b") + 1, len(text) - 1)]
    got = [(s["lang"], s["start"], s["end"]) for s in found[1][2]]
    assert [x[0] for x in got] == [x[0] for x in want] and got[0][1] == want[0][1] and got[-1][2] == want[-1][2]
    words_off = lambda x, y: len(text[min(x, y):max(x, y)].split())
    assert all(words_off(g[1], w[1]) <= 1 and words_off(g[2], w[2]) <= 1 for g, w in zip(got, want))


def test_edges(spark):
    rows = [(1, None, "en", 1), (2, "", "en", 1), (3, "12 !! 34 ½", "en", 1), (4, "the words " * 30000, "en", 1), (4, "the words " * 30000, "en", 1),
            (5, "les mots", "fr", 1), (6, "mots les des", "fr", 1), (7, "the an words", None, 1), (None, "the", None, 1), (8, "ΑΣ", None, 1), (9, "x" * 200000, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = langid.learn([("en", "the words of the text"), ("fr", "les mots des textes")])
    got = langid.label_language(docs, model).collect()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert len(got) == len(rows) and by[1] == by[2] == by[3] == ("und", 0.0)
    assert by[4][0] == "en" and by[5][0] == "fr" and all(0 <= r["score"] <= 1 for r in got)
    assert langid.label_language(docs.limit(0), model).count() == 0
    odd = docs.selectExpr("doc_id", "text", "struct(1 as `a b`, 'x' as `c``d`) as `s``t`", "lang as spans")
    out = langid.label_language(odd, model)
    assert out.columns == ["doc_id", "text", "s`t", "lang_pred", "score", "spans"] and out.count() == len(rows)
    assert langid.sample(docs, 5, 100, 1) and {x for x, _ in langid.sample(docs, 5, 100, 1)} == {"en"}
    assert langid.fit(docs.where("lang is null")) is None
    assert {r["lang_pred"] for r in langid.label_language(docs, None).collect()} == {"und"}
