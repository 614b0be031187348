"""Toxicity: held-out accuracy, windows against a plain reading, edge rows."""

import os
import zlib

import numpy as np
import pytest

from pitchside.llm import registry, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in registry.QUERIES["op7_toxicity"](spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    labels = [(r["toxic"], rows[r["doc_id"]]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(y, r["predicted"], r["score"]) for y, r in labels if r["held_out"]]
    found = sum(y and p for y, p, _ in held)
    precision, recall = found / sum(p for _, p, _ in held), found / sum(y for y, _, _ in held)
    assert precision > 0.8 and recall > 0.55, (precision, recall)  # 341 toxic documents to learn from


def test_windows():
    texts = [b"", b" a", b"a  b\tc\nd e f g h i j k l m", b" ", b"x" * 9000, b" ".join([b"w"] * 8), b" ".join([b"w"] * 9)]
    data, first, end, text = toxicity.windows(texts)
    got = [(int(t), data[a:b].split()) for a, b, t in zip(first, end, text)]
    want = []
    for i, t in enumerate(texts):
        w = t.split()
        want += [(i, w[k:k + 8]) for k in range(0, len(w), 4) if k == 0 or len(w) - k > 4]
    assert got == want


def test_edges(spark):
    rows = [(1, None, "a", 5.0), (2, "", "b", 5.0), (3, "the clean text " * 4, "c", 5.0), (3, "the clean text " * 4, "c", 5.0),
            (4, "scum " * 20000, None, None), (None, "x", "d", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other string, score double")
    labels = spark.createDataFrame([(3, 0), (3, None), (4, 1), (4, 0), (None, 1)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is None
    got = toxicity.score_toxicity(docs, None)
    assert got.columns == ["doc_id", "text", "other", "score", "predicted"]
    assert [r["score"] for r in got.collect()] == [0.0] * 6
    many = spark.range(400).selectExpr("id as doc_id", "concat('doc ', id * id, if(id % 2 = 0, ' you scum bag ', ' good '), 'day ', id * 77) as text")
    model = toxicity.fit(many, many.selectExpr("doc_id", "cast(doc_id % 2 = 0 as int) as toxic"))
    out = toxicity.score_toxicity(docs, model).collect()
    assert len(out) == 6 and out[2] == out[3] and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_a_task_learns(spark, monkeypatch):
    """The driver gets the model and no text."""
    docs = spark.range(400).selectExpr("id as doc_id", "concat('doc ', id * id, if(id % 2 = 0, ' you scum bag ', ' good '), 'day ', id * 77) as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 = 0 as int) as toxic")

    driver, compressor = os.getpid(), toxicity.compressor

    def elsewhere(content):
        assert os.getpid() != driver
        return compressor(content)

    monkeypatch.setattr(toxicity, "compressor", elsewhere)
    ordinary, toxic, weights = toxicity.fit(docs, labels)
    assert toxic.endswith(ordinary) and len(weights) == toxicity.MOST + 3


@pytest.mark.parametrize("n", [1, 3])
def test_features_do_not_depend_on_the_batch(n):
    texts = [b"some words here " * k for k in range(1, 7)]
    c, d = toxicity.compressor(b"some ordinary words"), toxicity.compressor(b"here some ordinary words")
    whole = toxicity.features(texts, c, d)
    parts = np.concatenate([toxicity.features(texts[i:i + n], c, d) for i in range(0, len(texts), n)])
    assert np.array_equal(whole, parts)


def test_odd_column_names(spark):
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string").selectExpr("*", "struct(1 as `a b`, 'x' as `c``d`) as `s``t`")
    out = toxicity.score_toxicity(docs, None)
    assert out.columns == ["doc_id", "text", "s`t", "score", "predicted"] and out.first()["predicted"] == 0
