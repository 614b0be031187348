"""The pipeline: stages one by one against plain versions of their decisions, and the whole."""

import glob
import zlib

import numpy as np
import public_tokenizers

import corpus_pipeline as cp
from tests.llm.test_neardup import SHARED_IDS, brute
from tests.llm.test_packing import check
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    first = cp.STAGES[0][1](spark, docs, SF).cache()
    assert first.columns == columns
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in first.collect()}
    assert all(labels.get(i, 1) == 1 for i in gone)

    second = cp.STAGES[1][1](spark, first, SF).cache()
    want = brute([(r["doc_id"], r["text"]) for r in first.collect()], 80)
    assert {r["doc_id"] for r in second.collect()} == {i for i, v in want.items() if v[2]} and second.columns == columns

    third = cp.STAGES[2][1](spark, second, SF).cache()
    assert third.columns == columns and third.count() == second.count()
    assert third.where("text rlike '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+[.][A-Za-z0-9-]+'").count() == 0
    assert third.where("n_chars <> length(text)").count() == 0

    fourth = cp.STAGES[3][1](spark, third, SF).cache()
    assert fourth.columns == columns
    times = {}
    for r in fourth.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times.values()) <= 3 and set(times) <= {r["doc_id"] for r in third.collect()}

    fifth = cp.STAGES[4][1](spark, fourth, SF).collect()
    check(fifth, [(r["doc_id"], r["text"]) for r in fourth.collect()])
    digest = lambda rows: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows)
    assert digest(cp.run(spark, SF).collect()) == digest(fifth)


def test_edges(spark):
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "one two three four five six a@b.co", "en", "a", 5), (None, "no id", None, "a", 5),
            (4, "one two three four five six a@b.co", "en", "a", 5), (3, "one two three four five six a@b.co", "en", "a", 5), (5, "w " * 90000, "en", "b", 1)]
    docs = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, component_id string, score double")
    for _, stage in cp.STAGES[:-1]:
        empty, docs = stage(spark, docs.limit(0), SF), stage(spark, docs, SF).cache()
        assert docs.columns == empty.columns == ["doc_id", "text", "lang", "source", "n_chars", "component_id", "score"]
        assert empty.count() == 0
    ids = [r["doc_id"] for r in docs.collect()]
    assert 4 not in ids and None in ids and max(ids.count(i) for i in ids) <= 3
    assert docs.where("text like '%@%'").count() == 0
    out = cp.STAGES[-1][1](spark, docs, SF)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in out.where("length < 4096").collect():
        assert r["length"] <= 4096 and r["offset"] + r["length"] <= 4096
    small = {zlib.crc32(np.array(tok.encode(d["text"] or "", add_special_tokens=False).ids + [1], dtype="<u4").tobytes())
             for d in docs.collect() if len(d["text"] or "") < 1000}
    assert small <= {r["ids_crc32"] for r in out.collect()}


def test_the_packed_ids_are_delivered(spark):
    from tests.llm.test_packing import sequences

    rows = cp.run(spark, SF).collect()
    assert sum(map(len, sequences(rows).values())) == sum(r["length"] for r in rows) > 0


def test_no_text_is_lost(spark):
    """Rows that share an id, or have none: every text of the input is in the output or has a near copy there; and folders are gone."""
    rows = SHARED_IDS * 2
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r["doc_id"], r["text"]) for r in cp.STAGES[1][1](spark, docs, SF).collect()]
    parts = brute(list(enumerate(t for _, t in rows + kept)), 80)
    whole = {parts[k][1] for k in range(len(rows)) if parts[k][0]}
    assert whole == {parts[len(rows) + k][1] for k in range(len(kept)) if parts[len(rows) + k][0]}
    assert sum(not (t or "").strip() for _, t in kept) == sum(not (t or "").strip() for _, t in rows)


def test_stage_folders_are_deleted(spark):
    from pitchside.session import ensure_checkpoint_dir

    before = set(glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/pipeline-*"))
    assert cp.run(spark, SF).count() > 0
    assert set(glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/pipeline-*")) == before
