"""Fill-in-middle against a plain version, the DuckDB statement and an exact round trip."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitchside.llm import infill, registry
from pitchside.llm.infill import F
from tests.compare import compare, duck

SF = "/root/testdata/sf0.01"
ENDS = {"line": "\n", "sentence": "\n.!?", "word": "\n \t"}


def plain(doc_id, text, unit="line", seed=7, percent=100, spm_percent=50, marks=infill.MARKS):
    text = text or ""
    ends = re.escape(ENDS[unit])
    units = re.findall(f"[^{ends}]*[{ends}]|[^{ends}]+", text)
    key = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in marks) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return len(units), "spm", len(p), len(m), marks[1] + s + marks[0] + p + marks[2] + m
    return len(units), "psm", len(p), len(m), marks[0] + p + marks[1] + s + marks[2] + m


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=300), st.integers(0, 4))
def test_ranks(classes, kind):
    classes = np.array(classes, dtype=np.uint8)
    at = np.arange(len(classes) + 1)
    want = np.r_[0, np.cumsum(classes == kind)]
    assert (infill.WaveletMatrix(classes).rank(kind, at) == want).all()


TEXTS = ["", "\n", "\n\n", "one", "one\n", "a\nb\nc", "é\nß\n漢字\n🙂🙂\n.", "has <S> mark", "<P", "S>\n<\nM>", "x. y! z?\tw\r\n q",
         "\x00\n\x00", "line\n" * 5000, "no line feed " * 20000, "a\x0bb\x0cc\rd", "🙂" * 3000]


@pytest.mark.parametrize("unit", ["line", "sentence", "word"])
def test_plain_version(spark, unit):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "a\nb\nc\nd"), (900, None), (7, "a\nb"), (7, "a\nb"), (-3, "u\nv\nw")]
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], "doc_id long, text string, n string, `a``b.c` string, fim int")
    made = infill.fill_in_middle(df.repartition(3), unit=unit, percent=80, spm_percent=30)
    assert made.columns == ["doc_id", "text", "n", "a`b.c", "fim"]
    got = made.select("doc_id", "text", "fim.*", infill.restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
    assert sorted((str(r.doc_id), r.n, r.form, str(r.prefix_chars), str(r.middle_chars), r.output) for r in got) == sorted(
        (str(i), n, f, str(p), str(m), o) for i, t in rows for n, f, p, m, o in [plain(i, t, unit, 7, 80, 30)])
    assert all(r.back == (r.text or "") for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_slices(spark, monkeypatch):
    data = [("ab\nc" * k).encode() for k in (0, 1, 50, 3, 0, 200, 2)]
    texts = infill.pa.array([d.decode() for d in data])
    whole = spark.createDataFrame([(i, d.decode()) for i, d in enumerate(data)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(infill, "SLICE", 64)
    got = {r.doc_id: tuple(r.fim) for r in infill.fill_in_middle(whole).collect()}
    assert got == {i: plain(i, t) for i, t in enumerate(texts.to_pylist())}


def test_marks_and_empty(spark):
    for marks in [("<", "<S", "<M>"), ("ab", "ba", "c"), ("", "x", "y"), ("|", "|", "!")]:
        with pytest.raises(ValueError):
            infill.check_marks(marks)
    assert infill.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    con = duck(SF)
    ok, told = compare(registry.QUERIES["op12_fill_in_middle"](spark, SF), con, registry.ORACLE_SQL["op12_fill_in_middle"])
    assert ok, told
