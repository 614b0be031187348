"""Phrase mining against plain counting: automata, slices, ranges, scores and odd input."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitchside.llm import phrases, registry
from tests.compare import compare, duck

SF = "/root/testdata/sf0.01"


def plain(rows, least, longest=4, scale=2_000_000, cover=80, most=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in found.items():
        inside = [b for (lg, v), b in found.items() if lg == lang and len(v) > len(w) and any(v[i:i + len(w)] == w for i in range(len(v)))]
        if any(100 * b >= cover * a for b in inside):
            continue
        score, k = min((scale * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    ranked, place = [], Counter()
    for lang, phrase, a, left, right, total, score in sorted(out, key=lambda t: (t[0], -t[6], -t[2], t[1].encode())):
        place[lang] += 1
        if place[lang] <= most:
            ranked.append((lang, place[lang], phrase, a, left, right, total, score))
    return ranked


def corpus(seed, docs=120):
    rng = np.random.default_rng(seed)
    words = ["a", "b", "c", "The", "é", "漢字", "x-y", "\x01", "z\xa0z", "to", "of", "Q"]
    rows = []
    for i in range(docs):
        pick = rng.choice(len(words), size=rng.integers(0, 60), p=rng.dirichlet(np.ones(len(words)) * 0.5))
        rows.append(([None, "und", "en", "fr", ""][rng.integers(0, 5)], "".join(words[k] + str(rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b"], p=[.6, .1, .1, .05, .05, .05, .05])) for k in pick)))
    return rows + [("en", "of the people by the people\nfor the people " * 15), (None, None), ("en", ""), ("fr", "...")] + [("fr", "le petit chat dort bien ici")] * 40


def sorted_phrases(seqs):
    words = sorted({w for s in seqs for w in s})
    depth = max(map(len, seqs))
    columns = [np.array([words.index(s[k]) if k < len(s) else -1 for s in seqs]) for k in range(depth)]
    return pa.array(words, pa.large_binary()), columns


def read(t, words, found):
    columns, weights = found
    return {tuple(words[int(c[i])].as_py() for c in columns if c[i] >= 0): int(w) for i, w in enumerate(weights)}


SEQS = st.dictionaries(st.lists(st.sampled_from([b"a", b"b", b"c", b"\xff"]), min_size=1, max_size=4).map(tuple), st.integers(1, 9), min_size=1, max_size=40)


@settings(max_examples=60, deadline=None)
@given(SEQS, SEQS, st.integers(1, 6))
def test_automata(one, two, least):
    def made(counts):
        seqs = sorted(counts)
        return phrases.Transducer.build(*sorted_phrases(seqs), np.array([counts[s] for s in seqs]))

    a, b = (phrases.Transducer.from_bytes(made(c).to_bytes()) for c in (one, two))
    assert read(a, a.words, a.phrases()) == one
    assert read(b, b.words, a.compose(b)) == {s: one[s] for s in two if s in one}
    words, columns, weights, (heads, totals) = phrases.summed([a, b], least)
    union = Counter(one) + Counter(two)
    assert read(None, words, (columns, weights)) == {s: w for s, w in union.items() if w >= least}
    want = Counter()
    for s, w in union.items():
        want[s[0]] += w
    assert dict(zip(heads, totals)) == want


def test_minimal():
    """Phrases with equal endings share states: a, b, c before x, y with equal differences of counts."""
    seqs = [(h, t) for h in (b"a", b"b", b"c") for t in (b"x", b"y")]
    t = phrases.Transducer.build(*sorted_phrases(seqs), np.array([1, 5, 2, 6, 7, 11]))
    assert len(t.final) == 3 and len(t.label) == 5


@pytest.mark.parametrize("setting", [{}, {"range_bytes": 300, "sampled": 40}, {"range_bytes": 200, "most_ranges": 3}])
def test_plain_counting(spark, setting):
    rows = corpus(1)
    df = spark.createDataFrame([(lang, t, 1, "x") for lang, t in rows], "lang string, text string, n int, `range` string").repartition(5)
    got = sorted(tuple(r) for r in phrases.collocations(df, least=6, **setting).collect())
    assert got == sorted(plain(rows, 6)) and {"en", "fr", "und", ""} >= {r[0] for r in got} and len(got) > 20


def test_slices(spark, monkeypatch):
    """Texts that are counted in slices, with and without gaps, words longer than a slice included."""
    monkeypatch.setattr(phrases, "CHUNK", 50)
    rows = corpus(2, 30) + [("en", "w" * 170), ("en", "v" * 60 + " " + "u" * 70 + " a b c."), ("en", "a b c " * 60), ("en", " . " * 60)]
    for text in [t for _, t in rows if t]:
        cut = list(phrases.slices(text.encode(), 4))
        assert b"".join(d[:limit] for d, limit in cut) == text.encode()
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(2)
    for longest in (2, 3, 4):
        assert sorted(tuple(r) for r in phrases.collocations(df, least=5, longest=longest, most=7).collect()) == sorted(plain(rows, 5, longest, most=7))


def test_tight_bit_set(spark, monkeypatch):
    """A bit set that is far too small lets rare phrases pass; counts stay exact."""
    monkeypatch.setattr(phrases, "FILTER_BITS", 7)
    rows = corpus(3)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in phrases.collocations(df, least=4).collect()) == sorted(plain(rows, 4))


def test_large_counts(spark):
    """Products past 64 bits: a candidate's count as it would be in a very large corpus."""
    big = 6 * 10 ** 18
    t = phrases.Transducer.build(*sorted_phrases([(b"en", b"a"), (b"en", b"a", b"b"), (b"en", b"b")]), np.array([big + 7, big, big + 9]))
    counts = spark.createDataFrame([(0, bytearray(t.to_bytes()))], "range long, blob binary")
    row = phrases.candidates(counts, phrases.Ranges([], 1)).collect()
    assert [(r.lang, r.words, r.a, [tuple(c) for c in r.cuts]) for r in row] == [("en", ["a", "b"], big, [(1, big + 7, big + 9)])]


def test_empty(spark):
    for rows in ([], [(None, None)], [("en", " , ")], [("en", "one two")]):
        assert phrases.collocations(spark.createDataFrame(rows, "lang string, text string")).count() == 0


def test_query(spark):
    ok, told = compare(registry.QUERIES["op11_phrases"](spark, SF), duck(SF), registry.ORACLE_SQL["op11_phrases"])
    assert ok, told
