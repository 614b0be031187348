"""Packing: ids against the tokenizer, valid layouts, the reduction against exhaustive search."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pitchside.llm import packing, registry

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, capacity=4096):
    """Every piece as the tokenizer says, every sequence gapless; returns the number of sequences."""
    tok = Tokenizer.from_file(PATH)
    want = []
    for i, text in texts:
        ids = np.array(ids_of(tok, text), dtype="<u4")
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s:s + capacity]
            want.append((i, k, s, len(part), zlib.crc32(part.tobytes())))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    per = {}
    for r in rows:
        per.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for v in per.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= capacity
    return len(per)


def test_query(spark):
    rows = registry.QUERIES["op1_pack"](spark, SF).collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    n = check(rows, texts)
    assert n <= 1.01 * sum(r["length"] for r in rows) / 4096 + 1


def test_edges(spark):
    texts = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "Ω'S don't <|endoftext|>x é ΑΣ\x85ß\x1cq 3½"), (5, "word " * 9000),
             (6, "x" * 60000), (7, "a\tb\r\n c\x0bd!'s 'll \x00\x7f"), (8, "İI ﬁ  x")]
    df = spark.createDataFrame([(*t, 7) for t in texts], "doc_id long, text string, length int")
    pieces = packing.token_pieces(df, PATH)
    check(packing.pack(pieces).collect(), texts)
    assert packing.pack(packing.token_pieces(df.limit(0), PATH)).count() == 0


def test_another_tokenizer(spark):
    """Ids are those of the tokenizer given, whatever its steps."""
    other = public_tokenizers.path("byte_bpe_50k.json")
    texts = [(i, r["text"]) for i, r in enumerate(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect())]
    texts += [(100, None), (101, " Two  blanks\n\nand É, 3.5 <|endoftext|>")]
    tok, plain = Tokenizer.from_file(other), Tokenizer.from_file(PATH)
    assert packing.by_words(plain) and not packing.by_words(tok)
    for path, t in ((other, tok), (PATH, plain)):
        got = {}
        for r in packing.token_pieces(spark.createDataFrame(texts, "doc_id long, text string"), path).collect():
            got.setdefault(r["doc_id"], []).append((r["piece"], packing.read_ids(r["ids"], r["length"]).tolist()))
        for i, text in texts:
            assert sum((ids for _, ids in sorted(got[i])), []) == ids_of(t, text)


def test_clashing_names(spark):
    names = ["_at", "_bucket", "_number", "_first", "_place", "_n", "a`b.c"]
    pieces = spark.range(500).selectExpr("cast(null as long) as doc_id", "0 as piece", "cast(1 + id % 3 as long) as length",
                                         *[f"id as `{n.replace('`', '``')}`" for n in names])
    out = packing.pack(pieces, 7)
    assert out.columns == [*pieces.columns, "sequence_id", "offset"]
    rows = out.collect()
    assert sorted(r["_at"] for r in rows) == list(range(500)) and all(r["_at"] == r["_n"] for r in rows)
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 500


def test_hot_length(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "if(id % 3 = 0, 'one two', repeat('w ', cast(id % 900 as int))) as text")
    rows = packing.pack(packing.token_pieces(df, PATH), buckets=8).collect()
    n = check(rows, [(r["doc_id"], r["text"]) for r in df.collect()])
    assert n == -(-sum(r["length"] for r in rows) // 4096)


def fewest(items, capacity):
    best = len(items)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for b in sorted(set(bins)):
            if b + items[i] <= capacity:
                rest = list(bins)
                rest.remove(b)
                go(i + 1, [*rest, b + items[i]])
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(6))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    for _ in range(60):
        cap = rng.choice([10, 20, 30])
        items = sorted((rng.randrange(1, cap + 1) for _ in range(rng.randrange(1, 10))), reverse=True)
        counts = np.bincount(items, minlength=cap + 1)
        fixed = packing.reduce_by_dominance(counts, cap)
        left = list(itertools.chain.from_iterable([s] * int(c) for s, c in enumerate(counts)))[::-1]
        assert sum(t for _, t in fixed) + fewest(left, cap) == fewest(items, cap)
        rest = packing.best_fit(counts, cap)
        packed = np.zeros(cap + 1, dtype=int)
        for runs, times in fixed + rest:
            assert sum(w * n for w, n in runs) <= cap
            for w, n in runs:
                packed[w] += n * times
        assert list(packed) == list(np.bincount(items, minlength=cap + 1))


def test_best_fit_equals_item_by_item():
    rng = random.Random(5)
    for _ in range(40):
        items = sorted((rng.randrange(1, 60) for _ in range(300)), reverse=True)
        bins = []
        for w in items:
            fit = [b for b in bins if b + w <= 100]
            b = max(fit, default=0)
            if fit:
                bins.remove(b)
            bins.append(b + w)
        assert sum(t for _, t in packing.best_fit(np.bincount(items, minlength=101), 100)) == len(bins)


def sequences(rows):
    """The ids of every sequence, pieces in order of offset."""
    per = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        ids = packing.read_ids(r["ids"], r["length"])
        assert len(ids) == r["length"] and zlib.crc32(ids.astype("<u4").tobytes()) == r["ids_crc32"]
        got = per.setdefault(r["sequence_id"], [])
        assert len(got) == r["offset"]
        got.extend(ids.tolist())
    return per


def test_packed_ids_are_the_tokenizers(spark):
    texts = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (3, "c d"), (4, "Ω'S don't <|endoftext|>x é"), (5, "word " * 9000), (None, "no id")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = packing.pack(packing.token_pieces(df, PATH)).collect()
    tok = Tokenizer.from_file(PATH)
    assert sorted(x for s in sequences(rows).values() for x in s) == sorted(x for _, t in texts for x in ids_of(tok, t))
    whole = [[], [], []]
    for r in sorted((r for r in rows if r["doc_id"] == 5), key=lambda r: r["start"]):
        whole[r["piece"]] = packing.read_ids(r["ids"], r["length"]).tolist()
    assert sum(whole, []) == ids_of(tok, "word " * 9000)
    got = sorted(packing.read_ids(r["ids"], r["length"]).tolist() for r in rows if r["doc_id"] == 3)
    assert got == sorted(ids_of(tok, t) for t in ("a b", "a b", "c d"))
    assert "ids" not in registry.QUERIES["op1_pack"](spark, SF).columns
