"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on what is typical of toxic
text; the second stands before the content of the first, so that both compress ordinary prose
alike.  Texts are read in overlapping windows of ``WINDOW`` words, every window is compressed with
either dictionary, and the bytes that the toxic one saves are its distance.  A document's features
are the shares of windows that save at least 1, 2, ... bytes, the largest saving and the number of
windows; a logistic calibration makes them a score.

Learning takes a bounded sample, ``per_class`` labelled documents of each class of at most
``max_chars`` characters, the first by a hash of their ids; near copies in it count once.  The toxic
dictionary is trained on the stretches whose grams of five or seven bytes occur in far more toxic
than ordinary documents.  For the calibration, halves of the sample are scored with a dictionary
made of the other half and weighted to the share of toxic documents among all labels; a miss costs
``miss_cost`` times what a false alarm costs.  Applying covers every whole text.

Cases: null and empty text have no window and get the score of no evidence; documents without
label, and labels that are null, are not learned from; if two labels disagree a document counts as
toxic; if a class is missing every score is 0; repeated rows are scored alike; empty input gives
empty output; other columns travel along unless they bear the name of an added column, which is
then replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from .common import held_out, map_rows, table

WINDOW, STEP = 8, 4
GRAMS = (5, 7)
MOST = 12
#: Texts are compressed in chunks of about this many bytes, so that memory does not follow the batch.
CHUNK = 1_000_000
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def windows(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The joined texts and, for each window, its first byte, its end and its text's number."""
    data = b"\n".join(texts) + b"\n"
    space = _SPACE[np.frombuffer(data, dtype=np.uint8)]
    edge = np.diff(np.r_[True, space].astype(np.int8))
    first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    limits = np.cumsum([0, *(len(t) + 1 for t in texts)])
    text = np.searchsorted(limits, first, side="right") - 1
    count = np.bincount(text, minlength=len(texts))
    base = np.r_[0, np.cumsum(count)]
    at = np.arange(len(first)) - base[text]
    # the last windows of a text stop at its end; one that would lie wholly in the one before is left out
    kept = np.flatnonzero((at % STEP == 0) & ((at == 0) | (count[text] - at > WINDOW - STEP)))
    last = np.minimum(kept + WINDOW, base[text[kept] + 1]) - 1
    return data, first[kept], end[last], text[kept]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        window_log=15, hash_log=14, chain_log=14, search_log=3, min_match=5, strategy=zstandard.STRATEGY_BTLAZY2,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False, write_checksum=False)
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params)


def features(texts: list[bytes], ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> np.ndarray:
    """A row for each (lower-cased) text."""
    data, first, end, text = windows(texts)
    n = len(texts)
    saved = np.zeros(0, dtype=np.int64)
    if len(first):
        segments = np.stack([first, end - first], axis=1).astype(np.uint64).tobytes()
        sizes = []
        for c in (ordinary, toxic):
            out = c.multi_compress_to_buffer(zstandard.BufferWithSegments(data, segments), threads=1)
            sizes.append(np.fromiter((len(x) for x in out), dtype=np.int64, count=len(out)))
        saved = sizes[0] - sizes[1]
    count = np.bincount(text, minlength=n).clip(1)
    largest = np.zeros(n)
    np.maximum.at(largest, text, saved)
    shares = [np.sqrt(np.bincount(text, saved >= k, minlength=n) / count) for k in range(1, MOST + 1)]
    return np.stack([*shares, np.minimum(largest, MOST + 2) / 10, np.log(count) / 5, np.ones(n)], axis=1)


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int) -> tuple[DataFrame, float]:
    """``(doc_id, _toxic, text)`` of the documents to learn from, and the share of toxic ones among all labels."""
    known = (labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(label).alias("_toxic")))
    share = known.agg(F.avg("_toxic")).first()[0] or 0.0
    # at most 2 x per_class ids, so the broadcast below is bounded
    order = F.xxhash64("doc_id")
    ids = known.where("_toxic = 1").orderBy(order).limit(per_class).union(known.where("_toxic = 0").orderBy(order).limit(per_class))
    rows = (docs.select("doc_id", "text").where(F.length("text") <= max_chars).join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id").agg(F.max("_toxic").alias("_toxic"), F.min("text").alias("text")))
    return rows, share


def without_copies(rows: list[tuple[object, int, bytes]]) -> tuple[list[bytes], list[bytes]]:
    """Texts of toxic and of ordinary documents, in the order of their ids, near copies of earlier ones left out."""
    seen: set[int] = set()
    out: tuple[list[bytes], list[bytes]] = ([], [])
    for _, toxic, text in sorted(rows, key=lambda r: r[0]):
        text = b" " + text.lower()
        w = text.split()
        sketch = sorted({zlib.crc32(b" ".join(w[i:i + 3])) for i in range(max(1, len(w) - 2))})[:6]
        if w and 2 * sum(h in seen for h in sketch) < len(sketch):
            seen.update(sketch)
            out[toxic == 0].append(text)
    return out


def grams(texts: list[bytes], length: int) -> tuple[list[bytes], Iterator[np.ndarray]]:
    """The texts with single spaces, and for each the 48-bit hashes of the grams that begin at its bytes."""
    plain = [b" " + b" ".join(t.split()) + b" " for t in texts]

    def of(t: bytes) -> np.ndarray:
        a = np.frombuffer(t, dtype=np.uint8).astype(np.uint64)
        n = max(len(a) - length + 1, 0)
        g = np.zeros(n, dtype=np.uint64)
        for k in range(length):
            g = g << np.uint64(8) | a[k:k + n]
        return g * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(16)

    return plain, map(of, plain)


def document_counts(found: Iterator[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The grams and in how many texts each occurs."""
    own, n, part = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        every, place = np.unique(np.concatenate([own, *part]), return_inverse=True)
        return every, np.bincount(place, np.concatenate([n, *(np.ones(len(p), dtype=np.int64) for p in part)]), len(every)).astype(np.int64)

    for g in found:  # some texts at a time, as all of their grams together are many times the text
        part.append(np.unique(g))
        if len(part) == 128:
            (own, n), part = merged(), []
    return merged() if part else (own, n)


def counts_of(grams: np.ndarray, found: Iterator[np.ndarray]) -> np.ndarray:
    """In how many texts each of the sorted ``grams`` occurs."""
    n = np.zeros(len(grams), dtype=np.int64)
    for g in found:
        g = np.unique(g)
        at = np.searchsorted(grams, g)
        n[at[(at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == g)]] += 1
    return n


def typical_passages(toxic: list[bytes], ordinary: list[bytes], least: int = 4, odds: float = 2.5) -> list[bytes]:
    """Per toxic text the stretches of grams that far more toxic than ordinary texts hold, joined."""
    passages: list[list[bytes]] = [[] for _ in toxic]
    for length in GRAMS:
        own, n = document_counts(grams(toxic, length)[1])
        if not len(own):
            continue
        m = counts_of(own, grams(ordinary, length)[1])
        ratio = np.log((n + 0.5) / (len(toxic) + 1)) - np.log((m + 0.5) / (len(ordinary) + 1))
        typical = own[(ratio > odds) & (n >= least)]
        for text, g, out in zip(*grams(toxic, length), passages):
            hit = np.isin(g, typical)
            covered = np.zeros(len(text) + 1, dtype=bool)
            for k in range(length):
                covered[k:k + len(hit)] |= hit
            edge = np.diff(np.r_[False, covered].astype(np.int8))
            out += [text[s:e] for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
    return [b" ".join(p) for p in passages if p]


def trained(samples: list[bytes], size: int, **how) -> bytes:
    """The content of a dictionary; the samples themselves where there are too few to train one."""
    try:
        return zstandard.train_dictionary(size + 600, samples, **how).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * w
        w += np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
    return w


def learned(toxic: list[bytes], ordinary: list[bytes], share: float, ordinary_size: int, toxic_size: int,
            miss_cost: float) -> tuple[bytes, bytes, np.ndarray] | None:
    """The model of the sampled texts, or None without both classes."""
    if len(toxic) < 2 or len(ordinary) < 2:
        return None
    parts = [t[i:i + 400] for t in ordinary for i in range(0, len(t), 400)]
    base = trained(parts, ordinary_size)
    rows, y = [], []
    for k in (0, 1):
        half = trained(typical_passages(toxic[k::2], ordinary), toxic_size, k=24, d=8) + base
        for part in chunks(toxic[1 - k::2] + ordinary[1 - k::2]):
            rows.append(features(part, compressor(base), compressor(half)))
        y += [1] * len(toxic[1 - k::2]) + [0] * len(ordinary[1 - k::2])
    x, y = np.concatenate(rows), np.array(y, dtype=np.float64)
    special = trained(typical_passages(toxic, ordinary), toxic_size, k=24, d=8)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = logistic(x, y, weight * len(y) / weight.sum())
    w[-1] += np.log(miss_cost)
    return base, special + base, w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 2000, max_chars: int = 50_000,
        ordinary_size: int = 16384, toxic_size: int = 2048, miss_cost: float = 1.5) -> tuple[bytes, bytes, np.ndarray] | None:
    """``(ordinary dictionary, toxic dictionary, weights)``, or None without both classes.

    One task learns from the whole sample, which is bounded; only the model comes to the driver.
    """
    rows, share = sample(docs, labels, label, per_class, max_chars)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist())]
        model = learned(*without_copies(found), share, ordinary_size, toxic_size, miss_cost)
        if model:
            yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(
                (*model[:2], model[2].tolist()), (pa.binary(), pa.binary(), pa.list_(pa.float64())))], ["ordinary", "toxic", "weights"])

    row = rows.coalesce(1).mapInArrow(learn, "ordinary binary, toxic binary, weights array<double>").first()
    return row and (bytes(row["ordinary"]), bytes(row["toxic"]), np.array(row["weights"]))


def score_toxicity(docs: DataFrame, model: tuple[bytes, bytes, np.ndarray] | None) -> DataFrame:
    """The documents with ``score`` and ``predicted``."""
    docs = docs.drop("score", "predicted")
    text = docs.columns.index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model:
            ordinary, toxic = compressor(model[0]), compressor(model[1])
        for batch in batches:
            score = np.zeros(batch.num_rows)
            if model:
                column, at = batch.column(text).cast(pa.binary()), 0
                for part in chunks([(t or b"").lower() for t in column.to_pylist()]):
                    x = features(part, ordinary, toxic)
                    score[at:at + len(part)] = 1 / (1 + np.exp(-np.clip(x @ model[2], -30, 30)))
                    at += len(part)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "score"])

    scored = map_rows(docs, apply, StructField("score", DoubleType()))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
