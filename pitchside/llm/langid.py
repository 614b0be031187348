"""Language identification by a linear-chain conditional random field over words.

Every word gets features: its byte n-grams of two to four with marks at either end (which hold the
affixes), the word itself, and for each language whether the word stands in that language's
lexicon, its most frequent words in the sample.  Feature weights per language and transitions
between languages are learned by maximum likelihood (forward-backward gradients) on sequences that
join stretches of sampled documents, some switching language between stretches.  A text's words get
their posterior by forward-backward over the whole text and with it a label; neighbours of one label make
spans.  A text's language is the label of most of its words with a letter, its score their mean posterior of
it, so code-switched text has several spans and a lower score.

Texts run side by side: they are cut into blocks of ``BLOCK`` words, the transfer matrices of all
blocks are built together, carried from block to block per text, and the inner steps run together
again.  That is the exact forward-backward of each whole text, with few steps in Python however
long a text is.

Learning takes a bounded sample, ``per_language`` documents of each language of at most
``max_chars`` characters, the first by a hash of their ids, and of the ``most_languages`` most frequent languages;
only text and language are read.

Cases: text that is null or has no letter is ``und`` with score 0 and without spans; a null language is not learned
from; without anything to learn from every text is ``und``; repeated rows are labelled alike; empty
input gives empty output; other columns travel along unless they bear the name of an added
column, which is then replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, map_rows, table

BLOCK = 64
BITS = 18
CHUNK = 2_000_000
#: Words whose emissions a task remembers.
REMEMBERED = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Words end at ASCII white space.
_BLANK = " \t\n\r\x0b\x0c"
_WORD = re.compile(f"[^{_BLANK}]+")


def word_hash(data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    place = np.arange(len(data)) - np.repeat(first, length)
    power = np.cumprod(np.full(int(length.max(initial=1)), _MIX | np.uint64(1), dtype=np.uint64))
    return np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[place], first) if len(first) else np.zeros(0, np.uint64)


def word_features(words: list[bytes], lexicon: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the words one after another, and at which each word's begin.

    ``lexicon`` has the sorted hashes of lexicon words, ``member`` for each a bit per language.
    """
    marked = [b"^" + w + b"$" for w in words]
    data = np.frombuffer(b"".join(marked), dtype=np.uint8)
    length = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    first = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(words)), length)
    whole = word_hash(data, first, length)
    numbers, owners = [whole * _MIX >> np.uint64(64 - BITS)], [np.arange(len(words))]
    gram = data.astype(np.uint64)
    for n in (2, 3, 4):
        gram = gram[:-1] << np.uint64(8) | data[n - 1:]
        inside = np.flatnonzero(owner[:len(gram)] == owner[n - 1:])
        numbers.append((gram[inside] + np.uint64(n << 40)) * _MIX >> np.uint64(64 - BITS))
        owners.append(owner[inside])
    at = np.minimum(np.searchsorted(lexicon, whole), max(len(lexicon) - 1, 0))
    if len(lexicon):
        known = np.flatnonzero(lexicon[at] == whole)
        for k in range(member.shape[1]):
            has = known[member[at[known], k]]
            numbers.append(np.full(len(has), (1 << BITS) + k, dtype=np.uint64))
            owners.append(has)
    number, owned = np.concatenate(numbers).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owned, kind="stable")
    start = np.searchsorted(owned[order], np.arange(len(words)))
    return number[order], start


def posteriors(scores: np.ndarray, lengths: np.ndarray, transition: np.ndarray, pairs: bool = False):
    """Posterior of every label at every word; ``scores`` holds the texts' words one after another.

    With ``pairs`` also the factors of the pair posteriors: what precedes each word's label, itself
    included, and what follows it, its own emission included.
    """
    n, k = scores.shape
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(transition - transition.max())
    per = -(-lengths // BLOCK)  # blocks of each text
    text = np.repeat(np.arange(len(lengths)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    begin = np.repeat(np.cumsum(lengths) - lengths, per) + nth * BLOCK
    size = np.minimum(BLOCK, lengths[text] - nth * BLOCK)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    active = [int(np.searchsorted(-size, -t, side="left")) for t in range(BLOCK)]  # blocks longer than t
    where = np.empty(len(order), dtype=np.int64)
    where[order] = np.arange(len(order))

    move = np.broadcast_to(np.eye(k), (len(order), k, k)).copy()
    for t, m in enumerate(active):
        if m:
            new = (move[:m].reshape(-1, k) @ step).reshape(m, k, k) * emit[begin[:m] + t][:, None, :]
            move[:m] = new / new.max(axis=(1, 2), keepdims=True)

    # from block to block: what enters each block from before and from after
    head = np.full((len(order), k), 1.0 / k)
    tail = np.ones((len(order), k))
    firsts = np.cumsum(per) - per
    by_blocks = np.argsort(-per, kind="stable")
    per_sorted = per[by_blocks]
    for i in range(1, int(per.max(initial=0))):
        some = by_blocks[:np.searchsorted(-per_sorted, -i, side="left")]
        a, b = where[firsts[some] + i - 1], where[firsts[some] + i]
        v = np.einsum("ni,nij->nj", head[a], move[a])
        head[b] = v / v.sum(axis=1, keepdims=True)
        a, b = where[firsts[some] + per[some] - i], where[firsts[some] + per[some] - i - 1]
        v = np.einsum("nij,nj->ni", move[a], tail[a])
        tail[b] = v / v.sum(axis=1, keepdims=True)

    out = np.empty_like(emit)
    now = head
    for t, m in enumerate(active):
        if m:
            new = (now[:m] @ step) * emit[begin[:m] + t]
            now[:m] = new / new.sum(axis=1, keepdims=True)
            out[begin[:m] + t] = now[:m]
    before, after = (out.copy(), np.empty_like(out)) if pairs else (None, None)
    now = tail
    for t in reversed(range(BLOCK)):
        m = active[t]
        if m:
            at = begin[:m] + t
            out[at] *= now[:m]
            following = emit[at] * now[:m]
            if pairs:
                after[at] = following
            new = following @ step.T
            now[:m] = new / new.sum(axis=1, keepdims=True)
    out /= out.sum(axis=1, keepdims=True)
    return (out, before, after) if pairs else out


def learn(texts: list[tuple[str, str]], top_words: int = 300, words_each: int = 60_000, stretch: int = 16,
          stretches: int = 3, switching: float = 0.3, rounds: int = 6, rate: float = 0.3) -> dict | None:
    """The model from ``(language, text)`` rows."""
    rng = np.random.default_rng(6)
    by: dict[str, list[list[bytes]]] = {}
    for lang, text in texts:
        words = text.lower().encode().split()
        if words:
            by.setdefault(lang, []).append(words)
    languages = sorted(by)
    if not languages:
        return None
    k, parts = len(languages), []
    counts = []
    for docs in (by[x] for x in languages):
        own = [d[i:i + stretch] for d in docs for i in range(0, len(d), stretch)]
        own = [own[i] for i in rng.permutation(len(own))[:max(1, words_each // stretch)]]
        parts.append(own)
        counts.append(Counter(chain.from_iterable(own)))
    vocabulary = sorted(set().union(*counts))
    number = {w: i for i, w in enumerate(vocabulary)}
    marked = [b"^" + w + b"$" for w in vocabulary]
    length = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    hashes = word_hash(np.frombuffer(b"".join(marked), dtype=np.uint8), np.cumsum(length) - length, length)
    listed = {w: [] for c in counts for w, _ in c.most_common(top_words)}
    for lang, c in enumerate(counts):
        for w, _ in c.most_common(top_words):
            listed[w].append(lang)
    place = np.array([number[w] for w in listed])
    order = np.argsort(hashes[place])
    lexicon, member = hashes[place][order], np.zeros((len(listed), k), dtype=bool)
    for row, w in enumerate(np.array(list(listed), dtype=object)[order]):
        member[row, listed[w]] = True
    features, start = word_features(vocabulary, lexicon, member)
    many = np.diff(np.r_[start, len(features)])

    sequences = []  # (words, labels), some of them switching language
    for lang, own in enumerate(parts):
        for i in range(0, len(own), stretches):
            words, labels = [], []
            for s in own[i:i + stretches]:
                other = int(rng.integers(k)) if rng.random() < switching else lang
                s = parts[other][int(rng.integers(len(parts[other])))] if other != lang else s
                words += [number[w] for w in s]
                labels += [other] * len(s)
            sequences.append((words, labels))
    weights = np.zeros(((1 << BITS) + k, k))
    moves = np.zeros((k, k))
    square, square_moves = np.full_like(weights, 1e-2), np.full_like(moves, 1e-2)
    for _ in range(rounds):
        sequences = [sequences[i] for i in rng.permutation(len(sequences))]
        for i in range(0, len(sequences), 256):
            batch = sequences[i:i + 256]
            words = np.concatenate([np.array(w) for w, _ in batch])
            labels = np.concatenate([np.array(x) for _, x in batch])
            lengths = np.array([len(w) for w, _ in batch])
            f = np.repeat(start[words] - np.r_[0, np.cumsum(many[words])[:-1]], many[words]) + np.arange(many[words].sum())
            f = features[f]
            scores = np.add.reduceat(weights[f], np.r_[0, np.cumsum(many[words])[:-1]], axis=0)
            p, before, after = posteriors(scores, lengths, moves, pairs=True)
            error = np.eye(k)[labels] - p
            spread = np.repeat(error, many[words], axis=0)
            gradient = np.stack([np.bincount(f, spread[:, j], minlength=len(weights)) for j in range(k)], axis=1) / len(batch)
            pair = np.ones(len(words), dtype=bool)
            pair[np.cumsum(lengths)[:-1]] = False
            pair = np.flatnonzero(pair[1:]) + 1  # words with one before them in their sequence
            joint = before[pair - 1][:, :, None] * np.exp(moves - moves.max()) * after[pair][:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            seen = np.zeros((k, k))
            np.add.at(seen, (labels[pair - 1], labels[pair]), 1)
            change = (seen - joint.sum(axis=0)) / len(batch)
            square += gradient ** 2
            weights += rate * gradient / np.sqrt(square)
            square_moves += change ** 2
            moves += rate * change / np.sqrt(square_moves)
    return {"languages": languages, "weights": weights.astype(np.float32), "moves": moves, "lexicon": lexicon, "member": member}


class Labeller:
    """Applies a model; remembers the emissions of words it has met."""

    def __init__(self, model: dict):
        self.model, self.known = model, {}
        # a row per word: its emissions, and 1 if it has a letter
        self.table = np.zeros((1 << 16, len(model["languages"]) + 1), dtype=np.float32)

    def numbers(self, texts: list[list[bytes]]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list(set().union(*texts) - self.known.keys())
        for i in range(0, len(new), 1 << 16):
            words, base = new[i:i + (1 << 16)], len(self.known)
            features, start = word_features(words, self.model["lexicon"], self.model["member"])
            while base + len(words) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[base:base + len(words), :-1] = np.add.reduceat(self.model["weights"][features], start, axis=0)
            self.table[base:base + len(words), -1] = [any(map(str.isalpha, w.decode())) for w in words]
            self.known.update(zip(words, range(base, base + len(words))))
        total = sum(map(len, texts))
        return np.fromiter(map(self.known.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=total)

    def label(self, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        """Of each text its language, that one's score and its spans.

        Every word takes its most likely language, one without letters that of the word before it (at the
        start, of the first with letters); equal neighbours are a span.  The text's language is the one that
        most words with letters have, its score the mean of their chances of it.
        """
        out: list[tuple[str, float, list[dict]]] = [("und", 0.0, [])] * len(texts)
        at = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
        words = [texts[i].lower().encode().split() for i in at]
        if not at:
            return out
        ids = self.numbers(words)
        lengths = np.array([len(w) for w in words])
        rows = self.table[ids]
        p = posteriors(rows[:, :-1].astype(np.float64), lengths, self.model["moves"])
        first, lettered = np.cumsum(lengths) - lengths, rows[:, -1] > 0
        of_word = p.argmax(axis=1)
        per_text = lambda x: np.add.reduceat(x * lettered[:, None], first, axis=0)
        means, votes = per_text(p), per_text(np.eye(p.shape[1])[of_word])
        means /= means.sum(axis=1, keepdims=True)
        best = (votes + means * 0.5).argmax(axis=1)  # of equal votes the likelier
        # the last word with letters up to each word, or else the next one
        text = np.repeat(np.arange(len(at)), lengths)
        place = np.where(lettered, np.arange(len(ids)), -1)
        last = np.maximum.accumulate(place)
        after = np.minimum.accumulate(np.where(lettered, np.arange(len(ids)), len(ids) - 1)[::-1])[::-1]
        taken = of_word[np.where(last >= first[text], last, after)]
        new = np.flatnonzero(np.r_[True, (taken[1:] != taken[:-1]) | (text[1:] != text[:-1])])
        limits = np.searchsorted(text[new], np.arange(len(at) + 1))
        for k, i in enumerate(at):
            starts = new[limits[k]:limits[k + 1]]
            t = texts[i]
            if len(starts) == 1:
                places = [(len(t) - len(t.lstrip(_BLANK)), len(t.rstrip(_BLANK)))]
            else:
                found = [m.span() for m in _WORD.finditer(t)]
                ends = np.r_[starts[1:], first[k] + lengths[k]] - first[k] - 1
                places = [(found[a][0], found[b][1]) for a, b in zip(starts - first[k], ends)]
            spans = [{"start": a, "end": b, "lang": self.model["languages"][taken[x]]} for (a, b), x in zip(places, starts)]
            out[i] = (self.model["languages"][best[k]], float(min(1.0, means[k, best[k]])), spans)
        return out


def chunks(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def sample(docs: DataFrame, per_language: int, max_chars: int, most_languages: int) -> list[tuple[str, str]]:
    """``(lang, text)`` of at most ``per_language`` documents of each of the ``most_languages`` most frequent languages."""
    known = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang").distinct()
    # one row per language, the labels of the model; a language in n documents need only sort the share of least hashes
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()}
    if not sizes:
        return []
    reach = F.create_map(*chain.from_iterable(
        (F.lit(x), F.lit(min((1 << 63) - 1, int((min(1.0, 3 * per_language / n) - 0.5) * 2 ** 64)))) for x, n in sizes.items()))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (known.where(F.xxhash64("doc_id") <= F.element_at(reach, F.col("lang")))
           .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language).select("doc_id", "lang"))
    # at most per_language rows for each language, so the broadcast is bounded
    rows = (docs.where(F.length("text") <= max_chars).join(F.broadcast(ids), ["doc_id", "lang"])
            .groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect())
    return [(r["lang"], r["text"]) for r in sorted(rows, key=lambda r: (r["lang"], r["doc_id"]))]


def fit(docs: DataFrame, per_language: int = 400, max_chars: int = 20_000, most_languages: int = 256) -> dict | None:
    return learn(sample(docs, per_language, max_chars, most_languages))


def label_language(docs: DataFrame, model: dict | None) -> DataFrame:
    """The documents with ``lang_pred``, ``score`` and ``spans``: where (code points, end exclusive) a text is in which language."""
    docs = docs.drop("lang_pred", "score", "spans")
    shared, text = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value) if shared.value else None
        for batch in batches:
            found: list[tuple[str, float, list[dict]]] = []
            for part in chunks([t or "" for t in batch.column(text).to_pylist()]):
                found += labeller.label(part) if labeller else [("und", 0.0, [])] * len(part)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _, _ in found], pa.string()), pa.array([x for _, x, _ in found], pa.float64()),
                 pa.array([x for _, _, x in found], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))],
                [*batch.schema.names, "lang_pred", "score", "spans"])

    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())])
    return map_rows(docs, apply, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                    T.StructField("spans", T.ArrayType(span)))


def op6_language(spark, sf_dir: str) -> DataFrame:
    model = fit(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return label_language(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
