"""Phrase collocation mining with weighted acyclic automata.

A phrase is a sequence of symbols, first its language, then its words.  Counts of phrases are kept in count transducers:
minimal acyclic automata whose arcs carry outputs that add up to a phrase's count.  They are built state by
state from sorted phrases; a state is frozen as soon as the sorted input has passed its prefix, its least output is
pushed to the arc that leads to it, and equal states are shared.

1. Prefix ranges: bounds between phrases, quantiles of the phrases of a bounded sample of documents.  They only share out the work.
   Where their number is not enough for the corpus, a range is dealt further by a hash of whole phrases.
2. Every shard (some ``CHUNK`` bytes of documents) counts its phrases, sorts them and builds one transducer for each range.  Those
   of a range are united, weights being summed, and phrases seen fewer than ``least`` times leave, as no candidate has
   them as a part.  That goes in three rounds: words; pairs of frequent words; longer phrases all of whose pairs are
   frequent.  What is frequent is told to the next round by a bit set of fixed size: a phrase
   that is frequent always passes, another passes by chance and is counted for nothing, so counts stay exact at any size.
3. Part lookups: every range asks for the parts of its candidates by sending acceptors of them to the ranges they lie
   in; there count transducer and acceptor are composed, and the counts go back.
4. Scores, the rule on longer candidates and the ranks are DataFrame work, in decimals where products may pass 64 bits.

Cases: null text counts as empty, null lang as ``und``; texts without words give nothing; very long texts are counted in slices that
share the words phrases need to cross them; repeated rows count each time; ties go by count, then by the phrase's bytes; a language without
candidates gives no row; empty input gives empty output; other columns do not matter.
"""

from __future__ import annotations

import bisect
import pickle
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Bytes of text that a shard counts at once.
CHUNK = 12 << 20
#: Bits of the set that tells the next round what is frequent, as a power of two.
FILTER_BITS = 25
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_GAP = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Transducer:
    """A minimal acyclic automaton that accepts phrases and adds up their counts.

    ``words`` are the sorted symbols; arcs of state s are ``first[s]`` to ``first[s + 1]``, in order of their
    ``label``, with ``target`` and output ``out``; ``final`` is a state's final output, or -1.
    """

    PARTS = ("first", "label", "target", "out", "final")

    def __init__(self, words: pa.Array, first, label, target, out, final, start: int, base: int):
        self.words, self.start, self.base = words, start, base
        self.first, self.label, self.target, self.out, self.final = first, label, target, out, final

    @classmethod
    def build(cls, words: pa.Array, columns: list[np.ndarray], weights: np.ndarray) -> Transducer:
        """From sorted phrases, a column of symbol numbers for each place, -1 after a phrase's end.

        Phrases that differ only in the last of all places arrive as one run: their arcs all lead to the end.
        """
        depth, n = len(columns), len(weights)
        register: dict[tuple, int] = {(0, b"", b"", b""): 0}  # the end that all last symbols lead to
        if not n or not depth:  # the start is a state that is no end
            return cls._read(words, {**register, (-1, b"", b"", b""): 1}, 1, 0)
        whole = columns[-1] >= 0
        shared, alike = np.zeros(n, dtype=np.int64), np.ones(n - 1, dtype=bool)
        for c in columns:  # how many symbols each phrase shares with the one before
            alike &= c[1:] == c[:-1]
            shared[1:] += alike
        again = np.zeros(n, dtype=bool)
        again[1:] = whole[1:] & whole[:-1] & (shared[1:] >= depth - 1)
        head = np.flatnonzero(~again)
        least = np.minimum.reduceat(weights, head)
        ends = np.append(head[1:], n)
        labels, outs = columns[-1].astype(np.int64).tobytes(), (weights - np.repeat(least, ends - head)).tobytes()
        nothing = bytes(8 * int((ends - head).max()))
        names = [c[head].tolist() for c in columns[:-1]]
        lengths = sum((c[head] >= 0).astype(np.int64) for c in columns).tolist()
        opened: list[list] = [[-1, [], [], [], None]]  # along the last phrase: final, labels, targets, outputs, run
        path: list[int] = []

        def freeze(state: list) -> tuple[int, int]:
            final, arcs, targets, given, run = state
            if run:
                a, b, low = run
                key = (-1, labels[8 * a:8 * b], nothing[:8 * (b - a)], outs[8 * a:8 * b])
                if final >= 0:
                    low, own = min(low, final), weights[a:b]
                    key = (final - low, key[1], key[2], (own - low).tobytes())
            else:
                low = min([*given, final] if final >= 0 else given)
                key = (final - low if final >= 0 else -1, *(array("q", x).tobytes() for x in (arcs, targets, [g - low for g in given])))
            return register.setdefault(key, len(register)), low

        def close(kept: int) -> None:
            while len(path) > kept:
                target, low = freeze(opened.pop())
                for part, value in zip(opened[-1][1:4], (path.pop(), target, low)):
                    part.append(value)

        for i, (a, b, low, same, length) in enumerate(zip(head.tolist(), ends.tolist(), least.tolist(), shared[head].tolist(), lengths)):
            close(same)
            for place in range(len(path), min(length, depth - 1)):
                path.append(names[place][i])
                opened.append([-1, [], [], [], None])
            if length == depth:
                opened[-1][4] = a, b, low
            else:
                opened[-1][0] = low
        close(0)
        return cls._read(words, register, *freeze(opened[0]))

    @classmethod
    def _read(cls, words: pa.Array, register: dict[tuple, int], start: int, base: int) -> Transducer:
        label, target, out = (np.frombuffer(b"".join([state[k] for state in register]), dtype=np.int64) for k in (1, 2, 3))
        first = np.cumsum([0, *(len(state[1]) // 8 for state in register)])
        return cls(words, first, label, target, out, np.array([state[0] for state in register], dtype=np.int64), start, base)

    def to_bytes(self) -> bytes:
        small = [x.astype(np.min_scalar_type(int(x.max(initial=0)))) for x in (self.first, self.label, self.target, self.out, self.final + 1)]
        at = np.frombuffer(self.words.buffers()[1], dtype=np.int64)[self.words.offset:][:len(self.words) + 1] if len(self.words) else np.zeros(1, dtype=np.int64)
        text = self.words.buffers()[2][int(at[0]):int(at[-1])].to_pybytes() if at[-1] > at[0] else b""
        plain = pickle.dumps((np.diff(at).astype(np.uint32), text, small, self.start, self.base))
        return len(plain).to_bytes(8, "little") + pa.compress(plain, codec="zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        sizes, text, small, start, base = pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True))
        first, label, target, out, final = (x.astype(np.int64) for x in small)
        at = np.append(0, np.cumsum(sizes, dtype=np.int64))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(text)])
        return cls(words, first, label, target, out, final - 1, start, base)

    def _expand(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arcs of ``states``, one after the other, and the place in ``states`` each belongs to."""
        n = self.first[states + 1] - self.first[states]
        owner = np.repeat(np.arange(len(states)), n)
        return np.arange(len(owner)) + np.repeat(self.first[states] - np.cumsum(n) + n, n), owner

    def phrases(self) -> tuple[list[np.ndarray], np.ndarray]:
        """All phrases as columns and their weights (in order among those of one length)."""
        return self.compose(self)

    def compose(self, asked: Transducer) -> tuple[list[np.ndarray], np.ndarray]:
        """What both accept: phrases as columns of ``asked``'s symbols, with the weights of this automaton."""
        own = pc.fill_null(pc.index_in(asked.words, self.words), -1).to_numpy().astype(np.int64) if asked is not self else np.arange(len(self.words))
        arcs = (np.repeat(np.arange(len(self.final)), np.diff(self.first)) << 32) | self.label
        here, there, weight = np.array([self.start]), np.array([asked.start]), np.array([self.base])
        path: list[np.ndarray] = []
        found: list[tuple[list[np.ndarray], np.ndarray]] = []
        while len(here):
            ends = (self.final[here] >= 0) & (asked.final[there] >= 0)
            found.append(([p[ends] for p in path], weight[ends] + self.final[here[ends]]))
            step, owner = asked._expand(there)
            key = here[owner] << 32 | own[asked.label[step]]
            at = np.minimum(np.searchsorted(arcs, key), max(len(arcs) - 1, 0))
            both = (own[asked.label[step]] >= 0) & (arcs[at] == key) if len(arcs) else np.zeros(len(key), dtype=bool)
            step, owner, at = step[both], owner[both], at[both]
            path = [p[owner] for p in path] + [asked.label[step]]
            here, there, weight = self.target[at], asked.target[step], weight[owner] + self.out[at]
        depth = max(len(p) for p, _ in found)
        none = lambda p: np.full(len(p), -1, dtype=np.int64)
        columns = [np.concatenate([p[k] if k < len(p) else none(w) for p, w in found]) for k in range(depth)]
        return columns, np.concatenate([w for _, w in found])

    def weights(self, columns: list[np.ndarray]) -> np.ndarray:
        """The weights of phrases given in this automaton's symbols, -1 for those it does not accept."""
        arcs = (np.repeat(np.arange(len(self.final)), np.diff(self.first)) << 32) | self.label
        here, weight = np.full(len(columns[0]), self.start), np.full(len(columns[0]), self.base)
        fine = np.ones(len(here), dtype=bool)
        for c in columns:
            go = fine & (c >= 0)
            at = np.minimum(np.searchsorted(arcs, here << 32 | np.maximum(c, 0)), max(len(arcs) - 1, 0))
            hit = arcs[at] == (here << 32 | np.maximum(c, 0)) if len(arcs) else np.zeros(len(at), dtype=bool)
            fine &= hit | (c < 0)
            here, weight = np.where(go & hit, self.target[at], here), np.where(go & hit, weight + self.out[at], weight)
        return np.where(fine & (self.final[here] >= 0), weight + self.final[here], -1)


def symbols(*tables: pa.Array) -> tuple[pa.Array, list[np.ndarray]]:
    """The sorted union of tables of symbols, and for each table the numbers of its symbols there."""
    coded = pa.concat_arrays([*tables, pa.array([], pa.large_binary())]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), np.split(rank[coded.indices.to_numpy()], np.cumsum([len(t) for t in tables])[:-1])


def compact(words: pa.Array, columns: list[np.ndarray], weights: np.ndarray) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
    """Without the symbols that no phrase has."""
    used = np.unique(np.concatenate(columns)) if columns else np.zeros(0, dtype=np.int64)
    used = used[used >= 0]
    return words.take(pa.array(used)), [np.where(c < 0, -1, np.searchsorted(used, c)) for c in columns], weights


def summed(parts: list[Transducer], least: int = 1) -> tuple[pa.Array, list[np.ndarray], np.ndarray, tuple]:
    """The union of automata, weights summed: symbols, sorted columns and weights of phrases that
    weigh ``least`` or more; and the weight of all phrases by first symbol."""
    words, places = symbols(*(p.words for p in parts))
    read = [(columns, w, own) for p, own in zip(parts, places) for columns, w in [p.phrases()]]
    depth = max((len(c) for c, _, _ in read), default=0)
    columns = [np.concatenate([np.where(c[k] < 0, -1, own[np.maximum(c[k], 0)]) if k < len(c) and len(own) else np.full(len(w), -1)
                               for c, w, own in read]) for k in range(depth)]
    weights = np.concatenate([w for _, w, _ in read]) if read else np.zeros(0, dtype=np.int64)
    if not len(weights) or not depth:
        return words, columns, weights[:0], ((), ())
    order = np.lexsort(columns[::-1])
    columns, weights = [c[order] for c in columns], weights[order]
    new = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])
    columns, weights = [c[new] for c in columns], np.add.reduceat(weights, new)
    heads = np.flatnonzero(np.r_[True, columns[0][1:] != columns[0][:-1]])
    totals = (words.take(pa.array(columns[0][heads])).to_pylist(), np.add.reduceat(weights, heads).tolist())
    kept = weights >= least
    return *compact(words, [c[kept] for c in columns], weights[kept]), totals


def symbol_hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(np.array([*words.to_pylist(), None], dtype=object)[:-1], categorize=False)


def hashes(of: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each phrase from those of its symbols, the same in every shard."""
    if not columns or not len(of):
        return np.zeros(len(columns[0]) if columns else 0, dtype=np.uint64)
    h = np.zeros(len(columns[0]), dtype=np.uint64)
    for c in columns:
        new = (h ^ of[np.maximum(c, 0)]) * _ODD
        h = np.where(c < 0, h, new ^ new >> np.uint64(31))
    return h * _ODD


def tokenised(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, each word's number, where it begins and which piece it lies in."""
    a = np.frombuffer(data.translate(_LOWER), dtype=np.uint8)
    kind = _KIND[a]
    inside = kind == 0
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.r_[0, np.cumsum(end - first)].astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(a[inside])])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), first, np.searchsorted(np.flatnonzero(kind == 2), first)


def slices(text: bytes, longest: int) -> Iterator[tuple[bytes, int]]:
    """A text in slices of about ``CHUNK`` bytes and up to where words count as starts; beyond that follow
    the ``longest - 1`` words that phrases starting before it may need."""
    at = 0
    while len(text) - at > CHUNK:
        gap = _GAP.search(text, at + CHUNK)
        if not gap:
            break
        to = end = gap.start()
        for _ in range(longest):
            gap = _GAP.search(text, end)
            while gap and gap.end() < len(text) and _KIND[text[gap.end()]]:
                gap = _GAP.search(text, gap.end())
            end = gap.end() if gap else len(text)
        yield text[at:end], to - at
        at = to
    yield text[at:], len(text)


def counted_phrases(parts: list[tuple[bytes, bytes, int]], orders: tuple[int, ...], frequent: dict[int, np.ndarray]
                    ) -> Iterator[tuple[pa.Array, list[np.ndarray], np.ndarray]]:
    """For each order (words in a phrase) the sorted phrases of ``(language, text, limit)`` and their counts.

    A phrase of more words than ``frequent`` has bit sets for is counted if its parts pass these.
    """
    words, number, first, piece = tokenised(b"\n".join(d for _, d, _ in parts))
    if not len(number):
        return
    langs = pa.array([lang for lang, _, _ in parts], pa.large_binary())
    words, (of_word, of_part) = symbols(words, langs)
    begins = np.cumsum([0, *(len(d) + 1 for _, d, _ in parts)])[:-1]
    part = np.searchsorted(begins, first, side="right") - 1
    starts = first - begins[part] < np.array([limit for _, _, limit in parts])[part]
    unit, names = pd.factorize(of_part[part] << 32 | of_word[number], sort=True)
    columns = [names >> 32, names & 0xFFFFFFFF]
    unit_word = columns[1]
    of = symbol_hashes(words) if frequent else None
    together = np.r_[piece[1:] == piece[:-1], False]
    at, code = np.arange(len(unit)), unit
    for order in range(1, max(orders) + 1):
        if order > 1:
            if order == 2:
                follows = together[at]  # words that remain next to one another
                follows[:-1] &= at[1:] == at[:-1] + 1
                follows[-1:] = False
            else:
                follows = np.r_[at[1:] == at[:-1] + 1, np.zeros(min(len(at), 1), dtype=bool)]
            at = at[follows]
            code, names = pd.factorize(code[follows] << 32 | unit[at + order - 1], sort=True)
            columns = [c[names >> 32] for c in columns] + [unit_word[names & 0xFFFFFFFF]]
        if order in orders:
            weights = np.bincount(code[starts[at]], minlength=len(names)).astype(np.int64)
            seen = weights > 0
            yield words, [c[seen] for c in columns], weights[seen]
        if order in frequent:
            bit = hashes(of, columns) >> np.uint64(64 - FILTER_BITS)
            fine = (frequent[order][bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)[code]
            at, code = at[fine], code[fine]


class Ranges:
    """Which range a phrase lies in: bounds of prefixes, then ``deal`` parts by hash."""

    def __init__(self, bounds: list[tuple[bytes, ...]], deal: int):
        self.bounds, self.deal = bounds, deal

    def split(self, words: pa.Array, columns: list[np.ndarray], weights: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """``(range, rows)`` of the sorted phrases given."""
        n = len(weights)
        known: dict[bytes, tuple[int, bool]] = {}

        def locate(symbol: bytes) -> tuple[int, bool]:
            if symbol not in known:
                p = bisect.bisect_left(range(len(words)), symbol, key=lambda i: words[i].as_py())
                known[symbol] = p, p < len(words) and words[p].as_py() == symbol
            return known[symbol]

        def place(bound: tuple[bytes, ...]) -> int:
            low, high = 0, n
            for c, symbol in zip(columns, bound):
                p, same = locate(symbol)
                after = low + int(np.searchsorted(c[low:high], p))
                if not same:
                    return after
                low, high = after, low + int(np.searchsorted(c[low:high], p, side="right"))
            return low if len(bound) <= len(columns) else high

        places = [0, *(place(b) for b in self.bounds), n]
        part = hashes(symbol_hashes(words), columns) % np.uint64(self.deal) if self.deal > 1 else np.zeros(n, dtype=np.uint64)
        for r, (low, high) in enumerate(zip(places, places[1:])):
            for k in np.unique(part[low:high]):
                yield r * self.deal + int(k), low + np.flatnonzero(part[low:high] == k)

    def blobs(self, words: pa.Array, columns: list[np.ndarray], weights: np.ndarray) -> Iterator[tuple[int, bytes]]:
        for r, rows in self.split(words, columns, weights):
            yield r, Transducer.build(*compact(words, [c[rows] for c in columns], weights[rows])).to_bytes()


def prefix_ranges(docs: DataFrame, range_bytes: int, most_ranges: int, sampled: int, sampled_chars: int = 4000) -> Ranges:
    """Bounds that split the word pairs of a sample evenly, one range for ``range_bytes`` of text."""
    size, n = (int(x or 0) for x in docs.agg(F.sum(F.octet_length("text")), F.count("*")).first())
    wanted = min(most_ranges, size // range_bytes + 1)
    bounds: list[tuple[bytes, ...]] = []
    if wanted > 1:
        rows = docs.select("lang", F.substring(F.col("text").cast("string"), 1, sampled_chars)).sample(min(1.0, sampled / n), 7).limit(2 * sampled).collect()
        parts = [(r[0].encode(), t, len(t)) for r in rows for t in [(r[1] or "").encode()]]
        for words, columns, _ in counted_phrases(parts, (2,), {}) if parts else ():
            picked = np.unique(np.arange(1, wanted) * len(columns[0]) // wanted)
            bounds = sorted({tuple(words[int(c[i])].as_py()[:64] for c in columns) for i in picked})
    return Ranges(bounds, -(-size // (range_bytes * (len(bounds) + 1))) or 1)


def shards(docs: DataFrame, ranges: Ranges, orders: tuple[int, ...], frequent: dict[int, np.ndarray], longest: int) -> DataFrame:
    """``(range, blob)``: the count transducers of all shards."""
    shared = docs.sparkSession.sparkContext.broadcast((ranges, frequent))  # bounded: most_ranges bounds, bit sets of FILTER_BITS

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, frequent = shared.value
        parts: list[tuple[bytes, bytes, int]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for counted in counted_phrases(parts, orders, frequent):
                made = list(ranges.blobs(*counted))
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in made], pa.int64()), pa.array([b for _, b in made], pa.binary())], ["range", "blob"])

        for batch in batches:
            langs = batch.column(0).cast(pa.binary())
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                for data, limit in slices(text or b"", longest):
                    if size + len(data) > CHUNK and parts:
                        yield from flush()
                        parts, size = [], 0
                    parts.append((langs[i].as_py(), data, limit))
                    size += len(data)
        if parts:
            yield from flush()

    return docs.mapInArrow(apply, "range long, blob binary")


def united(blobs: DataFrame, least: int) -> DataFrame:
    """``(range, blob, langs, totals)``: one transducer a range, of phrases seen ``least`` times or more."""
    def unite(group: pa.Table) -> pa.Table:
        *phrases, (langs, totals) = summed([Transducer.from_bytes(b) for b in group["blob"].to_pylist()], least)
        return pa.table([group["range"].slice(0, 1).cast(pa.int64()), pa.array([Transducer.build(*phrases).to_bytes()], pa.binary()),
                         pa.array([[x.decode() for x in langs]], pa.list_(pa.string())), pa.array([totals], pa.list_(pa.int64()))],
                        names=["range", "blob", "langs", "totals"])

    return blobs.groupBy("range").applyInArrow(unite, "range long, blob binary, langs array<string>, totals array<long>")


def bit_set(counts: DataFrame) -> np.ndarray:
    """The bits of the phrases in ``counts``."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                t = Transducer.from_bytes(blob)
                bit = hashes(symbol_hashes(t.words), t.phrases()[0]) >> np.uint64(64 - FILTER_BITS)
                np.bitwise_or.at(bits, bit >> np.uint64(6), np.uint64(1) << (bit & np.uint64(63)))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits[at].view(np.int64))], ["at", "bits"])

    rows = counts.select("blob").mapInArrow(apply, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)  # what is collected is at most this
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return bits


def parts_of(columns: list[np.ndarray]) -> Iterator[tuple[np.ndarray, int, list[np.ndarray], list[np.ndarray]]]:
    """For each place to cut: the candidates that have it, the words before it, and both parts."""
    size = sum((c >= 0).astype(np.int64) for c in columns) - 1  # without the language
    for k in range(1, len(columns) - 1):
        rows = np.flatnonzero(size > k)
        if len(rows):
            ended = np.full(len(rows), -1)
            some = [c[rows] for c in columns]
            yield rows, k, some[:k + 1] + [ended] * (len(columns) - k - 1), [some[0], *some[k + 1:]] + [ended] * k


def lookups(counts: DataFrame, ranges: Ranges) -> DataFrame:
    """``(range, blob)``: for each range the counts of all parts of its candidates."""
    shared = counts.sparkSession.sparkContext.broadcast(ranges)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = Transducer.from_bytes(blob)
                both = [p for _, _, a, b in parts_of(t.phrases()[0]) for p in (a, b)]
                if not both:
                    continue
                asked = np.unique(np.concatenate([np.stack(p, axis=1) for p in both]), axis=0)
                made = list(shared.value.blobs(*compact(t.words, list(asked.T), np.zeros(len(asked), dtype=np.int64))))
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in made], pa.int64()), pa.array([source] * len(made), pa.int64()),
                                                  pa.array([b for _, b in made], pa.binary())], ["range", "source", "blob"])

    def answer(counted: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        for blob in counted["blob"].to_pylist():
            t = Transducer.from_bytes(blob)
            for source, acceptor in zip(asked["source"].to_pylist(), asked["blob"].to_pylist()):
                q = Transducer.from_bytes(acceptor)
                columns, weights = t.compose(q)
                order = np.lexsort(columns[::-1])
                out.append((source, Transducer.build(q.words, [c[order] for c in columns], weights[order]).to_bytes()))
        return pa.table([pa.array([s for s, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], names=["range", "blob"])

    asks = counts.select("range", "blob").mapInArrow(ask, "range long, source long, blob binary")
    return counts.select("range", "blob").groupBy("range").cogroup(asks.groupBy("range")).applyInArrow(answer, "range long, blob binary")


def candidates(counts: DataFrame, ranges: Ranges) -> DataFrame:
    """``(lang, words, a, cuts)``: phrases of two words or more, for each cut the counts of its parts."""
    def join(counted: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for blob in counted["blob"].to_pylist():
            words, columns, weights, _ = summed([Transducer.from_bytes(blob)])
            parts = Transducer.build(*summed([Transducer.from_bytes(b) for b in answers["blob"].to_pylist()])[:3])
            place = pc.fill_null(pc.index_in(words, parts.words), -2).to_numpy().astype(np.int64)
            into = lambda cs: [np.where(c < 0, -1, place[np.maximum(c, 0)]) for c in cs]
            cuts: dict[int, list] = {}
            for rows, k, left, right in parts_of(columns):
                for i, l, r in zip(rows.tolist(), parts.weights(into(left)).tolist(), parts.weights(into(right)).tolist()):
                    if l < 0 or r < 0:
                        raise RuntimeError("a part of a frequent phrase has no count")
                    cuts.setdefault(i, []).append({"k": k, "l": l, "r": r})
            text = [w.decode() for w in words.to_pylist()]
            for i, found in cuts.items():
                names = [text[c[i]] for c in columns if c[i] >= 0]
                out.append((names[0], names[1:], int(weights[i]), found))
        lang, names, a, cuts = zip(*out) if out else ((), (), (), ())
        return pa.table([pa.array(lang, pa.string()), pa.array(names, pa.list_(pa.string())), pa.array(a, pa.int64()), pa.array(
            cuts, pa.list_(pa.struct([("k", pa.int32()), ("l", pa.int64()), ("r", pa.int64())])))], names=["lang", "words", "a", "cuts"])

    answers = lookups(counts, ranges)
    return counts.select("range", "blob").groupBy("range").cogroup(answers.groupBy("range")).applyInArrow(
        join, "lang string, words array<string>, a long, cuts array<struct<k: int, l: long, r: long>>")


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, scale: int = 2_000_000, cover: int = 80, most: int = 2000,
                 range_bytes: int = 8 << 20, most_ranges: int = 4096, sampled: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``most`` best phrases of each language."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    ranges = prefix_ranges(docs, range_bytes, most_ranges, sampled)
    single = cut(united(shards(docs, ranges, (1,), {}, 1), least))
    frequent = {1: bit_set(single)}
    found = single
    if longest > 1:
        pairs = cut(united(shards(docs, ranges, (2,), frequent, 2), least))
        found = found.union(pairs)
    if longest > 2:
        frequent[2] = bit_set(pairs)
        found = found.union(cut(united(shards(docs, ranges, tuple(range(3, longest + 1)), frequent, longest), least)))
    counts = cut(united(found.select("range", "blob"), least))
    totals = (single.select(F.explode(F.arrays_zip("langs", "totals")).alias("t")).groupBy(F.col("t.langs").alias("lang"))
              .agg(F.sum("t.totals").alias("n")))

    wide = lambda c: F.col(c).cast("decimal(38,0)")
    scored = cut(candidates(counts, ranges)).select("lang", "words", "a", F.expr(
        f"array_min(transform(cuts, c -> struct(cast({scale} as decimal(10,0)) * cast(a as decimal(20,0)) div "
        "(cast(c.l as decimal(20,0)) + cast(c.r as decimal(20,0))) as score, c.k as k, c.l as l, c.r as r)))").alias("cut"))
    phrase = F.concat_ws(" ", "words")
    # the parts, of two words or more, of every longer candidate
    inside = (scored.where(F.size("words") > 2)
              .select("lang", "words", "a", F.explode(F.expr("sequence(2, size(words) - 1)")).alias("_m"))
              .select("lang", "words", "a", "_m", F.explode(F.expr("sequence(1, size(words) - _m + 1)")).alias("_i"))
              .groupBy("lang", F.concat_ws(" ", F.slice("words", F.col("_i"), F.col("_m"))).alias("phrase")).agg(F.max("a").alias("longer")))
    kept = (scored.select("lang", phrase.alias("phrase"), "a", "cut.l", "cut.r", "cut.score").join(inside, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * cover)))
    # a language may have most of the phrases: the best of each of its shares first
    place = [F.desc("score"), F.desc("a"), "phrase"]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*place)
    kept = kept.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= most)
    order = Window.partitionBy("lang").orderBy(*place)
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS f
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, string_split(phrase, ' ') AS w, k AS size, f AS a FROM grams WHERE k > 1 AND f >= 30),
places AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
cuts AS (
  SELECT p.lang, p.phrase, p.a, p.k, l.f AS l, r.f AS r, ((2000000::HUGEINT * p.a) // (l.f + r.f))::BIGINT AS score
  FROM places p JOIN grams l ON l.lang = p.lang AND l.phrase = array_to_string(p.w[1:p.k], ' ')
  JOIN grams r ON r.lang = p.lang AND r.phrase = array_to_string(p.w[p.k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
lengths AS (SELECT *, unnest(range(2, size)) AS m FROM candidates),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM lengths) GROUP BY ALL),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, b.l, b.r, t.n, b.score
  FROM lowest b JOIN totals t ON t.lang = b.lang LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * b.a)
SELECT * FROM ranked WHERE rank <= 2000
"""
