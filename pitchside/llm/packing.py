"""Best-fit packing of tokenised documents with dominance reduction.

Documents become token counts (one row per piece of at most ``capacity`` tokens).  All that the
packing decides on is how many pieces there are of each length, a table of at most ``capacity``
rows however many documents there are; only that table reaches the driver.

1. Reduction (Martello and Toth): for a length ``j`` a set of pieces that provably dominates every
   other set holding ``j`` is fixed as a sequence, for all copies at once: ``j`` alone if nothing
   else fits; ``j`` and the length that fills the rest exactly; ``j`` and the largest that fits if
   no two others fit, or if it is at least as long as any two that fit; ``j``, the largest and
   the next largest if no three others fit and no pair beats them place by place.  Passes go on
   until one fixes nothing.
2. The remainder is packed best-fit in decreasing length, again for all equal sequences at once.

Pieces carry their token ids, so a sequence is its pieces' ids in order of ``offset``.

The result of the packing is a list of patterns with multiplicities.  Pieces of a length are numbered (per hash
bucket, with the buckets' offsets, so that a length that a third of all pieces share is split) and a
piece's number says which pattern, copy and place it takes.

Cases: null text is empty and gives the closing token only; longer documents than ``capacity`` are
cut, whole texts are tokenised; repeated rows are packed once each; empty input gives empty
output; other columns and clashing names do not matter, as only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, cut, table, unused

CAPACITY = 4096
CLOSING = 1
#: Words and pieces that a task remembers, about 200 bytes each; the others are encoded again each time.
REMEMBERED = 1_000_000
#: Words of these characters are lower-cased and split as below; their normal form is themselves.
_PLAIN = re.compile("(?!.*<\\|)[!-~À-ÖØ-öø-ÿ]+")
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
#: The steps of a tokenizer (its own description of them) that the word-by-word way below follows.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def by_words(tokenizer) -> bool:
    """Whether the tokenizer works in the steps that ``word_encoder`` follows: its added tokens must be
    special ones between ``<|`` and ``|>``, without options."""
    steps = json.loads(tokenizer.to_str())
    plain = all(t["content"].startswith("<|") and t["content"].endswith("|>") and not re.search(r"\s", t["content"]) and t["special"]
                and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in steps["added_tokens"])
    model = steps["model"]
    return (plain and steps["normalizer"] == NORMALIZER and steps["pre_tokenizer"] == PRE_TOKENIZER
            and model["type"] == "BPE" and not model["dropout"] and not (steps["truncation"] or steps["padding"]))


def word_encoder(tokenizer):
    """Word (bytes without ASCII white space) to its ids as little-endian bytes, if the tokenizer goes ``by_words``.

    Such a tokenizer never joins text across white space, so a text's ids are those of its words in
    order.  Words of plain Latin letters go to its model piece by piece; the others through the
    whole tokenizer.
    """
    tokenize, encode = tokenizer.model.tokenize, tokenizer.encode

    class Words(dict):
        def __missing__(self, word: bytes) -> bytes:
            text = word.decode()
            if _LETTERS.fullmatch(text):
                ids = [t.id for t in tokenize(text if text.isascii() else word.decode("latin-1").translate(_BYTE))]
            elif not _PLAIN.fullmatch(text):
                ids = encode(text, add_special_tokens=False).ids
            else:
                pieces = _PIECE.findall(text.lower())
                if len(pieces) > 1 or _LETTERS.fullmatch(pieces[0]):
                    got = b"".join([self[p.encode()] for p in pieces])
                    return self.setdefault(word, got) if len(self) < REMEMBERED else got
                ids = [t.id for t in tokenize(pieces[0].encode().decode("latin-1").translate(_BYTE))]
            got = array("I", ids).tobytes()
            return self.setdefault(word, got) if len(self) < REMEMBERED else got

    return Words()


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, ids)`` of every document's ids with the closing id.

    ``ids`` are little-endian, of two bytes each if the vocabulary fits and else of four (``read_ids``);
    the checksum is that of four bytes each.  A tokenizer that does not go ``by_words`` encodes every text whole.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, ids binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        if by_words(tokenizer):
            words = word_encoder(tokenizer)
            encoded = lambda text: b"".join(map(words.__getitem__, text.split()))
        else:
            encoded = lambda text: array("I", tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()
        wide = max(tokenizer.get_vocab().values(), default=0) >= 1 << 16
        step, close = 4 * capacity, CLOSING.to_bytes(4, "little")
        for batch in batches:
            at, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                ids = encoded(text.as_py() or b"") + close
                for k in range(0, len(ids), step):
                    part = ids[k:k + step]
                    at.append(i)
                    piece.append(k // step)
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    kept.append(part if wide else np.frombuffer(part, "<u4").astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def read_ids(ids: bytes, length: int) -> np.ndarray:
    """The token ids of a piece of ``length`` tokens."""
    return np.frombuffer(ids, f"<u{len(ids) // length}").astype(np.int64)


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Fix dominating sets; takes the pieces used out of ``counts`` and returns ``(runs, times)``,
    runs being ``(length, how many)``."""
    fixed = []
    sizes = [int(s) for s in np.flatnonzero(counts)]  # ascending, kept up to date

    def largest(limit: int, used: dict[int, int]) -> int:
        """The largest length up to ``limit`` that is left beside ``used``, or 0."""
        i = bisect.bisect_right(sizes, limit) - 1
        while i >= 0 and counts[sizes[i]] <= used.get(sizes[i], 0):
            i -= 1
        return sizes[i] if i >= 0 else 0

    def smallest(n: int, used: dict[int, int]) -> int:
        """Sum of the ``n`` smallest beside ``used``; past any capacity if there are fewer."""
        out, need = 0, n
        for s in sizes:
            take = min(need, int(counts[s]) - used.get(s, 0))
            out, need = out + max(take, 0) * s, need - max(take, 0)
            if not need:
                return out
        return capacity + 1

    def best_pair(rest: int, used: dict[int, int]) -> tuple[int, int]:
        """Largest sum of a pair that fits ``rest``, and the largest smaller half of any such pair."""
        top, half, seen = 0, 0, bisect.bisect_right(sizes, rest)
        for x in sizes[:seen]:
            if counts[x] > used.get(x, 0):
                y = largest(rest - x, used | {x: used.get(x, 0) + 1})
                if y:
                    top, half = max(top, x + y), max(half, min(x, y))
        return top, half

    changed = True
    while changed:
        changed = False
        for j in reversed(list(sizes)):
            while counts[j]:
                used, rest = {j: 1}, capacity - j
                k = largest(rest, used)
                mates = None
                if k == 0 or k == rest or rest < smallest(2, used):
                    mates = [k] if k else []
                elif rest < smallest(3, used):
                    top, half = best_pair(rest, used)
                    if k >= top:
                        mates = [k]
                    else:
                        b = largest(rest - k, used | {k: used.get(k, 0) + 1})
                        if b >= half:
                            mates = [k, b]
                if mates is None:
                    break
                runs: dict[int, int] = {}
                for s in (j, *mates):
                    runs[s] = runs.get(s, 0) + 1
                times = min(int(counts[s]) // n for s, n in runs.items())
                for s, n in runs.items():
                    counts[s] -= n * times
                fixed.append((list(runs.items()), times))
                changed = True
        sizes = [s for s in sizes if counts[s]]
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing over the lengths, all equal sequences at once."""
    open_: dict[int, list] = {}  # free tokens: [(runs, times)]
    free: list[int] = []

    def put(rest: int, runs: list, times: int) -> None:
        if rest not in open_:
            open_[rest] = []
            bisect.insort(free, rest)
        open_[rest].append((runs, times))

    for w in map(int, np.flatnonzero(counts)[::-1]):
        n = int(counts[w])
        while n:
            i = bisect.bisect_left(free, w)
            if i < len(free):
                rest = free[i]
                runs, times = open_[rest].pop()
                if not open_[rest]:
                    del open_[rest], free[i]
            else:
                rest, runs, times = capacity, [], n
            each = min(rest // w, n)
            filled = min(times, n // each)
            if times > filled and runs:
                put(rest, runs, times - filled)
            put(rest - each * w, [*runs, (w, each)], filled)
            n -= filled * each
    return [group for groups in open_.values() for group in groups]


def pack(pieces: DataFrame, capacity: int = CAPACITY, buckets: int = 256) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``doc_id, piece, length`` are read, other columns travel along."""
    pieces = cut(pieces.drop("sequence_id", "offset"))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        counts[r["length"]] = r["count"]
    patterns = reduce_by_dominance(counts, capacity)
    patterns += best_fit(counts, capacity)

    rows, taken, sequence = [], np.zeros(capacity + 1, dtype=np.int64), 0
    for runs, times in patterns:
        place = 0
        for w, each in runs:
            rows.append((w, int(taken[w]), sequence, each, place))
            taken[w] += each * times
            place += w * each
        sequence += times
    rows.sort()
    plan = pieces.sparkSession.sparkContext.broadcast(np.array(rows, dtype=np.int64).reshape(-1, 5))

    place_, bucket, total, first, number, at = unused(pieces, "_place", "_bucket", "_n", "_first", "_number", "_at")
    numbered = pieces.withColumn(place_, F.monotonically_increasing_id())  # fixed by the checkpoint
    # rows without id and rows that repeat go to different buckets too
    numbered = numbered.withColumn(bucket, F.pmod(F.xxhash64("doc_id", "piece", place_), F.lit(buckets)).cast("int"))
    per = numbered.groupBy("length", bucket).agg(F.count("*").alias(total))
    before = Window.partitionBy("length").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn(first, F.coalesce(F.sum(total).over(before), F.lit(0))).drop(total)
    order = Window.partitionBy("length", bucket).orderBy("doc_id", "piece", place_)
    numbered = (numbered.withColumn(number, F.row_number().over(order).cast("long") - 1)
                .join(per, ["length", bucket]).withColumn(number, F.col(first) + F.col(number)))

    @F.pandas_udf("long")
    def place(length: pd.Series, number: pd.Series) -> pd.Series:
        t = plan.value
        w, n = length.to_numpy(), number.to_numpy()
        at = np.searchsorted(t[:, 0] << 48 | t[:, 1], w << 48 | n, side="right") - 1
        q = n - t[at, 1]
        return pd.Series((t[at, 2] + q // t[at, 3]) * capacity + t[at, 4] + q % t[at, 3] * w)

    placed = numbered.withColumn(at, place("length", number))  # only two columns go to Python
    return placed.select(*[column(c) for c in pieces.columns],
                         F.expr(f"{at} div {capacity}").alias("sequence_id"), (F.col(at) % capacity).alias("offset"))


def op1_pack(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = token_pieces(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces).drop("ids")
