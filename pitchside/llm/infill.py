"""Fill-in-middle transformation by a wavelet matrix over character classes.

The bytes of many texts, end to end, form one sequence of character classes; UTF-8 continuation bytes
are a class of their own.  A wavelet matrix over it (``LEVELS`` bit vectors with running
counts) answers how often a class occurs before any place.  All else is rank queries: the ranks of the
classes that end a unit add up to a text's number of units, a bisection on those sums finds
the byte where the wanted unit ends, and the rank of the continuation bytes turns bytes into code points.  All
texts of a slice are asked at once.

Which units end the prefix and the middle, and which form a text takes, comes from a hash of its id,
so reruns agree.  Python returns three numbers a text; texts are cut, put together and hashed by Spark.

Cases: null text counts as empty; empty texts and texts that hold a mark stay as they are (form ``plain``); a null
id is hashed as no digits, so all such rows draw alike; a text of any length is one sequence, texts are otherwise handled
in slices of ``SLICE`` bytes; repeated rows get equal results; empty input gives empty output; other
columns travel along, except that one named like the result column gives way to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

#: Character classes; the numbers need ``LEVELS`` bits.
OTHER, BLANK, LINE, SENTENCE, CONTINUATION = range(5)
LEVELS = 3
#: Which classes end a unit.
UNITS = {"line": (LINE,), "sentence": (LINE, SENTENCE), "word": (LINE, BLANK)}
MARKS = ("<P>", "<S>", "<M>")
SLICE = 8 << 20

_CLASS = np.full(256, OTHER, dtype=np.uint8)
_CLASS[[0x20, 0x09]] = BLANK
_CLASS[0x0A] = LINE
_CLASS[[ord(c) for c in ".!?"]] = SENTENCE
_CLASS[0x80:0xC0] = CONTINUATION

CUTS = T.StructType([T.StructField("n", T.LongType()), T.StructField("prefix", T.LongType()), T.StructField("middle", T.LongType())])


class WaveletMatrix:
    """Ranks of classes in a sequence of them.

    Level by level, from the highest bit, elements with a 0 go stably before those with a 1.  Of each
    level its bits are kept, 64 to a word, and how many ones precede each word.
    """

    def __init__(self, classes: np.ndarray):
        self.bits, self.before, self.zeros = [], [], []
        for level in reversed(range(LEVELS)):
            one = (classes >> level & 1).astype(bool)
            words = np.zeros(len(classes) // 64 + 1, dtype=np.uint64)
            packed = np.packbits(one, bitorder="little")
            words.view(np.uint8)[:len(packed)] = packed
            self.bits.append(words)
            self.before.append(np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]])
            self.zeros.append(len(classes) - int(np.count_nonzero(one)))
            classes = np.concatenate([classes[~one], classes[one]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.bits[level][word] & below)

    def rank(self, kind: int, at: np.ndarray) -> np.ndarray:
        """How often class ``kind`` occurs before each place of ``at``."""
        first, at = np.zeros(1, dtype=np.int64), np.asarray(at, dtype=np.int64)
        for level in range(LEVELS):
            a, b = self._ones(level, first), self._ones(level, at)
            if kind >> (LEVELS - 1 - level) & 1:
                first, at = self.zeros[level] + a, self.zeros[level] + b
            else:
                first, at = first - a, at - b
        return at - first

    def ranks(self, kinds: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        return sum(self.rank(k, at) for k in kinds)

    def bisect(self, kinds: tuple[int, ...], wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least place in (low, high] before which the classes occur ``wanted`` times, or high."""
        low, high = low.copy(), high.copy()
        while (low < high).any():
            middle = (low + high) // 2
            enough = self.ranks(kinds, middle) >= wanted
            high = np.where(enough, middle, high)
            low = np.where(enough, low, np.minimum(middle + 1, high))
        return high


def cuts(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray, kinds: tuple[int, ...]) -> tuple[np.ndarray, ...]:
    """For the texts ``data[offsets[i]:offsets[i + 1]]``: units, and code points of the prefix and of the middle."""
    classes = _CLASS[data]
    matrix, first, end = WaveletMatrix(classes), offsets[:-1], offsets[1:]
    before = matrix.ranks(kinds, first)
    # the last unit need not end with one of the classes
    loose = (end > first) & ~np.isin(classes[np.maximum(end, 1) - 1], kinds) if len(classes) else np.zeros(len(first), dtype=bool)
    n = matrix.ranks(kinds, end) - before + loose
    points = lambda at: at - matrix.rank(CONTINUATION, at)
    places = []
    for units in (np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))):
        at = matrix.bisect(kinds, before + units, first, end)
        places.append(points(np.where(units == 0, first, at)))
    return n, places[0] - points(first), places[1] - places[0]


def cut_points(text: Column, h1: Column, h2: Column, unit: str = "line") -> Column:
    """``struct<n, prefix, middle>``: the units of a text and the lengths in code points of prefix and middle,
    which end after ``h1 % (n + 1)`` and ``h2 % (n + 1)`` units, the smaller first."""
    kinds = UNITS[unit]

    def ask(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        texts, out = texts.cast(pa.large_binary()), []
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        h1, h2 = one.to_numpy(zero_copy_only=False).astype(np.int64), two.to_numpy(zero_copy_only=False).astype(np.int64)
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, side="right")) - 1)
            out.append(np.stack(cuts(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], h1[i:j], h2[i:j], kinds)))
            i = j
        columns = np.concatenate(out, axis=1) if out else np.zeros((3, 0), dtype=np.int64)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=CUTS.names)

    return F.arrow_udf(ask, CUTS)(F.coalesce(text, F.lit("")), h1, h2)


def check_marks(marks: tuple[str, str, str]) -> None:
    """Marks must not be able to overlap, or an output could be read in two ways."""
    for a in marks:
        for b in marks:
            if not a or (a != b and b in a) or any(a.endswith(b[:k]) for k in range(1, len(b))):
                raise ValueError(f"marks {marks} may overlap")
    if len(set(marks)) < len(marks):
        raise ValueError(f"marks {marks} are not distinct")


def fill_in_middle(docs: DataFrame, unit: str = "line", seed: int = 7, percent: int = 100, spm_percent: int = 50,
                   marks: tuple[str, str, str] = MARKS, column: str = "fim") -> DataFrame:
    """``docs`` with the struct ``column``: ``n`` units, ``form`` (plain, psm, spm), ``prefix_chars``,
    ``middle_chars`` (null if plain) and the ``output`` text.

    ``percent`` of the texts are transformed, ``spm_percent`` of these to suffix, prefix, middle, the others to prefix,
    suffix, middle; ``marks`` stand before prefix, suffix and middle.
    """
    check_marks(marks)
    docs = docs.drop(column)
    rest = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]
    text = F.coalesce("text", F.lit(""))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = [F.conv(F.substring(key, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]
    p, s, m = (F.lit(x) for x in marks)
    plain = (text == "") | text.contains(p) | text.contains(s) | text.contains(m) | (h[2] % 100 >= percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    asked = docs.select(*rest, F.struct(cut_points(F.col("text"), h[0], h[1], unit).alias("c"), form.alias("form")).alias(column))
    at = lambda name: F.col(f"`{column.replace('`', '``')}`.{name}")
    # substring counts in int; a string of Spark's has fewer characters than that
    end = (at("c.prefix") + at("c.middle")).cast("int")
    prefix = F.substring(text, F.lit(1), at("c.prefix").cast("int"))
    middle = F.substring(text, (at("c.prefix") + 1).cast("int"), at("c.middle").cast("int"))
    suffix = F.substring(text, end + 1, F.length(text))
    whole = at("form") == "plain"
    output = (F.when(whole, text).when(at("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
              .otherwise(F.concat(s, suffix, p, prefix, m, middle)))
    return asked.withColumn(column, F.struct(
        at("c.n").alias("n"), at("form").alias("form"), F.when(~whole, at("c.prefix")).alias("prefix_chars"),
        F.when(~whole, at("c.middle")).alias("middle_chars"), output.alias("output")))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from."""
    p, s, m = marks

    def between(first: str, then: str | None) -> Column:
        start = F.instr(output, first) + len(first)
        return F.substring(output, start, F.instr(output, then) - start if then else F.length(output))

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents", "doc_id", "text"))
    return made.select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2(F.col("fim.output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("fim.output"), F.col("fim.form")).cast("binary"), 256).alias("restored_sha256"))


SQL = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
  FROM documents),
drawn AS (
  SELECT doc_id, text, lines, len(lines) AS n,
         ('0x' || substr(h, 1, 8))::BIGINT % (len(lines) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(lines) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(lines[1:least(c1, c2)], '') AS p,
         array_to_string(lines[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(lines[greatest(c1, c2) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
