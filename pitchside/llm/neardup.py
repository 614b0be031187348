"""MinHash near-duplicates by an inverted join on signature coordinates.

1. A text's set is its distinct shingles of five words (whole, if it has fewer), hashed to 64 bits;
   its signature has, for each of ``coordinates`` hash functions, the least value over the set.
   Documents with equal sets (count and 128-bit fingerprint) form a class; only classes go on.
2. Classes are posted under their coordinate-value pairs.  A pair above the similarity agrees in at
   least ``matches_for(similarity)`` coordinates but for a chance of at most 1.2 in 10,000, so
   pairs that nobody else has need no posting, classes with too few shared pairs drop out, and
   of a class with m shared pairs only the m - matches + 1 rarest are posted (the prefix: two
   classes that agree often enough share one of those).
3. In every list the class that shares most is a centre, and every other member is confirmed
   against it on the full sets; what links is joined to components.  Then only members of different
   components are compared (lists within one component are skipped): collisions are counted over
   whole signatures, and pairs above the match threshold whose first common posted coordinate is the
   list's, and which agree in enough bytes of a longer sketch, are retained and confirmed on the full
   sets.  Lists longer than ``block`` are
   compared block by block, so no task holds more than two blocks of a list.
   Both tests together drop a pair just at the similarity with a chance below 2 in 10,000.
4. The components of all confirmed links label the documents.

No list, partner or candidate is capped.  What remains quadratic is the comparison of signatures
of members that share a list and are not yet joined; it emits nothing below the threshold.

A class's key is its fingerprint; inside, classes go by a number that is unique by construction, and doc_ids only
label the result.

Cases: every row is a document and gives one row.  Null text or text without words has an empty set and is linked
with nothing; repeated rows are copies of each other; rows with one doc_id but different texts are documents of
their own with the same label; rows without doc_id take part, and a component of such rows only has a null label;
empty input gives empty output; other columns do not matter, as only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, column, components, cut, table, unused

WORDS = 5
COORDINATES = 96
#: Coordinates of the first, cheap look at which classes can have partners.
FIRST = 32
CHUNK = 2_000_000
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.random.default_rng(41).integers(1, 1 << 63, size=COORDINATES + WORDS + 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: More hash functions, of which a byte each tells which candidates are worth their full sets.
SKETCH = 416
_MORE = np.random.default_rng(42).integers(1, 1 << 63, size=SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def matches_for(percent: int, coordinates: int = COORDINATES) -> int:
    """How many coordinates a pair of the least similarity agrees in, less 3.8 standard deviations."""
    p = percent / 100
    return max(1, math.floor(coordinates * p - 3.8 * math.sqrt(coordinates * p * (1 - p))))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * _ODD[-1]
    x = (x ^ x >> np.uint64(29)) * _ODD[-2]
    return x ^ x >> np.uint64(32)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of ``data`` and where it begins."""
    a = np.frombuffer(data, dtype=np.uint8)
    edge = np.diff(np.r_[True, _SPACE[a], True].astype(np.int8))
    first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(first):
        return np.zeros(0, dtype=np.uint64), first
    length = end - first
    power = np.cumprod(np.full(int(length.max()), _ODD[-3], dtype=np.uint64))
    inside = np.repeat(first - np.cumsum(length) + length, length) + np.arange(length.sum())
    values = (a[inside].astype(np.uint64) + np.uint64(1)) * power[inside - np.repeat(first, length)]
    return mixed(np.add.reduceat(values, np.cumsum(length) - length)), first


def shingle_sets(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    def of_words(w: np.ndarray) -> np.ndarray:
        if not len(w):
            return w
        if len(w) < WORDS:
            return mixed((w * _ODD[COORDINATES:COORDINATES + len(w)]).sum(keepdims=True) + np.uint64(len(w)))
        n = len(w) - WORDS + 1
        return np.unique(mixed(sum((w[k:k + n] * _ODD[COORDINATES + k] for k in range(WORDS)), np.zeros(n, np.uint64))))

    part: list[bytes] = []

    def flush() -> Iterator[np.ndarray]:
        hashes, first = word_hashes(b"\n".join(part))
        limits = np.searchsorted(first, np.cumsum([0, *(len(t) + 1 for t in part)]))
        yield from (of_words(hashes[a:b]) for a, b in zip(limits, limits[1:]))
        part.clear()

    size = 0
    for text in texts:
        text = (text or b"").lower()
        if size + len(text) > CHUNK and part:
            yield from flush()
            size = 0
        if len(text) <= CHUNK:
            part.append(text)
            size += len(text)
            continue
        found, at = [], 0
        while at < len(text):  # a very long text in slices that end at white space
            to = min(at + CHUNK, len(text))
            while to < len(text) and not _SPACE[text[to]]:
                to += 1
            found.append(word_hashes(text[at:to])[0])
            at = to
        yield of_words(np.concatenate(found))
    if part:
        yield from flush()


def signature(shingles: np.ndarray, functions: np.ndarray = _ODD[:COORDINATES]) -> np.ndarray:
    """The least value of each hash function over the set, its upper 32 bits."""
    least = np.full(len(functions), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[i:i + 2048, None] * functions).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def equal_bytes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many bytes are equal along the last axis of 64-bit words."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    z = x ^ y
    return np.bitwise_count(~(((z & low) + low) | z | low)).sum(axis=-1, dtype=np.int32)


def signatures(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest, n, one, two, signature)``: the MD5 of id and text, the set's size, its fingerprint and its signature."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, values = [], [], [], []
            for s in shingle_sets(batch.column(2).cast(pa.binary()).to_pylist()):
                n.append(len(s))
                one.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                two.append(int(mixed(s * _ODD[-4]).sum(dtype=np.uint64).view(np.int64)))
                values.append(signature(s) if len(s) else None)
            flat = np.concatenate([v for v in values if v is not None]) if any(n) else np.zeros(0, dtype=np.int32)
            offsets = np.cumsum([0, *(0 if v is None else COORDINATES for v in values)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                ["doc_id", "digest", "n", "one", "two", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", digest(), "text").mapInArrow(
        apply, f"doc_id {kind}, digest binary, n long, one long, two long, signature array<int>")


def digest() -> Column:
    """One value for each doc_id and text; rows that repeat both share it."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("n")), F.lit(":"), "text")
    return F.unhex(F.md5(key.cast("binary"))).alias("digest")


def label(doc_id: str = "doc_id") -> Column:
    """Orders the rows of a class: by doc_id, null last, then by text."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"), F.col("digest"))


def full_sets(texts: DataFrame) -> DataFrame:
    """``(id, shingles, sketch)`` of the texts given as ``(id, text)``."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(1).cast(pa.binary()).to_pylist()
            for i in range(0, len(data), 256):
                sets = list(shingle_sets(data[i:i + 256]))
                offsets = np.cumsum([0, *map(len, sets)])
                sketch = [signature(x, _MORE).astype(np.uint8).tobytes() for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 256), pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(np.concatenate(sets).view(np.int64))),
                     pa.array(sketch, pa.binary())], ["id", "shingles", "sketch"])

    return texts.select("id", "text").mapInArrow(apply, "id long, shingles array<bigint>, sketch binary")


def tokens(classes: DataFrame, first: int = COORDINATES) -> DataFrame:
    """``(id, token)``: the coordinate-value pairs as one number."""
    values = F.slice("signature", 1, first) if first < COORDINATES else F.col("signature")
    return classes.select("id", F.posexplode(values).alias("k", "v")).select(
        "id", (F.shiftleft(F.col("k").cast("long"), 32) + F.col("v").cast("long").bitwiseAND(0xFFFFFFFF)).alias("token"))


def shared(pairs: DataFrame) -> DataFrame:
    """The coordinate-value pairs that at least two classes have, with their number."""
    return pairs.join(pairs.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "token")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets are similar enough."""
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("s")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("t")), "b"))
    common = F.size(F.array_intersect("s", "t"))
    return both.where(100 * common >= percent * (F.size("s") + F.size("t") - common)).select("a", "b")


def compare_lists(postings: DataFrame, members: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components that agree in enough coordinates and sketch bytes.

    ``postings`` has ``token, id, component``, ``members`` by ``id`` the ``signature``, the ``posted``
    coordinates and the ``sketch``; only postings of lists with several components meet
    them.  Each pair comes once, from the list of its first common posted coordinate.
    """
    per = postings.groupBy("token").agg(F.count("*").alias("_n"), F.min("component").alias("_low"), F.max("component").alias("_high"))
    per = per.where("_low <> _high").select("token", F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")
    dealt = (postings.join(per, "token").withColumn("_own", own)
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .select("token", "id", "component", "_own", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"))
             .join(members, "id"))
    matches, alike = matches_for(percent), matches_for(percent, SKETCH)

    def compare(group: pa.Table) -> pa.Table:
        group, n = group.combine_chunks(), group.num_rows
        column = lambda name: group[name].to_numpy()
        ids, parts, block_of = column("id"), column("component"), column("_own")
        values = group["signature"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        coordinates = group["posted"].combine_chunks()
        posted = np.zeros(values.shape, dtype=bool)
        posted[np.repeat(np.arange(n), coordinates.value_lengths().to_numpy()), coordinates.flatten().to_numpy()] = True
        sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), dtype=np.uint64).reshape(n, -1)
        rough = np.ascontiguousarray(values.astype(np.uint8)).view(np.uint64)  # equal values have equal low bytes
        here, within = int(column("token")[0]) >> 32, column("_i")[0] == column("_j")[0]
        out: list[np.ndarray] = []
        for k in range(0, n, 32):
            rows, after = np.arange(k, min(k + 32, n)), np.arange(k + 1, n)
            open_ = (parts[after] != parts[rows, None]) & (after > rows[:, None])
            if not within:
                open_ &= block_of[after] != block_of[rows, None]
            if not open_.any():
                continue
            r, c = np.nonzero(open_ & (equal_bytes(rough[rows, None], rough[None, after]) >= matches))
            r, c = rows[r], after[c]
            same = values[r] == values[c]
            kept = (same.sum(axis=1) >= matches) & ~(same[:, :here] & posted[r, :here] & posted[c, :here]).any(axis=1)
            r, c = r[kept], c[kept]
            kept = equal_bytes(sketch[r], sketch[c]) >= alike
            out.append(np.stack([ids[r[kept]], ids[c[kept]]]))
        found = np.sort(np.concatenate(out, axis=1), axis=0) if out else np.zeros((2, 0), dtype=np.int64)
        return pa.table({"a": found[0], "b": found[1]})

    return dealt.groupBy("token", "_i", "_j").applyInArrow(compare, "a long, b long")


CLASS = ["n", "one", "two"]


def grouped(docs: DataFrame, percent: int = 80, block: int = 2000) -> tuple[DataFrame, DataFrame]:
    """The signed documents, and the classes ``(n, one, two, least, id, component)`` of those with words.

    Documents link if ``100 * intersection >= percent * union`` of their sets.  ``least`` is the document
    of the class with the least doc_id (null last), as :func:`label` has it.
    """
    matches = matches_for(percent)
    signed = cut(signatures(docs))
    # the numbers are fixed with the checkpoint
    classes = cut(signed.where("n > 0").groupBy(*CLASS).agg(F.min(label()).alias("least"), F.first("signature").alias("signature"))
                  .withColumn("id", F.monotonically_increasing_id()))

    looked = shared(tokens(classes, FIRST)).groupBy("id").count()
    near = looked.where(F.col("count") >= matches - (COORDINATES - FIRST)).select("id")
    some = cut(classes.join(near, "id", "left_semi").select("id", "n", "signature"))
    listed = (shared(tokens(some)).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
              .where(F.size("t") >= matches)
              .select("id", F.size("t").alias("m"), F.slice("t.token", F.lit(1), F.size("t") - matches + 1).alias("tokens")))
    listed = cut(listed.join(some, "id"))
    postings = listed.select("id", "n", "m", F.explode("tokens").alias("token"))

    fits = 100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")
    centres = (postings.groupBy("token").agg(F.max(F.struct("m", "id", "n")).alias("c"))
               .select("token", F.col("c.id").alias("b"), F.col("c.n").alias("n_b")))
    stars = cut(postings.join(centres, "token").where((F.col("id") != F.col("b")) & fits)
                .select(F.col("id").alias("a"), "b").distinct())
    # every class with a list that holds another: the text of its least document is read once more for the full set
    crowded = shared(postings.select("id", "token")).select("id").distinct()
    crowded = cut(crowded.join(classes, "id").select("id", F.col("least.digest").alias("digest")))
    texts = docs.select(digest(), "text").join(crowded, "digest").dropDuplicates(["digest"])
    sets = cut(full_sets(texts))
    links = cut(confirmed(stars, sets, percent))
    joined = components(listed.select("id", "tokens"), links)

    posted = F.transform("tokens", lambda t: F.shiftright(t, 32).cast("tinyint"))
    members = listed.join(sets.select("id", "sketch"), "id").select("id", "signature", posted.alias("posted"), "sketch")
    postings = joined.select("id", "component", F.explode("tokens").alias("token"))
    links = links.union(cut(confirmed(compare_lists(postings, members, percent, block), sets, percent)))
    return signed, components(classes.select(*CLASS, "least", "id"), links)


def chosen_of(classes: DataFrame) -> DataFrame:
    """``(component, chosen)``: the document that stands for each component."""
    return classes.groupBy("component").agg(F.min("least").alias("chosen"))


def near_duplicates(docs: DataFrame, percent: int = 80, block: int = 2000) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, a row per document: the least doc_id of its
    component, and whether that is its own."""
    signed, classes = grouped(docs, percent, block)
    by_class = classes.join(chosen_of(classes), "component").select(*CLASS, "chosen")
    component = F.when(F.col("chosen").isNull(), F.col("doc_id")).otherwise(F.col("chosen.doc_id"))
    return signed.join(by_class, CLASS, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = 80, block: int = 2000) -> DataFrame:
    """``docs``, all columns, with one row of each component of near copies, the one with the least doc_id
    (of equal ones the least digest; of rows that repeat id and text any one).  Rows without words all stay."""
    _, classes = grouped(docs, percent, block)
    (name,) = unused(docs, "_digest")
    one = chosen_of(classes).select(F.col("chosen.digest").alias(name)).distinct()
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rest = [column(c) for c in docs.columns]
    kept = docs.where(worded).withColumn(name, digest()).join(one, name, "left_semi").dropDuplicates([name])
    return kept.select(*rest).union(docs.where(~worded))


def op4_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), percent=85)
