"""Mixing sources to target weights.

Tokens (words) are summed per source, every source gets a target and from it a repetition rate,
and each document is emitted ``floor(rate)`` times plus one more copy when a number hashed from
the seed and its id falls below the rate's fraction.

Targets share the total of all sizes in proportion to the weights.  A source stops at
``max_repeat`` times its own size and what it cannot take is shared again by weight among the
others.  That has a closed form: order the sources by size per weight; the sources before some
place stop at their limit and the rest split what is left by weight.  All comparisons that decide
the place are in whole numbers.

Cases: null text has size 0; a null source is a source of its own, last in order; a source whose
size is 0 has rate 0 and emits nothing; rows with the same id draw the same number; rows without id draw by their
text, source and number among those that are equal in both, so copies draw apart; empty input
gives empty output; other columns travel along unless they bear the name of an added column, which
is then replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, column, cut, table, unit_hash, unused

ADDED = ("size", "source_size", "target", "rate", "copies")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """``(source, source_size, target, rate)`` from rows ``(source, size)``.

    Sources take the weights in order of their code points, repeating, null last.  The windows run
    over one row per source, so over the number of sources, which the documents do not set.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]),
                        (F.row_number().over(order) - 1) % len(weights) + 1)
    per = (per.withColumn("weight", pick)
           .withColumn("limit", F.lit(int(max_repeat)) * F.col("source_size")))
    everything = Window.partitionBy()
    by_limit = Window.orderBy(F.expr("limit / cast(weight as double)"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    per = (per
           .withColumn("total", F.sum("source_size").over(everything))
           .withColumn("left_over", F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
           .withColumn("weight_left", F.sum("weight").over(after))
           .withColumn("open", F.expr("cast(left_over as decimal(38,0)) * weight"
                                      " <= cast(limit as decimal(38,0)) * weight_left"))
           .withColumn("place", F.row_number().over(by_limit))
           .withColumn("first_open", F.min(F.when(F.col("open"), F.col("place"))).over(everything)))
    at = F.col("place") == F.col("first_open")
    per = (per.withColumn("share", F.max(F.when(at, F.col("left_over").cast("double"))).over(everything))
           .withColumn("share_weight", F.max(F.when(at, F.col("weight_left").cast("double"))).over(everything)))
    target = F.when(F.col("place") < F.col("first_open"), F.col("limit").cast("double")).otherwise(
        F.least(F.col("limit").cast("double"), F.expr("share * weight / share_weight")))
    per = per.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return per.select("source", "source_size", "target", rate.alias("rate"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3,
                seed: int = 20, salts: int = 64) -> DataFrame:
    """The documents with ``size, source_size, target, rate, copies``.

    Rates reach the documents by a join on (source, salt): a source that holds a third of all rows
    is spread over ``salts`` keys, and the rates, one row per source, are repeated per salt.
    """
    docs = docs.drop(*ADDED)
    key, salt, draw, copy_of = unused(docs, "_key", "_salt", "_draw", "_text")
    sized = docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    rates = source_targets(sized.select("source", "size"), weights, max_repeat)
    name = F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit("")))
    rates = rates.select(name.alias(key), "source_size", "target", "rate",
                         F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(salt))
    named = sized.where("doc_id is not null").withColumn(draw, F.col("doc_id").cast("string"))
    nameless = cut(sized.where("doc_id is null").withColumn(copy_of, F.concat_ws(":", F.md5(F.coalesce("text", F.lit("")).cast("binary")), name)))
    nameless = ordinals(nameless, copy_of, draw).withColumn(draw, F.concat_ws(":", copy_of, draw)).drop(copy_of)
    drawn = named.unionByName(nameless).withColumn(salt, F.pmod(F.xxhash64(draw), F.lit(salts)).cast("int")).withColumn(key, name)
    chance = unit_hash(F.lit(str(seed)), F.col(draw))
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    mixed = drawn.join(rates, [key, salt]).withColumn("copies", copies)
    return mixed.select(*[column(c) for c in docs.columns], *ADDED)


def ordinals(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` (checkpointed) with a number from 0 among those of equal ``key``.

    Rows are numbered within their partitions, and partitions get offsets, so a key that all rows share is
    numbered by as many tasks as there are partitions.
    """
    place, part, first = unused(rows, "_place", "_part", "_first")
    rows = rows.withColumn(place, F.monotonically_increasing_id()).withColumn(part, F.shiftright(place, 33))
    per = rows.groupBy(key, part).agg(F.count("*").alias(first))
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn(first, F.coalesce(F.sum(first).over(before), F.lit(0)))
    own = F.row_number().over(Window.partitionBy(key, part).orderBy(place)) - 1
    return rows.withColumn(name, own).join(per, [key, part]).withColumn(name, F.col(name) + F.col(first)).drop(place, part, first)


def emit_copies(mixed: DataFrame) -> DataFrame:
    """One row for each copy that the mix takes, with the columns the documents came with."""
    (copy,) = unused(mixed, "_copy")
    rows = mixed.where("copies > 0").withColumn(copy, F.explode(F.expr("sequence(1, copies)")))
    return rows.drop(copy, *ADDED)


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(doc_id::VARCHAR, md5(coalesce(text, '')) || ':' || coalesce('s' || source, 'n') || ':' ||
           (row_number() OVER (PARTITION BY doc_id, text, source) - 1)) AS draw
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, 3 * source_size AS lim,
         row_number() OVER (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST) AS place,
         sum(source_size) OVER () AS total
  FROM s
), p AS (
  SELECT *, total - coalesce(sum(lim) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM o
), f AS (
  SELECT place AS first_open, left_over::DOUBLE AS share, weight_left::DOUBLE AS share_weight
  FROM p WHERE left_over::HUGEINT * weight <= lim::HUGEINT * weight_left ORDER BY place LIMIT 1
), t AS (
  SELECT source, source_size,
         CASE WHEN place < first_open THEN lim::DOUBLE ELSE least(lim::DOUBLE, share * weight / share_weight) END AS target
  FROM p, f
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM t
)
SELECT d.doc_id, d.size, r.source_size, r.target,
       (d.size * (floor(rate)::BIGINT + CASE WHEN ('0x' || substr(md5('20:' || d.draw), 1, 13))::BIGINT::DOUBLE
                                / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""
