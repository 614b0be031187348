"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pitchside.session import ensure_checkpoint_dir

#: A word: a maximal run without space, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A corpus table of ``sf_dir``, only the named columns (all when none is named)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where ``df`` has columns of that name (in whatever case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


def column(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def map_rows(df: DataFrame, apply: Callable, *added: StructField) -> DataFrame:
    """``mapInArrow`` over all columns, which it gives back with the ``added`` ones: columns go by
    place, as ``mapInArrow`` cannot take every name."""
    fields = [StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema)]
    mapped = df.toDF(*[f.name for f in fields]).mapInArrow(apply, StructType([*fields, *added]))
    return mapped.toDF(*df.columns, *[f.name for f in added])


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder ``spark.checkpoint.dir`` names: lineage ends there,
    and the rows survive the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def unit_hash(*parts: Column) -> Column:
    """Uniform number in [0, 1) from the text of the parts: the first 52 bits of their MD5.
    Reruns, retries and other partitionings give the same number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def held_out(doc_id: Column) -> Column:
    """True for documents that no classifier learns from: crc32 of the id's text mod 5 is 0 (a null id is ``''``)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 60, rows_each: int = 200_000) -> DataFrame:
    """Connected components: ``vertices`` with ``component``, the smallest id reachable.

    ``vertices`` has ``id`` and any other columns, ``edges`` has ``a, b`` (any direction, repeats and loops allowed).
    Alternates large-star and small-star steps, so the number of rounds grows with the logarithm
    of the longest path.  Every step keeps one row per edge, and a star of any size costs one row per
    edge; AQE splits a skewed centre in the joins.  Each round is checkpointed, in partitions of
    about ``rows_each`` edges: rounds over few edges leave few files.
    """
    now = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    parts = now.count() // rows_each + 1
    previous = None
    for _ in range(max_rounds):
        # large star: hang every neighbour greater than the vertex on the least neighbour
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        big = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a <> b").coalesce(parts)
        # small star: hang the vertex and its smaller neighbours on the least neighbour
        least = big.groupBy("b").agg(F.min("a").alias("m"))
        now = cut(big.join(least, "b").selectExpr("m as a", "if(a = m, b, a) as b").where("a <> b").coalesce(parts))
        sign = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if sign == previous:
            break
        previous = sign
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.groupBy("b").agg(F.min("a").alias("component"))
    return vertices.join(roots, vertices["id"] == roots["b"], "left").select(
        *[vertices[c] for c in vertices.columns], F.coalesce("component", vertices["id"]).alias("component"))
