"""P9 with the aliases as a table of any size.

:func:`pitchside.functions.text.canonical_team` looks names up in a map literal, which suits a few dozen fixed aliases.
Here the alias dimension is a DataFrame: names join it on their stripped, lower-cased text, so Spark broadcasts it by
its size or shuffles both sides.  A raw name with two different canonical names is refused when the
table is used, and names that neither an alias nor a team explains can be reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.functions.text import py_strip

_KEY, _TO = "_alias_key", "_alias_to"


def alias_key(name) -> Column:
    """What raw names are compared by: stripped and lower-cased."""
    return F.lower(py_strip(name))


def alias_table(aliases: DataFrame, raw: str, canonical: str) -> DataFrame:
    """One row per raw name.  Rows that repeat a pair are one; two canonical names for one raw name raise an
    error in whatever action uses the table; rows without either name are left out."""
    pairs = aliases.select(alias_key(raw).alias(_KEY), py_strip(canonical).alias(_TO)).dropna()
    one = pairs.groupBy(_KEY).agg(F.min(_TO).alias("low"), F.max(_TO).alias("high"))
    clash = F.raise_error(F.concat(F.lit("two canonical names for "), F.col(_KEY), F.lit(": "), F.col("low"), F.lit(", "), F.col("high")))
    return one.select(_KEY, F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(clash).alias(_TO))


def with_canonical(df: DataFrame, name: str, table: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``: the alias of ``name``, else the stripped name (case kept); null stays null."""
    joined = df.withColumn("_key_of_name", alias_key(name)).join(table, F.col("_key_of_name") == F.col(_KEY), "left")
    return joined.withColumn(out, F.coalesce(F.col(_TO), py_strip(name))).drop("_key_of_name", _KEY, _TO)


def unknown_names(df: DataFrame, name: str, table: DataFrame, teams: DataFrame, team: str = "name") -> DataFrame:
    """``name, rows``: stripped names that no alias and no team knows, and how many rows have them.

    Rows are counted per name first, so a name that many rows share joins once.
    """
    counted = df.where(F.col(name).isNotNull()).groupBy(py_strip(name).alias("name")).agg(F.count("*").alias("rows"))
    known = teams.select(py_strip(team).alias("_team")).dropna().distinct()
    rest = counted.join(known, counted["name"] == known["_team"], "left_anti")
    return rest.join(table, alias_key("name") == F.col(_KEY), "left_anti")
