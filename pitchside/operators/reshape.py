"""Set and reshape operators: the two-role unpivot (U2) and team sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.functions import sqltext as S


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def two_role_rows(df: DataFrame, home_team, away_team, home_value, away_value,
                  keep: list[str] | None = None) -> DataFrame:
    """Each match becomes two rows ``(team, is_home, value_for, value_against)``.

    One ``Generate`` over a two-element array: a single pass over the matches,
    no union, no second scan.  ``keep`` columns are carried on both rows.
    Column names are given as strings (or Columns).
    """
    if all(isinstance(c, str) for c in (home_team, away_team, home_value, away_value)):
        h, a, hv, av = (S.col(c) for c in (home_team, away_team, home_value, away_value))
        gen = (f"inline(array("
               f"struct({h} AS team, true AS is_home, {hv} AS value_for, {av} AS value_against), "
               f"struct({a} AS team, false AS is_home, {av} AS value_for, {hv} AS value_against)))")
        return df.selectExpr(*[S.col(k) for k in (keep or [])], gen)
    home = F.struct(_c(home_team).alias("team"), F.lit(True).alias("is_home"),
                    _c(home_value).alias("value_for"), _c(away_value).alias("value_against"))
    away = F.struct(_c(away_team).alias("team"), F.lit(False).alias("is_home"),
                    _c(away_value).alias("value_for"), _c(home_value).alias("value_against"))
    return df.select(*(keep or []), F.inline(F.array(home, away)))


def team_set(df: DataFrame, home_team="home_team_name", away_team="away_team_name") -> DataFrame:
    """Distinct non-null teams over both roles (one shuffle, partial distinct)."""
    return (
        df.select(F.explode(F.array(_c(home_team), _c(away_team))).alias("team"))
        .filter(F.col("team").isNotNull())
        .distinct()
    )


def sorted_teams(df: DataFrame, home_team="home_team_name", away_team="away_team_name") -> DataFrame:
    """O2: the team set in name order (range-partitioned sort, no single task)."""
    return team_set(df, home_team, away_team).orderBy("team")
