"""Match sources as relational operators: P1-P3 (filters, projection) and the
role-playing dimension joins J1 / J2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.params import STATUS_ENDED, XG_METRIC


def with_team_names(ended: DataFrame, teams: DataFrame) -> DataFrame:
    """The team dimension joined twice, once per role.  Spark broadcasts it by its size in bytes
    and else shuffles; AQE splits a team that holds a third of all matches."""
    t = teams.select("id", "name")
    ht, at = t.alias("ht"), t.alias("at")
    return (ended.alias("e").join(ht, F.col("e.home_team_id") == F.col("ht.id"))
            .join(at, F.col("e.away_team_id") == F.col("at.id"))
            .select("e.*", F.col("ht.name").alias("home_team_name"), F.col("at.name").alias("away_team_name")))


def ended_matches(events: DataFrame, teams: DataFrame) -> DataFrame:
    """Ended matches named by role, whatever their scores."""
    return with_team_names(events.filter(F.col("time_status") == STATUS_ENDED), teams)


def finished_matches(events: DataFrame, teams: DataFrame, ordered: bool = False) -> DataFrame:
    """Ended matches with both scores, named by role.

    Output ``event_id, home_team_name, away_team_name, home_score, away_score,
    time_utc``.  The source's ``ORDER BY time_utc`` (O1) is presentation only:
    nothing downstream depends on row order, so pipelines leave it off and
    ``ordered=True`` adds it (a range-partitioned sort) for presentation.
    """
    out = ended_matches(events, teams).filter("home_score IS NOT NULL AND away_score IS NOT NULL").select(
        F.col("id").alias("event_id"), "home_team_name", "away_team_name", "home_score", "away_score", "time_utc")
    return out.orderBy("time_utc") if ordered else out


def xg_rows(match_stats: DataFrame) -> DataFrame:
    """P2 on the long metric table: ``event_id, xg_home, xg_away``."""
    return match_stats.filter(F.col("metric") == XG_METRIC).select(
        "event_id", F.col("home_value").alias("xg_home"), F.col("away_value").alias("xg_away"))


def xg_matches(match_stats: DataFrame, events: DataFrame, teams: DataFrame) -> DataFrame:
    """Expected-goals rows of ended matches, named by role.

    The metric table is filtered before it meets the fact, so only ``xg`` rows
    are shuffled; AQE turns the fact join into a broadcast when the filtered
    side is small.  Output ``event_id, xg_home, xg_away, home_team_name,
    away_team_name``.
    """
    ended = events.filter(F.col("time_status") == STATUS_ENDED).select("id", "home_team_id", "away_team_id")
    x = xg_rows(match_stats)
    return with_team_names(x.join(ended, x.event_id == ended.id), teams).select(
        "event_id", "xg_home", "xg_away", "home_team_name", "away_team_name")
