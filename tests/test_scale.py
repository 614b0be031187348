"""Plans at scale: the join of metric and fact, league figures of very many teams."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from pitchside.operators import strength, xg
from pitchside.operators.matches import xg_matches
from pitchside.params import TESTED
from pitchside.session import scratch_dir
from pitchside.sources import bucketed

OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def settings(spark):
    """Sets session options for one test."""
    old = {}

    def put(**options):
        for k, v in options.items():
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield put
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tables(spark, n=40_000):
    events = spark.range(n).selectExpr(
        "concat('m', id) as id", "id % 50 as home_team_id", "(id + 7) % 50 as away_team_id", "if(id % 10 < 9, 3, 1) as time_status",
        "cast(id % 5 as double) as home_score", "cast(id % 4 as double) as away_score", "timestamp_ntz'2026-01-01 00:00:00' as time_utc")
    metric = spark.range(n).selectExpr("concat('m', id) as event_id", "if(id % 97 = 0, 'xg', 'shots') as metric",
                                       "cast(id % 3 as double) as home_value", "cast(id % 2 as double) as away_value")
    return events, spark.range(50).selectExpr("id", "concat('team ', id) as name"), metric


def test_bucketed_tables_meet_without_shuffling_the_matches(spark, settings):
    settings(**OFF, **{"spark.sql.bucketing.coalesceBucketsInJoin.enabled": "true"})
    events, teams, metric = tables(spark)
    prefix = f"bucketed_{os.getpid()}_"
    for t in ("events", "match_stats"):
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{t}")
    bucketed.save_matches(events, metric, prefix, 8)
    e, m = bucketed.read(spark, prefix)
    joined = m.filter("metric = 'xg'").join(e.filter("time_status = 3"), F.col("event_id") == F.col("id"))
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    plan = xg_matches(m, e, teams)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(event_id" not in plan and plan.count("hashpartitioning(id") <= 2  # those are the teams, one per role
    want = sorted(map(str, xg_matches(metric, events, teams).collect()))
    assert sorted(map(str, xg_matches(m, e, teams).collect())) == want and len(want) > 300
    for t in ("events", "match_stats"):
        spark.sql(f"DROP TABLE {prefix}{t}")


def test_a_runtime_filter_goes_ahead_of_the_shuffle(spark, settings):
    base = scratch_dir()
    events, teams, metric = tables(spark)
    for name, df in (("events", events), ("match_stats", metric)):
        df.write.parquet(f"{base}/{name}")
    settings(**OFF, **{"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
                       "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"})
    e, m = spark.read.parquet(f"{base}/events"), spark.read.parquet(f"{base}/match_stats")
    found = xg_matches(m, e, teams)
    assert "might_contain" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, found.collect())) == sorted(map(str, xg_matches(metric, events, teams).collect()))


def test_five_million_teams(spark):
    """League figures over materialised totals: no window, no exchange of team rows."""
    n = 5_000_000
    totals = spark.range(n, numPartitions=8).selectExpr(
        "concat('t', id) as team", "2L as named_rows", "cast(id % 5 as double) as home_goals_scored", "cast(id % 3 as double) as home_goals_conceded",
        "1L as home_matches", "cast(id % 2 as double) as away_goals_scored", "1D as away_goals_conceded", "1L as away_matches")
    rows = strength.strengths_from_totals(totals, TESTED, keep_league=True, materialised=True)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("SinglePartition") <= 2 and "Subquery" in plan
    got = rows.agg(F.count("*").alias("n"), F.max("league_n").alias("m"), F.min("league_avg_home").alias("h"), F.max("league_avg_home").alias("g")).first()
    assert (got["n"], got["m"], got["h"], got["g"]) == (n, n, 2.0, 2.0)
    few = totals.limit(1000)
    assert sorted(map(str, strength.strengths_from_totals(few, TESTED, True).collect())) == sorted(
        map(str, strength.strengths_from_totals(few, TESTED, True, materialised=True).collect()))
    sums = spark.range(1000).selectExpr("concat('t', id) as team", "1L as named_rows", "12L as xg_home_rows", "3L as xg_away_rows", *[
        f"cast(id % {k + 2} as double) as {c}" for k, c in enumerate(xg.SUM_COLS[2:])])
    assert sorted(map(str, xg.with_xg_means(sums).collect())) == sorted(map(str, xg.with_xg_means(sums, materialised=True).collect()))
