"""Small contracts: JDBC options, plans without jobs, impact normalisation,
presentation order, observed counts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitchside.operators import impact, matches, names, quality
from pitchside.operators.upsert import upsert
from pitchside.params import TESTED
from pitchside.sources import fixtures as fx
from pitchside import registry
from pitchside.sources.jdbc import table_options

SF = "/root/testdata/sf0.01"


def test_jdbc_tables_are_range_partitioned():
    o = table_options("jdbc:postgresql://db/x", "events", "id", 1, 1000, 16, user="u")
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "16" and o["dbtable"] == "events"
    assert o["user"] == "u" and "password" not in o
    assert "partitionColumn" not in table_options("u", "teams", None, 0, 1, 1)


def test_no_job_runs_while_a_plan_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup(None)
    events = fx.events(spark, SF)                   # reads parquet footers to know the columns
    footers = set(tracker.getJobIdsForGroup(None)) - set(before)
    assert matches.finished_matches(events, events.selectExpr("home_team_id AS id", "'x' AS name")).columns
    assert set(tracker.getJobIdsForGroup(None)) - set(before) == footers


def test_training_reads_the_fact_once(spark):
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("l_quantity")
    card = registry.QUERIES["model_card"](spark, SF)
    assert card._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1
    assert scans(card) > 0


def test_top_impact_of_every_team_is_ten(spark):
    out = impact.player_impact(fx.players(spark, SF), TESTED)
    tops = out.groupBy("team_name").agg(F.max("impact_score").alias("m"), F.count("*").alias("n"))
    rows = tops.collect()
    assert rows and all(r["m"] == 10.0 and r["n"] <= 10 for r in rows)


def test_presentation_order_and_observed_count(spark):
    fin = matches.finished_matches(fx.events(spark, SF), fx.teams(spark, SF),
                                   ordered=True)
    times = [r[0] for r in fin.select("time_utc").limit(200).collect()]
    assert times == sorted(times)
    counted, obs = quality.observed(fin.select("event_id"), "finished")
    n = counted.count()
    assert obs.get["rows"] == n == 19856


def test_alias_table(spark):
    table = names.alias_table(spark.createDataFrame(
        [(" Spurs\t", "Tottenham"), ("SPURS", "Tottenham "), ("City", "Man City"), (None, "x"), ("y", None)], "raw string, to string"), "raw", "to")
    df = spark.createDataFrame([(1, "\u2003spurs"), (2, " Wolves "), (3, None), (4, "CITY"), (5, "city")], "i int, raw string")
    got = {r["i"]: r["c"] for r in names.with_canonical(df, "raw", table, "c").collect()}
    assert got == {1: "Tottenham", 2: "Wolves", 3: None, 4: "Man City", 5: "Man City"}
    teams = spark.createDataFrame([("Wolves",), (None,)], "name string")
    assert names.unknown_names(df, "raw", table, teams).count() == 0
    assert [tuple(r) for r in names.unknown_names(df, "raw", table, teams.limit(0)).collect()] == [("Wolves", 1)]
    twice = names.alias_table(spark.createDataFrame([("Spurs", "Tottenham"), ("spurs ", "San Antonio")], "raw string, to string"), "raw", "to")
    with pytest.raises(Exception, match="two canonical names for spurs: San Antonio, Tottenham"):
        names.with_canonical(df, "raw", twice, "c").collect()


def test_a_batch_without_order_still_gives_one_row_a_key(spark):
    stored = spark.createDataFrame([(1, "old"), (3, "stays")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (1, "new"), (2, "x"), (None, "n"), (None, "n")], "k int, v string")
    rows = sorted(map(str, upsert(stored, batch, ["k"]).collect()))
    assert rows == sorted(map(str, spark.createDataFrame([(1, "new"), (2, "x"), (None, "n"), (3, "stays")], "k int, v string").collect()))
    assert upsert(None, batch, ["k"]).count() == 3
