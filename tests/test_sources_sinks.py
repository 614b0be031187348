"""Literal parsing (property test), CSV sources, optional source, sinks and
the end-to-end job with reruns."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitchside.functions import literals
from pitchside.functions.literals import literal_field_py, with_literal_field, with_literal_fields
from pitchside.operators import matches, players, quality, style
from pitchside.operators.upsert import upsert
from pitchside.params import TESTED, Params, utc_now
from pitchside.plans import job, sinks, snapshots
from pitchside.plans.training import train_from_events
from pitchside.session import scratch_dir
from pitchside.sources import files
from pitchside.sources import fixtures as fx

KEY = "home_team_name"

names = st.text(alphabet=st.sampled_from(list("AbcXyz '\"-.,:{}[]\\é\t")), min_size=0, max_size=12)
values = st.one_of(names, st.none(), st.booleans(), st.integers(-5, 5),
                   st.lists(st.integers(0, 3), max_size=2),
                   st.dictionaries(st.sampled_from([KEY, "id"]), st.one_of(names, st.none(), st.booleans()), max_size=2))
dicts = st.dictionaries(st.sampled_from([KEY, "g", "x", "away_team_name"]), values, max_size=3)
cells = st.one_of(
    dicts.map(repr),                                   # well-formed literals
    dicts.map(lambda d: repr(d).replace(", ", ",  ")),  # spacing variants
    dicts.map(lambda d: repr(d)[:-1] + ",}"),           # trailing comma (valid Python)
    names,                                              # bare names and junk
    st.sampled_from(["{bad", "{'home_team_name': None}", "{}", "[1, 2]", "None",
                     "{'home_team_name': 'A', 'home_team_name': 'B'}",
                     "{'home_team_name': 'a: None, b'}", "{'home_team_name': 'x\\'y'}",
                     " {'home_team_name': 'pad'}", "{'home_team_name': 'A'} tail",
                     "{,}", "{'home_team_name': 'A',}", "{'g': 01, 'home_team_name': 'A'}",
                     "{'g': -0.5, 'home_team_name': 'B'}", "\x01{'home_team_name': 'C'}",
                     "{'home_team_name': 'A', 'g': \"x, 'home_team_name': 'Z'\"}",
                     "{'home_team_name': 'A'}]", "{'a': 1},{'home_team_name': 'B'}", "{}],[{}", "{'g': NaN}", "{'g': true}",
                     "{'home_team_name': 'A'}\n", "{'home_team_name': 'A' 'B'}", "\n{'home_team_name': 'A'}", " \n\n {'g': 1}",
                     "({'home_team_name': 'A'})", "(\n{'home_team_name': None})", "# note\n{'home_team_name': 'A'}", "A {x}", "\x0c{'g': 1}"]),
)


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(cells, min_size=1, max_size=25))
def test_literal_field_matches_python(spark, batch):
    df = spark.createDataFrame(list(enumerate(batch)), "i int, cell string")
    got = [r["v"] for r in sorted(with_literal_field(df, "cell", KEY, "v").collect(), key=lambda r: r["i"])]
    assert got == [literal_field_py(c, KEY) for c in batch]


def test_one_match_decides_dicts_of_three_levels(spark, monkeypatch):
    """The rewriting to JSON, several times as costly, is for other cells."""
    monkeypatch.setattr(literals, "_as_json", lambda cell: F.raise_error(F.concat(F.lit("rewritten: "), cell)).cast("string"))
    batch = ["{'home_team_name': 'Arsenal', 'g': None}", "{\"home_team_name\": \"Nott'm Forest\"}", "{'x': 1}", "{}", " \t{ 'g' :-0.5 , 'home_team_name':''} ",
             "{'home_team_name': None, 'g': 1}", "{'home_team_name': 'A', 'home_team_name': 'B'}", "{'home_team_name': 'A', 'home_team_name': 3}",
             "{'home_team_name': {'home_team_name': 'A'}}", "{'country': {'home_team_name': 'A'}}", "{'home_team_name': ['A', []], 'g': {}}",
             "{'m': [{'id': 1, 'nick': None}, {'id': 2, 'c': 'x}'}], 'home_team_name': 'B: {', 'k': True}", "Arsenal", "'", "\x01A", "", None]
    df = spark.createDataFrame(list(enumerate(batch)), "i int, cell string")
    got = with_literal_fields(df, [("cell", KEY, "v")], pending=True).orderBy("i").collect()
    assert [r["v"] for r in got] == [literal_field_py(c, KEY) for c in batch]
    assert not any(r["v_pending"] for r in got)


def test_keys_of_any_characters(spark):
    for key in ("it's", 'a"b', "'\"", "a\\b", "a\nb", "a.b", "$1", "\\E", "", "é"):
        batch = [repr({key: "v", "g": {key: None}}), repr({"g": {key: "in"}}), repr({key: None}), "{'a.b': 'x', 'axb': 'y'}", repr({"é" + key: "z"})]
        df = spark.createDataFrame(list(enumerate(batch)), "i int, cell string")
        got = [literals.literal_columns(df, [("cell", key, "v")]).orderBy("i").collect()]
        for r, cell in zip(got[0], batch):
            assert r["v_cell"] == cell if r["v_cell"] is not None else r["v"] == literal_field_py(cell, key), (key, cell)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_cells_that_wait_meet_python(spark):
    """Without such cells the Python branch is dropped at run time; with them a filter stands below it."""
    plain = spark.createDataFrame([("{'home_team_name': 'A'}", "B", "1", "2"), ("C", "{'away_team_name': 'D'}", "0", "0")] * 20,
                                  "home_team string, away_team string, home_score string, away_score string")
    odd = plain.unionByName(spark.createDataFrame([("{'home_team_name': 'E',}", "(\n{'away_team_name': 'F'})", "1", "1")], plain.schema))
    for df, python in ((plain, False), (odd, True)):
        final = final_plan(style.team_style(df, TESTED)).split("== Initial Plan ==")[0]
        assert ("ArrowEvalPython" in final) == python
    got = {r["team_name"] for r in style.team_style(odd, TESTED).collect()}
    assert got == {"A", "B", "C", "D", "E", "F"}


def test_cells_are_parsed_once(spark):
    """All branches, also the observed one, read one aggregate: the source is scanned once, whether cells wait or not."""
    plain = spark.createDataFrame([("{'home_team_name': 'A'}", "B", "1", "2"), ("C", "{'away_team_name': 'D'}", "0", "0")] * 20,
                                  "home_team string, away_team string, home_score string, away_score string")
    odd = plain.unionByName(plain.selectExpr("\"{'home_team_name': 'E',}\" AS home_team", "away_team", "home_score", "away_score"))
    for df, scans, waiting in ((plain, 1, 0), (odd, 2, 40)):
        seen = quality.Counts()
        for out in (style.cell_pair_names(df, TESTED), style.team_style(df, TESTED), style.team_style(df, TESTED, seen)):
            assert final_plan(out).split("== Initial Plan ==")[0].count("Scan ExistingRDD") == scans
        assert seen.take("residual_literals")["residual_literals"] == waiting


def test_quoted_csv_cells_do_not_shift(spark):
    d = scratch_dir()
    path = os.path.join(d, "style.csv")
    with open(path, "w") as f:
        f.write('home_team,away_team,home_score,away_score\n')
        f.write('"{\'home_team_name\': ""Nott\'m Forest"", \'g\': None}","Arsenal, London",2,NA\n')
    df = files.read_style_matches(spark, path)
    r = df.first()
    assert r["home_team"] == "{'home_team_name': \"Nott'm Forest\", 'g': None}"
    assert r["away_team"] == "Arsenal, London" and r["home_score"] == "2" and r["away_score"] is None


def test_player_csv_renames_and_optional_source(spark):
    d = scratch_dir()
    path = os.path.join(d, "players.csv")
    with open(path, "w") as f:
        f.write("Player,Pos,Squad,Comp,90s,Gls,Ast,Tkl+Int\nA,FW,Arsenal,eng Premier League,3.5,2,1,n/a\n")
    df = files.read_players(spark, path)
    assert {"nineties", "tkl_int", "ordinal"} <= set(df.columns)
    assert df.first()["tkl_int"] is None
    missing = files.optional_source(spark, os.path.join(d, "nope.csv"), files.read_players,
                                    df.schema)
    assert missing.count() == 0 and missing.schema == df.schema


def test_bad_rows_are_counted_and_put_out(spark):
    """A row with a missing cell keeps what it has and is in the bad-row output; files are parsed once."""
    d, src, out = "/root/testdata/sf0.001", scratch_dir(), scratch_dir()
    for t in ("events", "teams", "match_stats"):
        getattr(fx, t)(spark, d).write.parquet(f"{src}/{t}")
    with open(f"{src}/players.csv", "w") as f:
        f.write("Player,Pos,Squad,Comp,90s,Gls,Ast\nA,FW,Arsenal,eng Premier League,9,2,1\nshort,FW,Arsenal,eng Premier League,9\nB,FW,Chelsea,other,9,1,1,extra\n")
    with open(f"{src}/style.csv", "w") as f:
        f.write("home_team,away_team,home_score,away_score\nArsenal,Chelsea,2,1\nArsenal\n")
    job.main(["--matches", src, "--out", out, "--players", f"{src}/players.csv", "--style", f"{src}/style.csv", "--snapshot-date", "2026-02-01"])
    rows = {r["row"] for r in sinks.read_current(spark, out, "bad_rows/players").collect()}
    assert rows == {"short,FW,Arsenal,eng Premier League,9", "B,FW,Chelsea,other,9,1,1,extra"}
    assert [r["row"] for r in sinks.read_current(spark, out, "bad_rows/style").collect()] == ["Arsenal"]
    counts = sinks._Files(spark, out).read(sinks._entry(1))["counts"]
    assert (counts["players_read"], counts["players_bad_rows"], counts["league_players"]) == (3, 2, 2)
    got = {r["player_name"]: r["goals"] for r in sinks.read_current(spark, out, "player_absence_impact").collect()}
    assert got == {"A": 2, "short": 0}
    assert sinks.read_current(spark, out, "team_style_snapshot").count() == 2
    copy = files.columnar(spark.range(10), f"{src}/copy", F.col("id") < 3).filter("flagged")
    assert "PartitionFilters: [isnotnull(flagged" in copy._jdf.queryExecution().executedPlan().toString() and copy.count() == 3


def test_versioned_sinks_publish_last(spark):
    base = scratch_dir()
    df = spark.range(3).withColumn("v", F.col("id") * 2)
    p1 = sinks.write_table(df, base, "t", "v1")
    sinks.publish(spark, base, "v1", {"t": p1})
    p2 = sinks.write_table(df.filter("id > 0"), base, "t", "v2")
    assert sinks.read_current(spark, base, "t").count() == 3      # v2 not published yet
    sinks.publish(spark, base, "v2", {"t": p2})
    assert sinks.read_current(spark, base, "t").count() == 2


def test_writers_that_interleave_lose_nothing(spark):
    """The job mints a version, a stream publishes twice, the job publishes: both are there, in either order."""
    base = scratch_dir()
    job_version = sinks.new_version()
    sinks.publish(spark, base, sinks.new_version(), {"stream": "s1"})
    before = sinks.current_paths(spark, base)
    sinks.publish(spark, base, sinks.new_version(), {"stream": "s2", "stream_too": "s2"})
    sinks.publish(spark, base, job_version, {"model": "m1"}, counts={"matches": 5})
    assert sinks.current_paths(spark, base) == {"stream": "s2", "stream_too": "s2", "model": "m1"}
    assert sinks.last_commit(spark, base)["counts"] == {"matches": 5}
    # what was derived from a table that moved on is refused, and made again on top of the winner
    with pytest.raises(sinks.Conflict):
        sinks.publish(spark, base, "late", {"stream": "s3"}, based_on={"stream": before["stream"]})
    with pytest.raises(sinks.Conflict):
        sinks.publish(spark, base, "late", {"model": "m2"}, based_on={"model": None})
    tries = []

    def write(current, version):
        tries.append(current["stream"])
        if len(tries) == 1:                                       # another writer is faster
            sinks.publish(spark, base, "fast", {"stream": "s4"})
        return {"stream": current["stream"] + "+"}, {"stream": current["stream"]}

    assert sinks.commit(spark, base, write) == {"stream": "s4+"} and tries == ["s2", "s4"]
    sinks.publish(spark, base, "drop", {"stream_too": None})
    assert sinks.current_paths(spark, base) == {"stream": "s4+", "model": "m1"}
    assert sinks.commit(spark, base, lambda current, version: ({}, {})) == {}


def test_an_entry_is_created_once(spark):
    """Two writers that take the same number: one of them goes on top of the other."""
    base = scratch_dir()
    one, two = sinks._Files(spark, base), sinks._Files(spark, base)
    assert one.create(sinks._entry(1), {"tables": {"a": "1"}, "version": "x"})
    assert not two.create(sinks._entry(1), {"tables": {"a": "2"}, "version": "y"})
    assert sinks.publish(spark, base, "y", {"b": "2"}) == 2 and sinks.current_paths(spark, base) == {"a": "1", "b": "2"}
    assert not [n for n in one.names(one.log) if n.endswith(".new")]
    assert sinks.current_paths(spark, scratch_dir()) == {} == sinks.last_commit(spark, scratch_dir())


def test_reading_does_not_grow_with_history_and_old_versions_go(spark):
    base, df = scratch_dir(), spark.range(2)
    for k in range(25):
        paths = {"t": sinks.write_table(df, base, "t", f"v{k}")} if k % 8 == 0 else {f"x{k % 3}": f"p{k}"}
        assert sinks.publish(spark, base, f"v{k}", paths) == k + 1
    state = sinks.current_paths(spark, base)
    opened = sinks._state(sinks._Files(spark, base))[2]
    assert opened <= 1 + sinks.COMPACT_EVERY and state["t"].endswith("version=v24")
    unpublished = sinks.write_table(df, base, "t", "running")
    assert sinks.remove_old(spark, base, keep=10) == []                         # nothing is old enough
    gone = sinks.remove_old(spark, base, keep=10, grace_hours=-1)
    assert sorted(os.path.basename(g) for g in gone) == ["version=running", "version=v0"]  # the oldest commit kept has v8
    assert not os.path.exists(unpublished)
    assert sinks.current_paths(spark, base) == state and sinks.read_current(spark, base, "t").count() == 2
    log = os.listdir(f"{base}/{sinks.LOG}")
    assert len([n for n in log if n.endswith(".json") and not n.startswith(".")]) <= 13
    assert sinks.publish(spark, base, "next", {"x9": "p"}) == 26


def test_upsert_writes_only_the_buckets_of_its_keys(spark):
    base, keys = scratch_dir(), ["k"]

    def store(batch):
        def write(current, version):
            return snapshots.upsert_buckets(batch, base, "t", version, current, keys, lambda b, stored: upsert(stored, b, keys), 256)
        return sinks.commit(spark, base, write)

    first = store(spark.range(5000).selectExpr("id as k", "id * 2 as v"))
    assert len(first) == 256
    before = sinks.current_paths(spark, base)
    second = store(spark.range(10).selectExpr("id * 700 as k", "-1L as v"))
    after = sinks.current_paths(spark, base)
    assert len(second) <= 10 and {n for n in after if after[n] != before.get(n)} == set(second)
    got = {r["k"]: r["v"] for r in sinks.read_current(spark, base, "t").collect()}
    assert got == {**{i: 2 * i for i in range(5000)}, **{700 * i: -1 for i in range(10)}}
    assert store(spark.range(0).selectExpr("id as k", "id as v")) == {}         # an empty batch changes nothing
    assert sinks.current_paths(spark, base) == after


def test_long_and_nested_cells(spark):
    for n in (10, 700, 100_000):
        cell = "{" + ", ".join(f"'k{i}': 'v{i}'" for i in range(n)) + ", 'home_team_name': 'long', 'c': {'home_team_name': None}}"
        df = spark.createDataFrame([(cell,)], "cell string")
        r = with_literal_fields(df, [("cell", KEY, "v")], pending=True).first()
        assert (r["v"], r["v_pending"]) == ("long", False)


def test_large_files_split_and_rows_keep_file_order(spark):
    d = scratch_dir()
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("Player,Squad\nfirst,A\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("Player,Squad\n" + "".join(f"p{i:07d},{'x' * 50}\n" for i in range(200_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        df = files.read_players(spark, d)
        assert df.rdd.getNumPartitions() >= 3
        names = [r[0] for r in df.orderBy("ordinal").select("Player").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert names == ["first"] + [f"p{i:07d}" for i in range(200_000)]


def job_inputs(spark, d="/root/testdata/sf0.001"):
    return job.JobInputs(fx.events(spark, d), fx.teams(spark, d), lambda: fx.match_stats(spark, d),
                         players=fx.players(spark, d), style_matches=fx.style_matches(spark, d))


def tables_of(written):
    return {n.split("/b0")[0] for n in written}


def rows_of(spark, base, name):
    return sorted(map(str, sinks.read_current(spark, base, name).collect()))


def test_job_end_to_end_rerun_and_history(spark):
    base, name = scratch_dir(), f"player_absence_impact/{TESTED.snapshot_date}"
    names = {"team_strengths", "league_params", "team_player_strength_snapshot", name, "team_style_snapshot"}
    w1 = job.run(spark, job_inputs(spark), base, TESTED)
    assert tables_of(w1) == names | {"model_card"}
    first = {k: rows_of(spark, base, k) for k in names}
    w2 = job.run(spark, job_inputs(spark), base, TESTED)
    assert first == {k: rows_of(spark, base, k) for k in names}              # same batch twice = once
    card = spark.read.text(w2["model_card"]).first()[0]
    assert '"model_name":"Poisson Match Predictor"' in card and '"date_range":{"from":' in card
    current = sinks.current_paths(spark, base)
    assert current["team_strengths"] == w2["team_strengths"]
    job.run(spark, job_inputs(spark), base, replace(TESTED, snapshot_date="2026-01-06"))
    assert sinks.read_current(spark, base, "player_absence_impact").count() == 2 * len(first[name])
    later = sinks.current_paths(spark, base)
    assert {n: later[n] for n in sinks.parts(current, name)} == {n: current[n] for n in sinks.parts(current, name)}  # the earlier day was not written again
    expected = train_from_events(*[getattr(fx, t)(spark, "/root/testdata/sf0.001") for t in ("events", "teams", "match_stats")],
                                 players.player_strength_index(fx.players(spark, "/root/testdata/sf0.001"), TESTED), TESTED).team_strengths
    assert first["team_strengths"] == sorted(map(str, expected.collect()))


def test_counts_are_published_and_cost_no_job(spark, monkeypatch):
    d = "/root/testdata/sf0.001"

    def jobs(group, base):
        spark.sparkContext.setJobGroup(group, group)
        job.run(spark, job_inputs(spark), base, TESTED)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    base = scratch_dir()
    counted = jobs("counted", base)
    log = sinks._Files(spark, base)
    got = log.read(sinks._entry(1))["counts"]
    ps = fx.players(spark, d)
    assert got["matches"] == matches.finished_matches(fx.events(spark, d), fx.teams(spark, d)).count()
    assert got["players_read"] == ps.count() and got["teams"] == 25 and 20 < got["enriched_teams"] <= 25
    assert got["xg_records"] == matches.xg_matches(fx.match_stats(spark, d), fx.events(spark, d), fx.teams(spark, d)).count() > 0
    assert got["league_players"] >= got["players"] > got["featured_teams"] > 0
    monkeypatch.setattr(quality.Counts, "__call__", lambda self, stage, df, what="": df)
    assert abs(jobs("plain", scratch_dir()) - counted) <= 2                     # adaptive runs differ by one or two themselves


def test_gate_fails_the_write_of_the_strengths(spark):
    d = "/root/testdata/sf0.001"
    finished = matches.finished_matches(fx.events(spark, d), fx.teams(spark, d)).limit(100).select("event_id").collect()
    for n in (100, 99, 0):
        base, inputs = scratch_dir(), job_inputs(spark)
        inputs.events = inputs.events.filter(F.col("id").isin([r[0] for r in finished[:n]]) if n else F.lit(False))
        if n == 100:
            assert "team_strengths" in job.run(spark, inputs, base, TESTED)
        else:
            with pytest.raises(quality.GateError, match=f"{n}, 100 are needed"):
                job.run(spark, inputs, base, TESTED)
            assert sinks.current_paths(spark, base) == {}


def test_job_survives_failing_xg_and_snapshots_with_one_utc_time(spark, caplog):
    base, inputs = scratch_dir(), job_inputs(spark)

    def broken():
        raise OSError("no such table")

    inputs.match_stats, inputs.style_matches = broken, spark.range(1)           # a style file without its columns
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        written = job.run(spark, inputs, base)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert "no xG" in caplog.text and "snapshots failed" in caplog.text
    assert set(written) == {"team_strengths", "league_params", "model_card"} == set(sinks.current_paths(spark, base))
    assert spark.read.parquet(written["team_strengths"]).filter("xg_matches IS NOT NULL").count() == 0
    at = spark.read.parquet(written["league_params"]).first()["trained_at"]
    assert at.isoformat()[:23] in spark.read.text(written["model_card"]).first()[0]
    assert abs((utc_now() - at).total_seconds()) < 600


def test_options_give_every_plain_parameter():
    a, params = job.arguments(["--matches", "m", "--out", "o", "--season", "2024/2025", "--top-k", "3", "--floor", "0.2", "--snapshot-date", "2025-02-03"])
    assert (a.matches, a.out, params.season, params.top_k, params.floor, params.snapshot_date) == ("m", "o", "2024/2025", 3, 0.2, "2025-02-03")
    assert job.arguments(["--jdbc", "u", "--out", "o"])[1] == Params()
    with pytest.raises(SystemExit):
        job.arguments(["--out", "o"])


def test_job_from_files(spark):
    d, src, out = "/root/testdata/sf0.001", scratch_dir(), scratch_dir()
    for t in ("events", "teams", "match_stats"):
        getattr(fx, t)(spark, d).write.parquet(f"{src}/{t}")
    fx.players(spark, d).drop("ordinal").withColumnsRenamed({"nineties": "90s", "tkl_int": "Tkl+Int"}).coalesce(1).write.option(
        "header", True).option("escape", '"').csv(f"{src}/players")
    job.main(["--matches", src, "--out", out, "--players", f"{src}/players", "--style", f"{src}/none.csv"])
    got = sinks.read_current(spark, out, "team_strengths")
    assert got.count() == 25 and got.filter("attack_index IS NOT NULL").count() > 20
    assert "team_style_snapshot" not in tables_of(sinks.current_paths(spark, out))
