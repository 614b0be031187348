"""The streamed refresh equals the batch computation over the same matches."""

from __future__ import annotations

import os

from pitchside.operators import matches, strength
from pitchside.params import TESTED
from pitchside.plans import sinks
from pitchside.session import scratch_dir
from pitchside.sources import fixtures as fx
from pitchside.streaming import incremental
from pitchside.streaming.incremental import start_strength_refresh


def split_matches(spark):
    d = "/root/testdata/sf0.001"
    fin = matches.finished_matches(fx.events(spark, d), fx.teams(spark, d))
    src = scratch_dir()
    # Two arrivals: matches before and after a date.
    fin.filter("time_utc < '1998-01-01'").write.parquet(os.path.join(src, "part1"))
    fin.filter("time_utc >= '1998-01-01'").write.parquet(os.path.join(src, "part2"))
    return fin, src, spark.read.parquet(os.path.join(src, "part1")).schema


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_streamed_strengths_equal_batch_and_share_a_folder_with_it(spark):
    fin, src, schema = split_matches(spark)
    out = scratch_dir()
    batch = sinks.write_table(strength.team_strengths(fin), out, "team_strengths", "v0")
    sinks.publish(spark, out, sinks.new_version(), {"team_strengths": batch})
    name = "test_strengths_%d" % os.getpid()
    start_strength_refresh(spark, os.path.join(src, "*"), schema, out, TESTED, name=name).awaitTermination(300)
    exp = rows(strength.team_strengths(fin, TESTED))
    assert rows(sinks.read_current(spark, out, incremental.STRENGTHS)) == exp and len(exp) == 25
    assert sinks.current_paths(spark, out)["team_strengths"] == batch        # the batch table is still there
    # a new checkpoint reads everything again and ends at the same tables
    start_strength_refresh(spark, os.path.join(src, "*"), schema, out, TESTED, name=name + "_again").awaitTermination(300)
    assert rows(sinks.read_current(spark, out, incremental.STRENGTHS)) == exp
    later = sinks.new_version()
    sinks.publish(spark, out, later, sinks.current_paths(spark, out) | {"extra": batch})
    assert "extra" in sinks.current_paths(spark, out)                          # a later batch publish is the newest


def test_replayed_batch_changes_nothing_and_overwrites_nothing(spark):
    fin, _, _ = split_matches(spark)
    out = scratch_dir()
    first = incremental.refresh_batch(spark, strength.role_totals(fin), out, TESTED)
    changed = strength.role_totals(fin).filter("team IN ('Arsenal', 'Chelsea') OR team IS NULL")
    second = incremental.refresh_batch(spark, changed, out, TESTED)
    third = incremental.refresh_batch(spark, changed, out, TESTED)
    assert len({p[incremental.TOTALS] for p in (first, second, third)}) == 3
    exp = rows(strength.team_strengths(fin, TESTED))
    assert all(rows(spark.read.parquet(p[incremental.STRENGTHS])) == exp for p in (first, second, third))
