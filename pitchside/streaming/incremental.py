"""Incremental refresh of team strengths with Structured Streaming.

The batch job recomputes everything each run.  Its heavy part, the per-team
role totals (A3/A4 over U2), is a plain sum/count aggregate, so it can be
kept up to date as finished matches arrive:

* the streaming aggregate holds the per-team totals in the state store
  (fault-tolerant through the query's checkpoint location in the cluster's
  shared checkpoint folder);
* in ``update`` mode each micro-batch emits the full current totals of the
  teams it touched; ``foreachBatch`` upserts them (K6) into the stored totals
  table and rewrites the strengths from the merged totals: one row per team,
  so that step is small whatever the match volume.

Outputs have their own table names and share the commit log with the batch job
(:mod:`pitchside.plans.sinks`): neither hides what the other publishes, and of two streams that refresh the same
totals the slower one merges again on top of the faster.  Every attempt at a micro-batch writes new folders, so a
replayed one reads what is published and overwrites nothing; as totals are whole, replaying them changes nothing.
A query with a new checkpoint reads all files again and replaces every team it sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pitchside.operators.strength import role_totals, strengths_from_totals
from pitchside.operators.upsert import upsert
from pitchside.params import Params
from pitchside.plans import sinks
from pitchside.session import ensure_checkpoint_dir

TOTALS = "streamed_team_totals"
STRENGTHS = "streamed_team_strengths"


def refresh_batch(spark: SparkSession, changed: DataFrame, out_base: str, params: Params = Params()) -> dict[str, str]:
    """Merge one micro-batch of changed per-team totals and republish."""
    def write(current: dict[str, str], version: str) -> tuple[dict[str, str], dict[str, str | None]]:
        stored = spark.read.parquet(current[TOTALS]) if TOTALS in current else None
        merged = upsert(stored, changed, ["team"])
        paths = {TOTALS: sinks.write_table(merged, out_base, TOTALS, version)}
        totals = spark.read.parquet(paths[TOTALS])           # read back: lineage cut at the write
        paths[STRENGTHS] = sinks.write_table(strengths_from_totals(totals, params), out_base, STRENGTHS, version)
        return paths, {TOTALS: current.get(TOTALS)}

    return sinks.commit(spark, out_base, write)


def start_strength_refresh(spark: SparkSession, source_dir: str, schema: StructType,
                           out_base: str, params: Params = Params(), name: str = "strengths",
                           available_now: bool = True) -> StreamingQuery:
    """Stream finished-match files (S1 shape, parquet) from ``source_dir``.

    ``available_now`` processes what is there and stops (scheduled runs);
    otherwise the query keeps running and picks up new files.
    """
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    totals = role_totals(spark.readStream.schema(schema).parquet(source_dir))
    writer = (totals.writeStream.outputMode("update")
              .foreachBatch(lambda changed, _: refresh_batch(spark, changed, out_base, params) and None)
              .option("checkpointLocation", ckpt).queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
