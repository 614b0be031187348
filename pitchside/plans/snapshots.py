"""Feature snapshots C8: the three keyed snapshot tables.

Each builder returns the batch as it would be upserted; :func:`apply` merges
it into a stored table with the K6 rules.  Stored tables lie in hash buckets of their keys:
:func:`upsert_buckets` reads and rewrites only the buckets that the batch has keys in, so the cost of a merge
follows the batch and not the table.  Publishing is done by :mod:`pitchside.plans.sinks`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.operators.card import stamp
from pitchside.operators.upsert import upsert
from pitchside.params import Params, utc_now
from pitchside.plans import sinks

PLAYER_STRENGTH_KEYS = ["team_name", "season"]
STYLE_KEYS = ["team_name", "season"]
IMPACT_KEYS = ["team_name", "player_name", "snapshot_date"]


def _date(params: Params):
    return F.lit(params.snapshot_date or utc_now().date().isoformat()).cast("date")


def player_strength_batch(features: DataFrame, params: Params = Params()) -> DataFrame:
    """K3 rows: ``team_name, season, attack_index, creation_index,
    defensive_index, squad_depth, snapshot_date``."""
    return features.select(
        F.col("team").alias("team_name"), F.lit(params.season).alias("season"),
        "attack_index", "creation_index", "defensive_index", "squad_depth",
        _date(params).alias("snapshot_date"),
    )


def style_batch(style: DataFrame, params: Params = Params()) -> DataFrame:
    """K4 rows: ``team_name, season, matches_count ... avg_goal_diff, snapshot_date``."""
    return style.select(
        "team_name", F.lit(params.season).alias("season"),
        "matches_count", "avg_goals_scored", "avg_goals_conceded",
        "clean_sheet_rate", "btts_rate", "avg_goal_diff",
        _date(params).alias("snapshot_date"),
    )


def impact_batch(impact: DataFrame, params: Params = Params()) -> DataFrame:
    """K5 rows (the date is part of the key, so history accumulates per day);
    ``rank`` orders the batch, the later (lower-scored) duplicate wins."""
    return impact.select(
        "team_name", "player_name", "position", "minutes_90s", "goals", "assists",
        "impact_score", "snapshot_date", "rank",
    )


def apply(stored: DataFrame | None, batch: DataFrame, keys: list[str],
          params: Params = Params(), order_cols: list[str] | None = None) -> DataFrame:
    """K6 upsert with ``created_at`` stamped on the batch rows."""
    return upsert(stored, batch, keys, order_cols, created_at=stamp(params.created_at))


BUCKETS = 256


def bucket_of(keys: list[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_buckets(batch: DataFrame, base: str, name: str, version: str, current: dict[str, str], keys: list[str], merge,
                   buckets: int = BUCKETS) -> tuple[dict[str, str], dict[str, str | None]]:
    """Merge ``batch`` (checkpointed or cheap: it is read twice) into the table ``name`` of ``current``.

    ``merge(batch, stored)`` returns the merged rows, ``stored`` being null if there are none.  Only buckets with
    keys of the batch are read and written.  Returns what to publish and what that is based on.
    """
    spark, (bucket,) = batch.sparkSession, ["_bucket"]
    touched = [r[0] for r in batch.select(bucket_of(keys, buckets).alias(bucket)).distinct().orderBy(bucket).collect()]  # at most `buckets` numbers
    names = {b: f"{name}/b{b:03d}" for b in touched}
    stored = [current[n] for n in names.values() if n in current]
    merged = merge(batch, spark.read.parquet(*stored) if stored else None)
    path = f"{base}/{name}/version={version}"
    merged.withColumn(bucket, bucket_of(keys, buckets)).repartition(bucket).write.partitionBy(bucket).parquet(path)
    return {n: f"{path}/{bucket}={b}" for b, n in names.items()}, {n: current.get(n) for n in names.values()}


def player_strength_snapshot(features, params=Params(), stored=None):
    return apply(stored, player_strength_batch(features, params), PLAYER_STRENGTH_KEYS, params)


def style_snapshot(style, params=Params(), stored=None):
    return apply(stored, style_batch(style, params), STYLE_KEYS, params)


def impact_snapshot(impact, params=Params(), stored=None):
    """``stored`` need only hold the batch's own day: other days have other keys and stay as they are."""
    out = apply(stored, impact_batch(impact, params), IMPACT_KEYS, params, order_cols=["rank"])
    return out.drop("rank")
