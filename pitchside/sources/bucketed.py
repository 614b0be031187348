"""Tables bucketed by match, so that the metric meets the match fact without a shuffle.

Stored once as bucketed catalog tables, ``events`` by its id and ``match_stats`` by the event's id, both in the same
number of buckets, every later join of the two reads matching buckets side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 256


def save(df: DataFrame, table: str, key: str, buckets: int = BUCKETS) -> None:
    """Write ``df`` as the catalog table ``table``, rows of one key in one bucket, one file a bucket."""
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)


def save_matches(events: DataFrame, match_stats: DataFrame, prefix: str = "", buckets: int = BUCKETS) -> None:
    save(events, f"{prefix}events", "id", buckets)
    save(match_stats, f"{prefix}match_stats", "event_id", buckets)


def read(spark: SparkSession, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """``(events, match_stats)``."""
    return spark.table(f"{prefix}events"), spark.table(f"{prefix}match_stats")
