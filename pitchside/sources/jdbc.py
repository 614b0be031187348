"""S1 / S2 from a relational database: its three tables through Spark's JDBC source.

Only tables are read here; the filters and joins are those of
:mod:`pitchside.operators.matches`, and Spark pushes the filters (status, metric, scores) and the
column selection to the database.  Each large table is read in ranges of its key, so no task pulls
a whole table.  The database's driver must be on the cluster's class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Tables of the match database and the key whose ranges split them.
MATCH_TABLES = {"events": "id", "teams": None, "match_stats": "event_id"}


def table_options(url: str, table: str, key: str | None, lower: int, upper: int, partitions: int, **properties: str) -> dict[str, str]:
    out = {"url": url, "dbtable": table, "fetchsize": "10000", **properties}
    if key:
        out |= {"partitionColumn": key, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions)}
    return out


def match_table(spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int, **properties: str) -> DataFrame:
    """One of the three tables; ``lower`` and ``upper`` bound the match ids that the ranges are cut from
    (rows outside go to the first and the last range)."""
    options = table_options(url, table, MATCH_TABLES[table], lower, upper, partitions, **properties)
    return spark.read.format("jdbc").options(**options).load()


def match_tables(spark: SparkSession, url: str, lower: int, upper: int, partitions: int, **properties: str) -> dict[str, DataFrame]:
    """The three tables."""
    return {t: match_table(spark, url, t, lower, upper, partitions, **properties) for t in MATCH_TABLES}
