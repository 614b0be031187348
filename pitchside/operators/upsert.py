"""Keyed upsert semantics K6 (used by the snapshot sinks K3-K5).

Insert-or-replace per key, no deletes: rows of the stored table whose key is
absent from the batch stay; a key present in the batch takes the batch's row;
within a batch the later duplicate wins.  Re-running the same batch is
idempotent.  ``created_at`` is stamped on every batch row.

Plan: only the batch is deduplicated (``row_number() = 1`` per key, a partial
``WindowGroupLimit`` ahead of the shuffle, so a key duplicated across a third of the batch still
ships one row per task); stored rows pass a left anti join with the batch's keys and are neither
sorted nor grouped.  The result is written to a *new* location by
:mod:`pitchside.plans.sinks`; the stored path is never overwritten while read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_upsert_rn"


class SchemaDrift(ValueError):
    """Raised when a batch and the stored table do not have the same columns."""


def latest_rows(batch: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order_cols])
    return batch.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def upsert(stored: DataFrame | None, batch: DataFrame, keys: list[str],
           order_cols: list[str] | None = None, created_at: Column | None = None) -> DataFrame:
    """Return the table after applying ``batch`` to ``stored``.

    ``order_cols`` give the row order inside the batch (later = greater); without them one row of
    each key is taken, any one where they differ.  ``created_at`` (a column expression) is stamped on batch rows when
    given.  Null keys are equal.  Columns other than ``created_at`` and ``order_cols`` must agree.
    """
    b = latest_rows(batch, keys, order_cols) if order_cols else batch.dropDuplicates(keys)
    if created_at is not None:
        b = b.withColumn("created_at", created_at)
    if stored is None:
        return b
    free = {"created_at", *(order_cols or [])}
    if drift := (set(stored.columns) ^ set(b.columns)) - free:
        raise SchemaDrift(f"columns of only one side: {sorted(drift)}")
    k = b.select(*[F.col(c).alias(f"_key_{c}") for c in keys])
    same = reduce(lambda x, y: x & y, [stored[c].eqNullSafe(k[f"_key_{c}"]) for c in keys])
    return stored.join(k, same, "left_anti").unionByName(b, allowMissingColumns=True)
