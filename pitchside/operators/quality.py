"""Data-quality gates: G1 (minimum rows), G3 (per-stage counts)."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """Raised when an input fails a data-quality gate."""


def row_gate(df: DataFrame, min_rows: int) -> DataFrame:
    """G1 as data: one row ``n_matches, min_required, passed``."""
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_matches"),
        F.lit(int(min_rows)).cast("bigint").alias("min_required"),
        (n >= F.lit(int(min_rows))).alias("passed"),
    )


def require_rows(n: int, min_rows: int) -> int:
    """G1 as a stop: :class:`GateError` below ``min_rows`` (tested before any coercion)."""
    if n < min_rows:
        raise GateError(f"{n} finished matches, {min_rows} are needed")
    return n


def observed(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count rows flowing through a stage without an extra scan.

    The returned observation is filled once an action over the returned
    DataFrame has run: ``obs.get["rows"]``.
    """
    obs = Observation(stage)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


GATE = "too few finished matches"


def guarded(df: DataFrame, rows: DataFrame, min_rows: int) -> DataFrame:
    """G1 in the plan: ``df``, whose every action fails if ``rows`` (one row, a column ``n``) says fewer than ``min_rows``.

    The guard is a branch without rows beside ``df``, so it is evaluated also where ``df`` is empty.
    """
    n = "coalesce(n, 0L)"
    guard = rows.filter(f"CASE WHEN {n} < {int(min_rows)} THEN raise_error(concat('{GATE}: ', {n}, ', {int(min_rows)} are needed')) ELSE false END")
    return df.unionByName(guard.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]))


#: ``seen(stage, df)`` or ``seen(stage, df, what)`` gives ``df`` back, counting its rows (or the aggregate ``what``) on the way.
Seen = Callable[..., DataFrame]


def unseen(stage: str, df: DataFrame, what: str = "count(1)") -> DataFrame:
    """Counts nothing."""
    return df


class Counts:
    """Named observations on frames that are written anyway; they add no job."""

    def __init__(self) -> None:
        self._open: dict[str, Observation] = {}
        self.rows: dict[str, int] = {}

    def __call__(self, stage: str, df: DataFrame, what: str = "count(1)") -> DataFrame:
        self._open[stage] = Observation(stage)
        return df.observe(self._open[stage], F.expr(what).alias("rows"))

    def take(self, *stages: str) -> dict[str, int]:
        """The counts of the stages named, whose frames have been written, and all taken before."""
        for stage in stages:
            if stage in self._open:
                observed = self._open.pop(stage)
                try:
                    self.rows[stage] = int(observed.get.get("rows") or 0)
                except Py4JJavaError:  # no row: the stage was found empty and dropped from the plan
                    self.rows[stage] = 0
        return dict(self.rows)
