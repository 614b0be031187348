"""The rules of :mod:`pitchside.functions.sqltext` as columns, for callers that hold column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

from pitchside.functions import sqltext as S


def rnd(name: str, digits: int) -> Column:
    """Round like numpy: ``rint(x * 10**d) / 10**d`` (ties to even)."""
    return F.expr(S.rnd(S.col(name), digits))


def to_number(name: str, dtype: DataType | None = None) -> Column:
    """Text or number -> double, or null when it does not parse."""
    return F.expr(S.to_number(S.col(name), isinstance(dtype, NumericType)))


def number_or_zero(name: str, dtype: DataType | None = None) -> Column:
    """Coerce to double, invalid -> 0.0."""
    return F.expr(S.zero_if_missing(S.to_number(S.col(name), isinstance(dtype, NumericType))))


def is_present(name: str) -> Column:
    """True when a coerced value survives ``dropna`` (not null and not NaN)."""
    return F.expr(S.is_present(S.col(name)))
