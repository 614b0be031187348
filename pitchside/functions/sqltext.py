"""Numeric scalar rules (F5-F9, F12, P6, P7, P11) as Spark SQL text, the one place they are written.

Operators compose these strings and hand each finished expression to ``selectExpr``; the column
functions of :mod:`pitchside.functions.numeric` wrap the same text.  Two traps shape them:

* rounding is numpy-style ``rint(x * 10^d) / 10^d`` (Spark ``round`` is half-up and ``bround`` rounds
  the decimal value; both differ near ties);
* division by zero must give IEEE results (0/0 -> NaN) while ANSI mode raises, and
  ``greatest(NaN, floor)`` must stay NaN.
"""

from __future__ import annotations


def lit(value: str) -> str:
    """A Spark SQL string literal (backslash escapes; control chars as \\uXXXX)."""
    out = []
    for ch in value:
        if ch in "\\'":
            out.append("\\" + ch)
        elif ord(ch) < 32:
            out.append("\\u%04x" % ord(ch))
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def array_of(values) -> str:
    return "array(" + ", ".join(lit(v) for v in values) + ")"


def map_of(items: dict[str, str]) -> str:
    return "map(" + ", ".join(f"{lit(k)}, {lit(v)}" for k, v in items.items()) + ")"


def col(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rnd(x: str, digits: int) -> str:
    """numpy-style rounding: rint(x * 10^d) / 10^d."""
    scale = f"{float(10 ** digits)!r}D"
    return f"(rint(({x}) * {scale}) / {scale})"


def ieee_div(num: str, den: str) -> str:
    """Division with IEEE results for a zero divisor (0/0 -> NaN, x/0 -> +/-inf)."""
    return (f"(CASE WHEN ({den}) = 0 THEN (CASE WHEN ({num}) = 0 THEN double('NaN') "
            f"ELSE signum({num}) * double('Infinity') END) ELSE ({num}) / ({den}) END)")


def floor_at(x: str, floor: float) -> str:
    """max(x, floor) keeping NaN and null."""
    return f"(CASE WHEN ({x}) IS NOT NULL THEN greatest(({x}), {float(floor)!r}D) END)"


def ratio_or_one(total: str, rows: str, league: str, floor: float) -> str:
    """``max((total / rows) / league, floor)`` when ``rows > 0``, else 1.0."""
    per = ieee_div(total, rows)
    return (f"(CASE WHEN ({rows}) > 0 THEN {floor_at(ieee_div(per, league), floor)} "
            f"ELSE 1.0D END)")


def to_number(x: str, is_numeric: bool) -> str:
    """Text or number -> double or null (F5): ``try_cast`` takes Java's float suffixes (``1d``, ``2f``),
    which a pandas-style parser rejects, also before trailing white space."""
    if is_numeric:
        return f"CAST({x} AS DOUBLE)"
    t = f"CAST({x} AS STRING)"
    suffix, infinite = lit(r"(?i)[df]\s*$"), lit(r"(?i)inf\s*$")
    return (f"(CASE WHEN {t} RLIKE {suffix} AND NOT {t} RLIKE {infinite} "
            f"THEN CAST(NULL AS DOUBLE) ELSE try_cast({t} AS DOUBLE) END)")


def zero_if_missing(x: str) -> str:
    """NaN or null -> 0.0 (F6, the fill of P7)."""
    return f"coalesce(nanvl({x}, 0.0D), 0.0D)"


def is_present(x: str) -> str:
    """Not null and not NaN (what ``dropna`` keeps)."""
    return f"(({x}) IS NOT NULL AND NOT isnan({x}))"
