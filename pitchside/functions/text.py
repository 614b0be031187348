"""String scalar functions (F1-F4, F14) and canonical team names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchside.params import TEAM_ALIASES

# Python's str.strip() removes every character for which str.isspace() holds;
# the set is derived from that rule (it has no members above U+3000).
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(x) -> Column:
    """strip leading/trailing Unicode white space (``trim`` keeps tabs).

    ``btrim`` removes any of the given characters from both ends: a plain
    character scan, no regular expression."""
    return F.btrim(_c(x), F.lit(PY_WHITESPACE))


def alias_map(aliases: dict[str, str] | None = None) -> Column:
    """The alias dictionary as a map literal (26 entries by default)."""
    items = (aliases if aliases is not None else TEAM_ALIASES).items()
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(items)])


def canonical_team(x, aliases: dict[str, str] | None = None) -> Column:
    """Strip, lower-case, look up the alias, else the stripped original.

    A map-literal lookup keeps this a pure projection (no join).  Case of the
    fallback is preserved, as only the lookup key is lower-cased.
    """
    stripped = py_strip(x)
    return F.coalesce(F.try_element_at(alias_map(aliases), F.lower(stripped)), stripped)


def text_or_empty(x) -> Column:
    """missing text -> ''."""
    return F.coalesce(_c(x).cast("string"), F.lit(""))
