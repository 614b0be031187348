"""Typed run parameters and the fixed values the outputs must reproduce.

Everything a caller may want to tune (thresholds, floors, top-k, season) is a
field of :class:`Params`.  Tested queries pass explicit dates and timestamps so
results never depend on the wall clock; only the job wrapper stamps "now".
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the modelled job's for identical output).
# ---------------------------------------------------------------------------

# Canonical alias map, raw lower-cased squad name -> canonical team name.
TEAM_ALIASES: dict[str, str] = {
    "manchester city": "Man City",
    "manchester utd": "Man Utd",
    "manchester united": "Man Utd",
    "tottenham hotspur": "Tottenham",
    "spurs": "Tottenham",
    "newcastle utd": "Newcastle",
    "newcastle united": "Newcastle",
    "sheffield utd": "Sheffield Utd",
    "sheffield united": "Sheffield Utd",
    "brighton and hove albion": "Brighton",
    "brighton": "Brighton",
    "wolverhampton wanderers": "Wolves",
    "wolves": "Wolves",
    "west ham utd": "West Ham",
    "west ham united": "West Ham",
    "nottingham forest": "Nott'm Forest",
    "nottm forest": "Nott'm Forest",
    "nott'm forest": "Nott'm Forest",
    "leicester city": "Leicester",
    "norwich city": "Norwich",
    "swansea city": "Swansea",
    "cardiff city": "Cardiff",
    "stoke city": "Stoke",
    "hull city": "Hull",
    "luton town": "Luton",
    "ipswich town": "Ipswich",
}

# Model-card text fields.
CARD_MODEL_NAME = "Poisson Match Predictor"
CARD_VERSION = "2.1.0"
CARD_ALGORITHM = (
    "Independent Poisson Goals (Dixon-Coles inspired) + FBref player strength enrichment"
)
CARD_TRAINING_SOURCE = "Supabase (live) + Kaggle FBref (offline enrichment)"
CARD_LEAGUE = "England Premier League (BetsAPI ID: 94)"
CARD_FEATURES = ["attack_index", "creation_index", "defensive_index", "squad_depth"]

# Match status code meaning "ended".
STATUS_ENDED = 3
# Metric name of expected goals in the long metric table.
XG_METRIC = "xg"
# Player-season numeric columns (after renaming `90s` -> nineties, `Tkl+Int` -> tkl_int).
PLAYER_MEASURES = [
    "nineties", "Gls", "Ast", "xG", "xAG", "KP", "PrgP",
    "TklW", "Int", "tkl_int", "Blocks", "Clr",
]
# Tokens pandas' CSV reader treats as missing by default.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def utc_now() -> _dt.datetime:
    """The current time in UTC, whatever the session's or the machine's zone."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Params:
    """Tunable parameters; defaults reproduce the modelled job."""

    min_matches: int = 100            # G1 gate
    xg_min_rows: int = 10             # A7 gate
    floor: float = 0.1                # P11
    index_min_90s: float = 1.0        # P5 (indices)
    impact_min_90s: float = 3.0       # P5 (impact)
    depth_min_90s: float = 5.0        # A10
    impact_minutes_weight: float = 0.1  # W1
    impact_scale: float = 10.0        # W1
    top_k: int = 10                   # W2
    competition: str = "Premier League"  # P4
    season: str = "2025/2026"         # P12
    snapshot_buckets: int = 64        # K3-K5: hash buckets of a snapshot table's key
    snapshot_date: str | None = None  # P12; ISO date, None -> today in UTC
    created_at: _dt.datetime | None = None  # P12; None -> now in UTC
    trained_at: _dt.datetime | None = None  # model header; None -> now in UTC
    aliases: dict[str, str] = field(default_factory=lambda: dict(TEAM_ALIASES))


DEFAULT = Params()

# Parameters used by registered queries so their output is reproducible.
FIXED_DATE = "2026-01-05"
FIXED_TS = _dt.datetime(2026, 1, 5, 3, 0, 0)
TESTED = Params(snapshot_date=FIXED_DATE, created_at=FIXED_TS, trained_at=FIXED_TS)
