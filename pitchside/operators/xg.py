"""Expected-goals adjustment: A2, A7, J4.

One pass over the xG rows: U2 unpivot, partial aggregation per team, then the
league means are derived from the per-team sums (no second scan of the xG join).  Rows of teams outside the trained set still count in
the league means but never become a group of the output (J4 is a left join
from the trained teams).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType
from pyspark.sql import functions as F

from pitchside.functions import sqltext as S
from pitchside.operators.reshape import two_role_rows
from pitchside.params import Params

XG_COLS = ["xg_attack_home", "xg_defense_home", "xg_attack_away", "xg_defense_away", "xg_matches"]


def xg_team_sums(xg_rows: DataFrame) -> DataFrame:
    """Per team (null group kept): role counts and xG sums for and against."""
    schema = xg_rows.schema
    num = lambda c: S.to_number(c, isinstance(schema[c].dataType, NumericType))
    x = xg_rows.selectExpr("home_team_name", "away_team_name",
                           f"{num('xg_home')} AS xg_home", f"{num('xg_away')} AS xg_away"
                           ).filter(f"{S.is_present('xg_home')} AND {S.is_present('xg_away')}")
    roles = two_role_rows(x, "home_team_name", "away_team_name", "xg_home", "xg_away")
    return roles.groupBy("team").agg(
        F.expr("count(team) AS named_rows"),
        F.expr("count_if(is_home) AS xg_home_rows"),
        F.expr("count_if(NOT is_home) AS xg_away_rows"),
        F.expr("sum(CASE WHEN is_home THEN value_for END) AS xg_home_for"),
        F.expr("sum(CASE WHEN is_home THEN value_against END) AS xg_home_against"),
        F.expr("sum(CASE WHEN NOT is_home THEN value_for END) AS xg_away_for"),
        F.expr("sum(CASE WHEN NOT is_home THEN value_against END) AS xg_away_against"),
    )


SUM_COLS = ["xg_home_rows", "xg_away_rows", "xg_home_for", "xg_home_against", "xg_away_for", "xg_away_against"]
MEAN_COLS = ["xg_avg_home", "xg_avg_away"]


def with_xg_means(sums: DataFrame, materialised: bool = False) -> DataFrame:
    """A2: the league means on every per-team row (every xG row counts, unknown and null teams included): over
    ``materialised`` sums a scalar subquery, else a window over the per-team sums (one row per team)."""
    parts = {"_n": "sum(xg_home_rows)", "_for": "sum(xg_home_for)", "_against": "sum(xg_home_against)"}
    if materialised:
        league = sums.agg(F.struct(*[F.expr(f"{e} AS {n}") for n, e in parts.items()])).scalar()
        out = sums.withColumn("_league", league).selectExpr(*sums.columns, *[f"_league.{n} AS {n}" for n in parts])
    else:
        out = sums.selectExpr("*", *[f"{e} OVER () AS {n}" for n, e in parts.items()])
    return out.selectExpr(*sums.columns, f"{S.ieee_div('_for', '_n')} AS xg_avg_home", f"{S.ieee_div('_against', '_n')} AS xg_avg_away")


def gated(rows: DataFrame, params: Params = Params()) -> DataFrame:
    """The xG sums and means of per-team rows turned into the four ratios and the row count,
    present only for teams with at least ``params.xg_min_rows`` rows; a role without rows gives 1.0."""
    hn, an = "coalesce(xg_home_rows, 0)", "coalesce(xg_away_rows, 0)"
    gate = f"({hn} + {an}) >= {int(params.xg_min_rows)}"
    fl = params.floor
    out = {
        "xg_attack_home": S.rnd(S.ratio_or_one("xg_home_for", hn, "xg_avg_home", fl), 4),
        "xg_defense_home": S.rnd(S.ratio_or_one("xg_home_against", hn, "xg_avg_away", fl), 4),
        "xg_attack_away": S.rnd(S.ratio_or_one("xg_away_for", an, "xg_avg_away", fl), 4),
        "xg_defense_away": S.rnd(S.ratio_or_one("xg_away_against", an, "xg_avg_home", fl), 4),
        "xg_matches": f"CAST({hn} + {an} AS BIGINT)",
    }
    return rows.selectExpr(*[S.col(c) for c in rows.columns if c not in (*SUM_COLS, *MEAN_COLS)],
                           *[f"CASE WHEN {gate} THEN {v} END AS {k}" for k, v in out.items()])


def strengths_from_sums(sums: DataFrame, trained_teams: DataFrame, params: Params = Params(), materialised: bool = False) -> DataFrame:
    """A left join from the trained teams, whose other columns are carried through.  A trained
    team without xG rows never passes the gate, so it never needs the means."""
    per_team = with_xg_means(sums, materialised).filter("named_rows > 0").select("team", *SUM_COLS, *MEAN_COLS)
    return gated(trained_teams.join(per_team, "team", "left"), params)


def xg_strengths(xg_rows: DataFrame, trained_teams: DataFrame, params: Params = Params()) -> DataFrame:
    """The same from xG rows named by role."""
    return strengths_from_sums(xg_team_sums(xg_rows), trained_teams, params)
