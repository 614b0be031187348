"""Player-season indices per team: P4, P5, P7, S6, A8-A11 (pipeline C2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from pitchside.functions import sqltext as S
from pitchside.functions.text import canonical_team
from pitchside.operators.quality import Seen, unseen
from pitchside.params import PLAYER_MEASURES, Params

INDEX_COLS = ["attack_index", "creation_index", "defensive_index", "squad_depth"]


def conform_measures(df: DataFrame, measures=PLAYER_MEASURES) -> DataFrame:
    """S6 + P7: absent measure columns become 0.0; present ones are coerced,
    invalid/NaN/null -> 0.0."""
    schema = {f.name: f.dataType for f in df.schema.fields}

    def filled(m):
        if m not in schema:
            return "0.0D"
        v = S.to_number(S.col(m), isinstance(schema[m], NumericType))
        return S.zero_if_missing(v)

    keep = [S.col(c) for c in df.columns if c not in measures]
    return df.selectExpr(*keep, *[f"{filled(m)} AS {S.col(m)}" for m in measures])


def in_competition(params: Params = Params()) -> str:
    """Competition substring, case-sensitive; null is no match."""
    return f"coalesce(contains(CAST(Comp AS STRING), {S.lit(params.competition)}), false)"


def eligible_players(players: DataFrame, min_90s: float, params: Params = Params(),
                     measures=PLAYER_MEASURES) -> DataFrame:
    """P4 (competition substring, case-sensitive) + S6/P7 + P5 (playing time)."""
    p = players.filter(in_competition(params))
    return conform_measures(p, measures).filter(f"nineties >= {float(min_90s)!r}D")


def squad_indices(players: DataFrame, params: Params = Params(), seen: Seen = unseen) -> DataFrame:
    """A8-A10 per raw squad: 90s-weighted means of season totals, richer
    defensive signal when the squad has any ``Tkl+Int``, and squad depth."""
    p = seen("players", eligible_players(players, params.index_min_90s, params)).filter("Squad IS NOT NULL")
    g = p.groupBy("Squad").agg(*[F.expr(e) for e in (
        "sum(nineties) AS total_90s",
        "sum(nineties * (Gls + xG)) AS attack_w",
        "sum(nineties * (Ast + xAG + KP + PrgP)) AS creation_w",
        "sum(tkl_int) AS tkl_int_sum",
        "sum(nineties * (tkl_int + Blocks + Clr)) AS def_rich_w",
        "sum(nineties * (TklW + `Int`)) AS def_basic_w",
        f"count_if(nineties >= {float(params.depth_min_90s)!r}D) AS squad_depth",
    )]).filter("total_90s >= 1.0D")
    return g.selectExpr(
        "Squad",
        f"{S.rnd(S.ieee_div('attack_w', 'total_90s'), 4)} AS attack_index",
        f"{S.rnd(S.ieee_div('creation_w', 'total_90s'), 4)} AS creation_index",
        f"{S.rnd(S.ieee_div('CASE WHEN tkl_int_sum > 0 THEN def_rich_w ELSE def_basic_w END', 'total_90s'), 4)}"
        " AS defensive_index",
        "CAST(squad_depth AS INT) AS squad_depth",
    )


def player_strength_index(players: DataFrame, params: Params = Params(), seen: Seen = unseen) -> DataFrame:
    """C2 result: one row per canonical team.

    A11: squads are grouped by their raw name, then canonicalised; when two raw
    names share a canonical name the greatest raw name wins (they are not
    merged).  ``max_by`` runs on the small per-squad result only.
    """
    s = squad_indices(players, params, seen).withColumn("team", canonical_team("Squad", params.aliases))
    best = s.groupBy("team").agg(
        F.max_by(F.struct(*INDEX_COLS), F.col("Squad")).alias("v"))
    return seen("featured_teams", best).select("team", *[F.col(f"v.{c}").alias(c) for c in INDEX_COLS])


def squad_resolution(players: DataFrame, params: Params = Params()) -> DataFrame:
    """A11 + P9 view: per canonical team, the raw squad whose indices win and
    how many raw squads collapsed into it."""
    s = squad_indices(players, params).withColumn("team", canonical_team("Squad", params.aliases))
    return s.groupBy("team").agg(
        F.max("Squad").alias("winning_squad"),
        F.count(F.lit(1)).alias("raw_squads"),
    )
