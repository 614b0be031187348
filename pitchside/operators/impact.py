"""Player absence impact: A13, W1-W3 (pipeline C7).

A team may hold a third of all players, so its rows are dealt over ``SALTS`` keys: the per-team
maximum (partial and final aggregate, one row per team, repeated per salt) joins on team and
salt, the top k are taken per team and salt, and only those, at most ``k * SALTS`` rows of a team,
meet for the top k of the team.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchside.functions import sqltext as S
from pitchside.functions.numeric import rnd
from pitchside.functions.text import canonical_team, text_or_empty
from pitchside.operators.players import eligible_players
from pitchside.operators.quality import Seen, unseen
from pitchside.params import Params, utc_now

SALTS = 32
IMPACT_MEASURES = ["nineties", "Gls", "Ast"]


def player_impact(players: DataFrame, params: Params = Params(), snapshot_date=None, seen: Seen = unseen) -> DataFrame:
    """Top-k key players per canonical team with a 0-10 impact score.

    ``players`` needs ``Player, Pos, Squad, Comp, nineties, Gls, Ast`` and an
    ``ordinal`` (file order) that breaks ties at rank k like the file order does.
    Output ``team_name, player_name, position, minutes_90s, goals, assists,
    impact_score, rank, snapshot_date``.
    """
    for c in ("Player", "Pos"):                       # F14: an absent column is missing text
        if c not in players.columns:
            players = players.withColumn(c, F.lit(None).cast("string"))
    p = (
        seen("impact_players", eligible_players(players, params.impact_min_90s, params, IMPACT_MEASURES))
        .withColumn("team_name", canonical_team("Squad", params.aliases))
        .filter(F.col("team_name").isNotNull())
        .withColumn("raw_impact", F.expr(f"Gls + Ast + nineties * {float(params.impact_minutes_weight)!r}D"))
        .withColumn("_salt", F.pmod(F.xxhash64("ordinal"), F.lit(SALTS)).cast("int"))
    )
    best = (p.groupBy("team_name").agg(F.max("raw_impact").alias("max_impact")).filter("max_impact > 0")
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    score = S.rnd(f"{S.ieee_div('raw_impact', 'max_impact')} * {float(params.impact_scale)!r}D", 2)
    scored = p.join(best, ["team_name", "_salt"]).withColumn("impact_score", F.expr(score))
    top = scored
    for keys in (["team_name", "_salt"], ["team_name"]):
        w = Window.partitionBy(*keys).orderBy(F.desc("impact_score"), F.asc("ordinal"))
        top = top.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= params.top_k)
    date = params.snapshot_date if snapshot_date is None else snapshot_date
    return top.select(
        "team_name",
        text_or_empty("Player").alias("player_name"),
        text_or_empty("Pos").alias("position"),
        rnd("nineties", 2).alias("minutes_90s"),
        F.col("Gls").cast("int").alias("goals"),
        F.col("Ast").cast("int").alias("assists"),
        "impact_score",
        F.col("rank").cast("int").alias("rank"),
        F.lit(date or utc_now().date().isoformat()).cast("date").alias("snapshot_date"),
    )
