"""Layered enrichment join J5 (pipeline C3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.functions.text import canonical_team
from pitchside.operators.players import INDEX_COLS
from pitchside.params import Params


def enrich_strengths(strengths: DataFrame, features: DataFrame, params: Params = Params()) -> DataFrame:
    """Attach player indices to team strengths: exact team name first, else the
    canonicalised name; unmatched teams keep nulls.

    One join: every team row becomes two candidate rows (its exact name, then
    its canonical name), left-joined to the per-team features (one row per
    team; AQE broadcasts them when small), and the best hit per team is kept
    by an aggregate over the team's own columns.  Features and strengths are
    each planned once.
    """
    f = features.select(F.col("team").alias("_feat_key"), F.struct(*INDEX_COLS).alias("_feats"))
    cols = strengths.columns
    cands = strengths.select(
        *cols,
        F.inline(F.array(
            F.struct(F.lit(0).alias("_rank"), F.col("team").alias("_key")),
            F.struct(F.lit(1).alias("_rank"),
                     canonical_team("team", params.aliases).alias("_key")))),
    )
    hits = cands.join(f, cands["_key"] == f["_feat_key"], "left")
    rank = F.when(F.col("_feats").isNull(), F.lit(2)).otherwise(F.col("_rank"))
    best = hits.groupBy(*cols).agg(F.min_by("_feats", rank).alias("_feats"))
    return best.select(*cols, *[F.col("_feats").getField(k).alias(k) for k in INDEX_COLS])


def enriched_count(enriched: DataFrame) -> DataFrame:
    """One row: how many teams received the indices."""
    return enriched.agg(F.count_if(F.col("attack_index").isNotNull()).alias("kaggle_enriched_teams"))
