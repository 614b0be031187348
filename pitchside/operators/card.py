"""Model header and model card: A14-A16, K1/K2 payloads.

Both are one-row global aggregates over the enriched per-team strengths,
which carry the league figures, so they add no pass over the match fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.functions import sqltext as S
from pitchside.params import (
    CARD_ALGORITHM, CARD_FEATURES, CARD_LEAGUE, CARD_MODEL_NAME, CARD_TRAINING_SOURCE,
    CARD_VERSION, Params, utc_now,
)


def stamp(ts) -> Column:
    """A fixed timestamp parameter, or the current time in UTC."""
    return F.expr(_stamp_sql(ts))


def card_fields(enriched: DataFrame, params: Params = Params()) -> DataFrame:
    """A14 + A15: one flat row with every header and card field, as one
    aggregate over the enriched strengths carrying the league figures
    (:func:`pitchside.operators.strength.strengths_from_totals` with
    ``keep_league``): a single plan, one pass over its per-team rows."""
    day = lambda e: f"coalesce(substring(CAST({e} AS STRING), 1, 10), 'unknown')"
    return enriched.selectExpr(
        "max(league_n) AS n_matches",
        "max(league_avg_home) AS avg_home",
        "max(league_avg_away) AS avg_away",
        "count(1) AS teams_trained",
        f"{day('min(league_first)')} AS date_from",
        f"{day('max(league_last)')} AS date_to",
        "count_if(attack_index IS NOT NULL) AS kaggle_enriched_teams",
    )


def _stamp_sql(ts) -> str:
    ts = ts or utc_now()
    return f"CAST({S.lit(ts.strftime('%Y-%m-%d %H:%M:%S.%f'))} AS TIMESTAMP_NTZ)"


def model_header(enriched: DataFrame, params: Params = Params()) -> DataFrame:
    """K1 header row (``league_params``)."""
    return card_fields(enriched, params).selectExpr(
        f"{S.rnd('avg_home', 6)} AS league_avg_home_goals",
        f"{S.rnd('avg_away', 6)} AS league_avg_away_goals",
        "CAST(n_matches AS BIGINT) AS n_matches",
        "true AS fitted",
        f"{_stamp_sql(params.trained_at)} AS trained_at",
        "kaggle_enriched_teams > 0 AS kaggle_enriched",
        "CAST(kaggle_enriched_teams AS BIGINT) AS kaggle_enriched_teams",
    )


def model_card_flat(enriched: DataFrame, params: Params = Params()) -> DataFrame:
    """A16 flattened: the card's fields as plain columns."""
    return card_fields(enriched, params).selectExpr(
        f"{S.lit(CARD_MODEL_NAME)} AS model_name",
        f"{S.lit(CARD_VERSION)} AS version",
        f"{S.lit(CARD_ALGORITHM)} AS algorithm",
        f"{S.lit(CARD_TRAINING_SOURCE)} AS training_source",
        "CAST(n_matches AS BIGINT) AS training_matches",
        "date_from", "date_to",
        f"{S.lit(CARD_LEAGUE)} AS league",
        f"{S.rnd('avg_home', 4)} AS home_goals_per_match",
        f"{S.rnd('avg_away', 4)} AS away_goals_per_match",
        f"{S.rnd('avg_home + avg_away', 4)} AS total_goals_per_match",
        "CAST(teams_trained AS BIGINT) AS teams_trained",
        "CAST(kaggle_enriched_teams AS BIGINT) AS kaggle_enriched_teams",
        f"{S.lit(','.join(CARD_FEATURES))} AS kaggle_features",
        f"{_stamp_sql(params.trained_at)} AS trained_at",
    )


def model_card(enriched: DataFrame, params: Params = Params()) -> DataFrame:
    """The nested card record (structs + string array), one row."""
    f = model_card_flat(enriched, params)
    return f.select(
        "model_name", "version", "algorithm", "training_source", "training_matches",
        F.struct(F.col("date_from").alias("from"), F.col("date_to").alias("to")).alias("date_range"),
        "league",
        F.struct("home_goals_per_match", "away_goals_per_match", "total_goals_per_match")
        .alias("league_averages"),
        "teams_trained", "kaggle_enriched_teams",
        F.array(*[F.lit(c) for c in CARD_FEATURES]).alias("kaggle_features"),
        "trained_at",
    )


def card_json(card: DataFrame) -> DataFrame:
    """The card as one JSON text column."""
    return card.select(F.to_json(F.struct(*card.columns)).alias("model_card"))
