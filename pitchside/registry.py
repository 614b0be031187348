"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's parquet tables through the fixture adapters and
runs one operator or composite from the library over the whole input.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.functions.literals import with_literal_fields
from pitchside.functions.text import canonical_team
from pitchside.functions.numeric import number_or_zero, to_number
from pitchside.operators import (
    card, enrich, impact, matches, names, players, quality, reshape, strength, style, upsert, xg,
)
from pitchside.plans import snapshots
from pitchside.plans.training import train, train_from_events
from pitchside.params import TESTED, XG_METRIC, Params
from pitchside.sources import files
from pitchside.sources import fixtures as fx

P: Params = TESTED
EARLIER: Params = replace(TESTED, snapshot_date="2026-01-01")


def _finished(spark: SparkSession, d: str) -> DataFrame:
    return matches.finished_matches(fx.events(spark, d), fx.teams(spark, d))


def _xg_rows(spark: SparkSession, d: str) -> DataFrame:
    return matches.xg_matches(fx.match_stats(spark, d), fx.events(spark, d), fx.teams(spark, d))


def q_finished_matches(spark, d):
    return _finished(spark, d)


def q_league_averages(spark, d):
    return strength.league_averages(_finished(spark, d))


def q_home_away_totals(spark, d):
    t = strength.home_away_totals(_finished(spark, d))
    return t.select("team", *[F.col(c).cast("bigint") if c.endswith("matches") else c
                              for c in strength.TOTAL_COLS])


def q_role_unpivot(spark, d):
    return reshape.two_role_rows(
        _finished(spark, d), "home_team_name", "away_team_name", "home_score", "away_score",
        keep=["event_id"],
    ).select("event_id", "team", "is_home",
             F.col("value_for").alias("goals_for"), F.col("value_against").alias("goals_against"))


def q_team_strengths(spark, d):
    return strength.team_strengths(_finished(spark, d), P)


def q_sorted_teams(spark, d):
    return reshape.sorted_teams(_finished(spark, d))


def q_row_gate(spark, d):
    return quality.row_gate(_finished(spark, d), P.min_matches)


def q_xg_matches(spark, d):
    return _xg_rows(spark, d)


def q_xg_strengths(spark, d):
    trained = reshape.team_set(strength.coerce_scores(_finished(spark, d)))
    return xg.xg_strengths(_xg_rows(spark, d), trained, P)


def q_player_strength_index(spark, d):
    return players.player_strength_index(fx.players(spark, d), P)


def q_last_wins_squads(spark, d):
    return players.squad_resolution(fx.players(spark, d), P)


def q_canonical_names(spark, d):
    p = fx.players(spark, d)
    return p.groupBy("Squad").agg(F.count(F.lit(1)).alias("players")).select(
        F.col("Squad").alias("squad"), canonical_team("Squad", P.aliases).alias("canonical"),
        "players")


def q_enriched_strengths(spark, d):
    s = strength.team_strengths(_finished(spark, d), P)
    return enrich.enrich_strengths(s, players.player_strength_index(fx.players(spark, d), P), P)


def q_player_impact_top10(spark, d):
    return impact.player_impact(fx.players(spark, d), P)


def q_team_style(spark, d):
    return style.team_style(fx.style_matches(spark, d), P)


def q_literal_names(spark, d):
    named = style.cell_pair_names(fx.style_matches(spark, d), P)
    return named.groupBy("home_name", "away_name").agg(F.sum("rows").alias("rows"))


def _trained(spark, d):
    feats = players.player_strength_index(fx.players(spark, d), P)
    return train_from_events(fx.events(spark, d), fx.teams(spark, d), fx.match_stats(spark, d), feats, P)


def _trained_without_xg(spark, d):
    return train(_finished(spark, d), None, players.player_strength_index(fx.players(spark, d), P), P)


def q_full_training(spark, d):
    return _trained(spark, d).team_strengths


def q_league_params(spark, d):
    return _trained_without_xg(spark, d).league_params


def q_model_card(spark, d):
    return card.model_card_flat(_trained_without_xg(spark, d).with_league, P)


def q_numeric_coercion(spark, d):
    raw = fx.style_matches(spark, d)
    return raw.groupBy(F.col("home_score").alias("score_text")).agg(
        F.count(F.lit(1)).alias("rows")).withColumn("parsed", to_number("score_text")).select(
        "score_text",
        F.expr("nullif(parsed, double('NaN'))").alias("parsed"), F.expr("coalesce(isnan(parsed), false)").alias("is_nan"),
        number_or_zero("score_text").alias("filled"),
        "rows",
    )


def q_upsert_latest(spark, d):
    stored, batch = fx.upsert_tables(spark, d)
    stored = upsert.latest_rows(stored, ["o_custkey"], ["ordinal"])
    return upsert.upsert(stored, batch, ["o_custkey"], ["ordinal"]).drop("ordinal")


def q_snapshot_player_strength(spark, d):
    feats = players.player_strength_index(fx.players(spark, d), P)
    return snapshots.player_strength_snapshot(feats, P)


def q_snapshot_style(spark, d):
    return snapshots.style_snapshot(style.team_style(fx.style_matches(spark, d), P), P)


def q_snapshot_impact(spark, d):
    return snapshots.impact_snapshot(impact.player_impact(fx.players(spark, d), P), P)


def _split_players(spark, d):
    """The player file as it stood on two days: first the parts with an even key, then all."""
    p = fx.players(spark, d)
    return p.filter("ordinal % 2 = 0"), p


def q_snapshot_player_strength_merge(spark, d):
    early, late = _split_players(spark, d)
    stored = snapshots.player_strength_snapshot(players.player_strength_index(early, EARLIER), EARLIER)
    batch = players.player_strength_index(late.filter("Squad <> 'Arsenal'"), P)
    return snapshots.player_strength_snapshot(batch, P, stored)


def q_impact_history(spark, d):
    early, late = _split_players(spark, d)
    stored = snapshots.impact_snapshot(impact.player_impact(early, EARLIER), EARLIER)
    return snapshots.impact_snapshot(impact.player_impact(late, P), P, stored)


def q_snapshot_style_merge(spark, d):
    rows = fx.style_matches(spark, d)
    stored = snapshots.style_snapshot(style.team_style(rows, EARLIER), EARLIER)
    batch = style.team_style(rows.filter("home_team NOT LIKE '%Arsenal%' AND away_team NOT LIKE '%Arsenal%'"), P)
    return snapshots.style_snapshot(batch, P, stored)


def q_literal_names_nested(spark, d):
    named = with_literal_fields(fx.nested_cells(spark, d), [("cell", "home_team_name", "name")], pending=True)
    return named.groupBy("name", F.col("name_pending").alias("by_python")).agg(F.count("*").alias("rows"))


def q_missing_columns(spark, d):
    absent = fx.players(spark, d).drop("tkl_int", "Blocks", "Clr", "xAG")
    return players.player_strength_index(absent, P)


def q_na_tokens(spark, d):
    cells = files.null_na_tokens(fx.token_cells(spark, d), ["cell"])
    return cells.groupBy("cell").agg(F.count("*").alias("rows"))


def q_ordered_matches(spark, d):
    out = matches.finished_matches(fx.events(spark, d), fx.teams(spark, d), ordered=True)
    return out.select("event_id", "time_utc")


def q_model_card_json(spark, d):
    return card.card_json(_trained_without_xg(spark, d).model_card)


def q_plain_training(spark, d):
    """Neither xG nor features."""
    return train(_finished(spark, d), None, None, P).team_strengths


def q_stage_counts(spark, d):
    """Rows at each stage and the literal cells that Python decided, observed while the pipelines run once."""
    seen, ps = quality.Counts(), fx.players(spark, d)
    metric = seen("xg", fx.match_stats(spark, d).filter(F.col("metric") == XG_METRIC))
    result = train_from_events(fx.events(spark, d), fx.teams(spark, d), metric,
                               players.player_strength_index(ps, P, seen), P, seen=seen)
    for df in (result.team_strengths, impact.player_impact(ps, P, seen=seen), style.team_style(fx.style_matches(spark, d), P, seen)):
        df.write.format("noop").mode("overwrite").save()
    stages = ("matches", "xg", "players", "impact_players", "style", "residual_literals")
    counts = seen.take(*stages)
    return spark.createDataFrame([(k, counts[k]) for k in stages], "stage string, rows long")


def q_null_names(spark, d):
    """Strengths where every 11th match lacks its home team, every 13th its away score."""
    m = _finished(spark, d)
    key = F.conv(F.substring(F.md5("event_id"), 1, 6), 16, 10).cast("int")
    m = m.withColumns({"home_team_name": F.when(key % 11 != 0, F.col("home_team_name")),
                       "away_score": F.when(key % 13 != 0, F.col("away_score"))})
    return strength.team_strengths(m, P)


def _brand_aliases(spark, d):
    """Aliases out of a table: the brands of the upper half stand for their first type."""
    part = spark.read.parquet(f"{d}/part.parquet")
    dim = part.filter("p_brand >= 'Brand#3'").groupBy("p_brand").agg(F.min("p_type").alias("canonical"))
    raw = part.select(F.concat(F.lit("\t "), F.upper("p_brand"), F.lit(" ")).alias("raw"))
    return raw, names.alias_table(dim, "p_brand", "canonical")


def q_alias_table(spark, d):
    """P9 over an alias table."""
    raw, table = _brand_aliases(spark, d)
    return names.with_canonical(raw, "raw", table, "canonical").groupBy("canonical").agg(F.count("*").alias("rows"))


def q_unknown_names(spark, d):
    """Raw names that neither an alias nor a team knows."""
    raw, table = _brand_aliases(spark, d)
    teams = spark.read.parquet(f"{d}/part.parquet").filter("p_brand < 'Brand#2'").select(F.upper("p_brand").alias("name"))
    return names.unknown_names(raw, "raw", table, teams)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "finished_matches": q_finished_matches,
    "league_averages": q_league_averages,
    "home_away_totals": q_home_away_totals,
    "role_unpivot": q_role_unpivot,
    "team_strengths": q_team_strengths,
    "sorted_teams": q_sorted_teams,
    "row_gate": q_row_gate,
    "xg_matches": q_xg_matches,
    "xg_strengths": q_xg_strengths,
    "player_strength_index": q_player_strength_index,
    "last_wins_squads": q_last_wins_squads,
    "canonical_names": q_canonical_names,
    "enriched_strengths": q_enriched_strengths,
    "player_impact_top10": q_player_impact_top10,
    "team_style": q_team_style,
    "literal_names": q_literal_names,
    "numeric_coercion": q_numeric_coercion,
    "full_training": q_full_training,
    "league_params": q_league_params,
    "model_card": q_model_card,
    "upsert_latest": q_upsert_latest,
    "snapshot_player_strength": q_snapshot_player_strength,
    "snapshot_style": q_snapshot_style,
    "snapshot_impact": q_snapshot_impact,
    "snapshot_player_strength_merge": q_snapshot_player_strength_merge,
    "snapshot_style_merge": q_snapshot_style_merge,
    "impact_history": q_impact_history,
    "literal_names_nested": q_literal_names_nested,
    "missing_columns": q_missing_columns,
    "na_tokens": q_na_tokens,
    "ordered_matches": q_ordered_matches,
    "model_card_json": q_model_card_json,
    "plain_training": q_plain_training,
    "stage_counts": q_stage_counts,
    "null_names": q_null_names,
    "alias_table": q_alias_table,
    "unknown_names": q_unknown_names,
}
