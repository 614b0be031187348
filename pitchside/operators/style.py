"""Team style rates from a style-match file: P6, P8, P10, U2, A12 (pipeline C6)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from pitchside.functions.literals import decide, literal_columns, waiting
from pitchside.functions import sqltext as S
from pitchside.functions.text import canonical_team
from pitchside.operators.quality import Seen, unseen
from pitchside.params import Params

STYLE_COLS = ["matches_count", "avg_goals_scored", "avg_goals_conceded",
              "clean_sheet_rate", "btts_rate", "avg_goal_diff"]


CELLS = [("home_team", "home_team_name", "home_raw"), ("away_team", "away_team_name", "away_raw")]


def name_pairs(raw: DataFrame, params: Params, aggregates: list[str], seen: Seen = unseen) -> DataFrame:
    """P10 + P9: ``raw`` aggregated per pair of team names, ``home_name, away_name`` and the aggregates.

    Cells are parsed where they are read and the shuffle carries the short names; only a cell that
    Python has to decide travels as it is.  Such groups are then decided in a branch of their own, and all
    branches read one aggregate: ``waiting``, how many rows wait, keeps the split above it, and every branch needs
    every column, so cells are parsed once.
    """
    parsed = literal_columns(raw, CELLS).withColumn("waits", waiting(CELLS))
    keys = [c for _, _, out in CELLS for c in (out, f"{out}_cell")]
    names = [o for o in (re.search(r" AS (\w+)$", a).group(1) for a in aggregates)]
    groups = parsed.groupBy(*keys).agg(*[F.expr(a) for a in aggregates], F.expr("count_if(waits) AS waiting"))
    by_python = seen("residual_literals", groups.filter("waiting > 0"), "sum(waiting)")
    both = groups.filter("waiting = 0").unionByName(decide(by_python, CELLS, shared=True))
    return both.select(canonical_team("home_raw", params.aliases).alias("home_name"),
                       canonical_team("away_raw", params.aliases).alias("away_name"), *names)


def team_style(raw: DataFrame, params: Params = Params(), seen: Seen = unseen) -> DataFrame:
    """A12 per team over both roles: count, mean for/against, clean-sheet rate,
    both-teams-scored rate, and the difference of the unrounded means.

    Rows are aggregated per pair of names (:func:`name_pairs`) and the pair sums are folded into teams
    through U2.  Pairs with an empty name are excluded by conditional
    aggregation rather than a row filter (a filter on parsed names could be
    pushed below the parse); a team left with no usable match is dropped
    after the aggregate.  ``seen`` counts the stages ``style``, ``residual_literals`` and ``style_teams``.
    """
    schema = raw.schema
    num = lambda c: S.to_number(c, isinstance(schema[c].dataType, NumericType))
    # Scores are parsed once in a projection; rows with an unusable score are
    # left out by conditional aggregation (a row filter would be pushed into
    # the source scan and re-parse the text once per predicate).
    scored = seen("style", raw).selectExpr("home_team", "away_team", f"{num('home_score')} AS hs", f"{num('away_score')} AS as_")
    scored = scored.selectExpr("*", f"{S.is_present('hs')} AND {S.is_present('as_')} AS ok")
    named = name_pairs(scored, params, [
        "count_if(ok) AS n",
        "sum(CASE WHEN ok THEN hs END) AS home_goals",
        "sum(CASE WHEN ok THEN as_ END) AS away_goals",
        "count_if(ok AND as_ = 0) AS home_clean",
        "count_if(ok AND hs = 0) AS away_clean",
        "count_if(ok AND hs > 0 AND as_ > 0) AS both_scored",
    ], seen)
    usable = ("coalesce(length(home_name), 0) > 0 AND coalesce(length(away_name), 0) > 0")
    roles = named.selectExpr(
        f"{usable} AS usable",
        "inline(array("
        "struct(home_name AS team, n, home_goals AS gf, away_goals AS ga, home_clean AS clean, both_scored),"
        "struct(away_name AS team, n, away_goals AS gf, home_goals AS ga, away_clean AS clean, both_scored)))")
    agg = roles.groupBy("team").agg(*[F.expr(e) for e in (
        "sum(CASE WHEN usable THEN n ELSE 0 END) AS matches_count",
        "sum(CASE WHEN usable THEN gf END) AS gf",
        "sum(CASE WHEN usable THEN ga END) AS ga",
        "sum(CASE WHEN usable THEN clean END) AS clean",
        "sum(CASE WHEN usable THEN both_scored END) AS btts",
    )]).filter("matches_count > 0")
    avg_for, avg_against = "(gf / matches_count)", "(ga / matches_count)"
    return seen("style_teams", agg).selectExpr(
        "team AS team_name",
        "CAST(matches_count AS BIGINT) AS matches_count",
        f"{S.rnd(avg_for, 4)} AS avg_goals_scored",
        f"{S.rnd(avg_against, 4)} AS avg_goals_conceded",
        f"{S.rnd('clean / matches_count', 4)} AS clean_sheet_rate",
        f"{S.rnd('btts / matches_count', 4)} AS btts_rate",
        f"{S.rnd(f'{avg_for} - {avg_against}', 4)} AS avg_goal_diff",
    )


def cell_pair_names(raw: DataFrame, params: Params = Params()) -> DataFrame:
    """P10 + P9 per distinct pair of names: ``home_name, away_name, rows`` (all rows, whatever their scores)."""
    return name_pairs(raw, params, ["count(1) AS rows"])
