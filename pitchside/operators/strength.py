"""Team attack/defence ratios: A1, A3-A6, P6, P11 via U2 and J6.

Plan shape: scan -> coerce -> U2 (Generate) -> partial aggregate per team ->
shuffle(team) -> final aggregate.  League means come from that
per-team result, so the fact is read once.  A team holding a third of all matches only adds rows to
map-side partial aggregates: the shuffle carries one row per team per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType
from pyspark.sql import functions as F

from pitchside.functions import sqltext as S
from pitchside.functions.numeric import is_present, to_number
from pitchside.operators.reshape import two_role_rows
from pitchside.params import Params

TOTAL_COLS = [
    "home_goals_scored", "home_goals_conceded", "home_matches",
    "away_goals_scored", "away_goals_conceded", "away_matches",
]


def coerce_scores(matches: DataFrame, home="home_score", away="away_score") -> DataFrame:
    """Scores to double; rows where either fails (null or NaN) are dropped."""
    schema = matches.schema
    m = matches.withColumns({
        home: to_number(home, schema[home].dataType),
        away: to_number(away, schema[away].dataType),
    })
    return m.filter(is_present(home) & is_present(away))


def role_totals(matches: DataFrame, home_team="home_team_name", away_team="away_team_name",
                home="home_score", away="away_score", time_col: str | None = None) -> DataFrame:
    """A3 + A4 (+ J3 as conditional aggregation): per team, both roles.

    Keeps the null-team group: its matches still count in league totals.  A
    team absent from a role gets null sums and a zero count for it.  With
    ``time_col`` the same single pass also yields ``raw_home_rows`` (rows before
    score coercion, for the G1 gate) and the first/last kick-off of the valid
    matches (A14), so a training run reads the match fact exactly once.
    """
    schema = matches.schema
    num = lambda c: S.to_number(S.col(c), isinstance(schema[c].dataType, NumericType))
    scored = matches.selectExpr(
        *[S.col(c) for c in (home_team, away_team) + ((time_col,) if time_col else ())],
        f"{num(home)} AS {S.col(home)}", f"{num(away)} AS {S.col(away)}")
    valid = f"{S.is_present(S.col(home))} AND {S.is_present(S.col(away))}"
    if time_col is None:
        roles = two_role_rows(scored.filter(valid), home_team, away_team, home, away)
        ok = "true"
    else:
        roles = two_role_rows(scored.selectExpr("*", f"{valid} AS _valid"), home_team, away_team,
                              home, away, keep=["_valid", time_col])
        ok = "_valid"

    def agg(fn, cond, what, name):
        return F.expr(f"{fn}(CASE WHEN {cond} THEN {what} END) AS {name}")

    h, a = f"is_home AND {ok}", f"NOT is_home AND {ok}"
    aggs = [
        # Non-null rows of the group key: 0 only for the null-team group.  The
        # named-team filter is written on this aggregate output, so Catalyst
        # cannot push it below the aggregate; league totals and strengths then
        # share one aggregate instead of scanning twice.
        F.expr("count(team) AS named_rows"),
        agg("sum", h, "value_for", "home_goals_scored"),
        agg("sum", h, "value_against", "home_goals_conceded"),
        F.expr(f"count_if({h}) AS home_matches"),
        agg("sum", a, "value_for", "away_goals_scored"),
        agg("sum", a, "value_against", "away_goals_conceded"),
        F.expr(f"count_if({a}) AS away_matches"),
    ]
    if time_col is not None:
        aggs += [
            F.expr("count_if(is_home) AS raw_home_rows"),
            agg("min", ok, S.col(time_col), "first_time"),
            agg("max", ok, S.col(time_col), "last_time"),
        ]
    return roles.groupBy("team").agg(*aggs)


def named(totals: DataFrame) -> DataFrame:
    """Per-team rows of real (non-null) teams; see ``named_rows``."""
    return totals.filter(F.col("named_rows") > 0)


def league_averages(matches: DataFrame) -> DataFrame:
    """A1 as published: rounded league means and the match count, one global aggregate."""
    means = coerce_scores(matches).selectExpr("home_score AS h", "away_score AS a").agg(
        F.count("*").alias("n_matches"), F.sum("h").alias("h"), F.sum("a").alias("a"))
    home, away = S.ieee_div("h", "n_matches"), S.ieee_div("a", "n_matches")
    return means.selectExpr(
        f"{S.rnd(home, 6)} AS league_avg_home_goals", f"{S.rnd(away, 6)} AS league_avg_away_goals",
        f"{S.rnd(f'{home} + {away}', 4)} AS total_goals_per_match", "n_matches")


def with_league_means(totals: DataFrame, materialised: bool = False) -> DataFrame:
    """J6 on the per-team result: league means on every per-team row.

    Over ``materialised`` totals (a checkpoint) they are a scalar subquery: one aggregate, partial in every task, and no
    task gets more than one row of each, however many teams there are.  Over totals that are still a plan
    that would read the match fact again, so they are a window over the whole per-team result (one row per team, null group
    included): Catalyst prunes the unused aggregate columns of a second branch, which then no
    longer matches the first one.  That window's input is bounded by the number of teams, not of matches.
    """
    names = {"league_n": "sum(home_matches)", "_home": "sum(home_goals_scored)", "_away": "sum(home_goals_conceded)"}
    if "first_time" in totals.columns:
        names |= {"league_first": "min(first_time)", "league_last": "max(last_time)"}
    if materialised:
        league = totals.agg(F.struct(*[F.expr(f"{e} AS {n}") for n, e in names.items()])).scalar()
        out = totals.withColumn("_league", league).selectExpr(*totals.columns, *[f"_league.{n} AS {n}" for n in names])
    else:
        out = totals.selectExpr("*", *[f"{e} OVER () AS {n}" for n, e in names.items()])
    return out.selectExpr(*totals.columns, *[n for n in names if n.startswith("league")],
                          f"{S.ieee_div('_home', 'league_n')} AS avg_home", f"{S.ieee_div('_away', 'league_n')} AS avg_away")


LEAGUE_COLS = ["league_n", "league_avg_home", "league_avg_away", "league_first", "league_last"]


def strengths_from_totals(totals: DataFrame, params: Params = Params(),
                          keep_league: bool = False, carry: Sequence[str] = (), materialised: bool = False) -> DataFrame:
    """A5 + A6: role and pooled strengths from per-team totals (rounded to 4), with the columns to ``carry``.

    ``keep_league`` also carries the league figures (match count, means,
    first/last kick-off; the same on every row) so the model card can be
    derived from this one plan."""
    t = named(with_league_means(totals, materialised))
    extra = []
    if keep_league:
        has_time = "first_time" in totals.columns
        extra = [
            "league_n", "avg_home AS league_avg_home", "avg_away AS league_avg_away",
            ("league_first" if has_time else "CAST(NULL AS TIMESTAMP_NTZ) AS league_first"),
            ("league_last" if has_time else "CAST(NULL AS TIMESTAMP_NTZ) AS league_last"),
        ]
    fl = params.floor
    games = "(home_matches + away_matches)"
    avg_total = "((avg_home + avg_away) / 2.0D)"

    def pooled(home, away):
        total = f"(coalesce({home}, 0.0D) + coalesce({away}, 0.0D))"
        return (f"CASE WHEN {games} = 0 THEN 1.0D ELSE "
                f"{S.floor_at(S.ieee_div(S.ieee_div(total, games), avg_total), fl)} END")

    return t.selectExpr(
        "team",
        *extra,
        *carry,
        f"{S.rnd(pooled('home_goals_scored', 'away_goals_scored'), 4)} AS attack",
        f"{S.rnd(pooled('home_goals_conceded', 'away_goals_conceded'), 4)} AS defense",
        f"{S.rnd(S.ratio_or_one('home_goals_scored', 'home_matches', 'avg_home', fl), 4)} AS attack_home",
        f"{S.rnd(S.ratio_or_one('away_goals_scored', 'away_matches', 'avg_away', fl), 4)} AS attack_away",
        f"{S.rnd(S.ratio_or_one('home_goals_conceded', 'home_matches', 'avg_away', fl), 4)} AS defense_home",
        f"{S.rnd(S.ratio_or_one('away_goals_conceded', 'away_matches', 'avg_home', fl), 4)} AS defense_away",
    )


def team_strengths(matches: DataFrame, params: Params = Params()) -> DataFrame:
    """Flagship: ``team, attack, defense, attack_home, attack_away,
    defense_home, defense_away`` for every team seen in either role."""
    return strengths_from_totals(role_totals(matches), params)


def home_away_totals(matches: DataFrame) -> DataFrame:
    """J3 view: per team, both role aggregates side by side (non-null teams)."""
    return named(role_totals(matches))
