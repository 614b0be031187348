"""Micro fixtures, one per semantic trap (FIXTURES.md §2), checked against
small pure-Python computations of the documented rules."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchside.functions.numeric import rnd, to_number
from pitchside.functions.text import canonical_team, py_strip
from pitchside.operators import enrich, impact, players, quality, strength, style, upsert, xg
from pitchside.params import Params

M_SCHEMA = "home_team_name string, away_team_name string, home_score string, away_score string, time_utc timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def matches(spark, rows):
    return spark.createDataFrame([(*r, T0) for r in rows], M_SCHEMA)


def by_team(df, key="team"):
    return {r[key]: r.asDict() for r in df.collect()}


def py_strengths(rows, floor=0.1):
    """The documented ratio rules, computed naively in Python."""
    ok = []
    for h, a, hs, as_ in rows:
        try:
            hs, as_ = float(hs), float(as_)
        except (TypeError, ValueError):
            continue
        if math.isnan(hs) or math.isnan(as_):
            continue
        ok.append((h, a, hs, as_))
    n = len(ok)
    ah = sum(r[2] for r in ok) / n
    aa = sum(r[3] for r in ok) / n
    at = (ah + aa) / 2
    out = {}
    for t in {r[0] for r in ok} | {r[1] for r in ok}:
        if t is None:
            continue
        H = [r for r in ok if r[0] == t]
        A = [r for r in ok if r[1] == t]
        sc = sum(r[2] for r in H) + sum(r[3] for r in A)
        co = sum(r[3] for r in H) + sum(r[2] for r in A)
        m = len(H) + len(A)
        d = lambda x, y: x / y if y else (math.nan if x == 0 else math.inf)
        mx = lambda v: v if math.isnan(v) else max(v, floor)
        out[t] = {
            "attack": mx(d(sc / m, at)), "defense": mx(d(co / m, at)),
            "attack_home": mx(d(sum(r[2] for r in H) / len(H), ah)) if H else 1.0,
            "defense_home": mx(d(sum(r[3] for r in H) / len(H), aa)) if H else 1.0,
            "attack_away": mx(d(sum(r[3] for r in A) / len(A), aa)) if A else 1.0,
            "defense_away": mx(d(sum(r[2] for r in A) / len(A), ah)) if A else 1.0,
        }
    return out


def close(a, b):
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == pytest.approx(b, abs=1e-4)


# --------------------------------------------------------------- strengths

def test_one_role_teams_default_to_one(spark):
    rows = [("A", "B", "2", "1"), ("A", "C", "1", "1"), ("C", "B", "0", "3")]
    got = by_team(strength.team_strengths(matches(spark, rows)))
    assert got["A"]["attack_away"] == 1.0 and got["A"]["defense_away"] == 1.0
    assert got["B"]["attack_home"] == 1.0 and got["B"]["defense_home"] == 1.0
    exp = py_strengths(rows)
    for t in exp:
        for k in exp[t]:
            assert close(got[t][k], exp[t][k]), (t, k)


def test_null_team_counts_in_averages_but_is_no_group(spark):
    rows = [(None, "B", "4", "0"), ("A", "B", "1", "1"), ("B", "A", "2", "0")]
    df = strength.team_strengths(matches(spark, rows))
    got = by_team(df)
    assert set(got) == {"A", "B"}
    exp = py_strengths(rows)
    for t in exp:
        for k in exp[t]:
            assert close(got[t][k], exp[t][k])
    la = strength.league_averages(matches(spark, rows)).first()
    assert la["n_matches"] == 3 and la["league_avg_home_goals"] == pytest.approx(7 / 3, abs=1e-6)


def test_bad_scores_are_dropped_or_parsed(spark):
    rows = [("A", "B", "x", "1"), ("A", "B", "", "1"), ("A", "B", "1d", "1"), ("A", "B", "1d ", "1"), ("A", "B", "1", "2f\t"),
            ("A", "B", " 2 ", "1"), ("B", "A", "1e3", "0"), ("B", "A", "1", "1")]
    la = strength.league_averages(matches(spark, rows)).first()
    assert la["n_matches"] == 3
    assert la["league_avg_home_goals"] == pytest.approx((2 + 1000 + 1) / 3, abs=1e-6)
    got, exp = by_team(strength.team_strengths(matches(spark, rows))), py_strengths(rows)
    assert all(close(got[t][k], exp[t][k]) for t in exp for k in exp[t])


def test_zero_league_gives_nan_and_floor_applies(spark):
    got = by_team(strength.team_strengths(matches(spark, [("A", "B", "0", "0")] * 3)))
    assert math.isnan(got["A"]["attack"]) and math.isnan(got["B"]["defense_away"])
    got = by_team(strength.team_strengths(matches(spark, [("A", "B", "0", "3"), ("B", "A", "2", "0")])))
    assert got["A"]["attack"] == 0.1 and got["A"]["attack_home"] == 0.1


def test_random_leagues_match_python(spark):
    rnd_ = random.Random(7)
    teams = ["T%d" % i for i in range(6)]
    rows = [(rnd_.choice(teams), rnd_.choice(teams), str(rnd_.randint(0, 4)), str(rnd_.randint(0, 3)))
            for _ in range(300)]
    df = matches(spark, rows).repartition(5)
    got = by_team(strength.team_strengths(df))
    exp = py_strengths(rows)
    assert set(got) == set(exp)
    for t in exp:
        for k in exp[t]:
            assert close(got[t][k], exp[t][k]), (t, k)
            assert got[t][k] >= 0.1


def test_unpivot_properties(spark):
    from pitchside.operators.reshape import two_role_rows

    rows = [("A", "B", "2", "1"), ("C", "A", "0", "3"), ("B", "C", "1", "1")]
    m = strength.coerce_scores(matches(spark, rows))
    u = two_role_rows(m, "home_team_name", "away_team_name", "home_score", "away_score")
    assert u.count() == 2 * m.count()
    s = u.agg(F.sum("value_for").alias("f"), F.sum("value_against").alias("a")).first()
    assert s["f"] == s["a"]


# ---------------------------------------------------------------------- xG

XG_SCHEMA = "event_id string, xg_home double, xg_away double, home_team_name string, away_team_name string"


def test_xg_gate_one_sided_and_unknown_team(spark):
    rows = [(str(i), 1.0, 0.5, "A", "Z") for i in range(10)]       # A: 10 home rows only
    rows += [(f"b{i}", 2.0, 1.0, "B", "Z") for i in range(9)]      # B: 9 rows -> gated out
    rows += [("u", 3.0, 3.0, "Q", "Z")]                              # Q untrained: in the mean only
    trained = spark.createDataFrame([("A",), ("B",), ("C",)], "team string")
    got = by_team(xg.xg_strengths(spark.createDataFrame(rows, XG_SCHEMA), trained))
    mean_h = (10 * 1.0 + 9 * 2.0 + 3.0) / 20
    mean_a = (10 * 0.5 + 9 * 1.0 + 3.0) / 20
    assert got["A"]["xg_matches"] == 10
    assert got["A"]["xg_attack_home"] == pytest.approx(round(1.0 / mean_h, 4))
    assert got["A"]["xg_defense_home"] == pytest.approx(round(0.5 / mean_a, 4))
    assert got["A"]["xg_attack_away"] == 1.0 and got["A"]["xg_defense_away"] == 1.0
    assert got["B"]["xg_matches"] is None and got["B"]["xg_attack_home"] is None
    assert got["C"]["xg_matches"] is None
    assert set(got) == {"A", "B", "C"}


# ----------------------------------------------------------------- players

P_COLS = ["Player", "Pos", "Squad", "Comp", "nineties", "Gls", "Ast", "xG", "xAG", "KP", "PrgP",
          "TklW", "Int", "tkl_int", "Blocks", "Clr", "ordinal"]


def player_rows(spark, rows, cols=P_COLS):
    return spark.createDataFrame(rows, cols)


def test_missing_columns_use_basic_defence_and_thresholds(spark):
    cols = ["Player", "Pos", "Squad", "Comp", "nineties", "Gls", "Ast", "xG", "xAG", "KP", "PrgP",
            "TklW", "Int", "ordinal"]
    rows = [("p1", "DF", "X", "eng Premier League", 0.99, 9.0, 0.0, 0.0, 0.0, 0.0, 0.0, 9.0, 9.0, 1),
            ("p2", "DF", "X", "eng Premier League", 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0, 1.0, 2),
            ("p3", "DF", "X", "eng Premier League", 5.0, 3.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0, 3),
            ("p4", "DF", "X", "es La Liga", 5.0, 3.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0, 4)]
    got = by_team(players.player_strength_index(spark.createDataFrame(rows, cols)))
    x = got["X"]
    w = np.array([1.0, 5.0]) / 6.0
    assert x["attack_index"] == pytest.approx(round(float(w @ [1.0, 3.0]), 4))
    assert x["defensive_index"] == pytest.approx(round(float(w @ [3.0, 2.0]), 4))
    assert x["squad_depth"] == 1


def test_alias_collision_last_raw_name_wins_index_but_impact_merges(spark):
    base = dict(Pos="FW", Comp="eng Premier League", xG=0.0, xAG=0.0, KP="0", PrgP=0.0, TklW=0.0,
                Int=0.0, tkl_int=0.0, Blocks=0.0, Clr=0.0)
    rows = []
    for i, (squad, gls) in enumerate([("Manchester United", 1.0), ("Manchester Utd", 4.0)]):
        d = dict(base, Player=f"p{i}", Squad=squad, nineties=4.0, Gls=gls, Ast=0.0, ordinal=i)
        rows.append(tuple(d[c] for c in P_COLS))
    df = player_rows(spark, rows)
    idx = by_team(players.player_strength_index(df))
    assert set(idx) == {"Man Utd"} and idx["Man Utd"]["attack_index"] == 4.0
    imp = impact.player_impact(df, Params(snapshot_date="2026-01-05")).collect()
    assert sorted(r["player_name"] for r in imp) == ["p0", "p1"]
    assert max(r["impact_score"] for r in imp) == 10.0


def test_ties_at_rank_ten_keep_file_order(spark):
    base = dict(Pos="MF", Squad="Arsenal", Comp="eng Premier League", xG=0.0, xAG=0.0, KP="0",
                PrgP=0.0, TklW=0.0, Int=0.0, tkl_int=0.0, Blocks=0.0, Clr=0.0)
    rows = [tuple(dict(base, Player="star", nineties=3.0, Gls=20.0, Ast=0.0, ordinal=0)[c] for c in P_COLS)]
    for i in range(1, 13):                       # 12 equal players compete for ranks 2..10
        rows.append(tuple(dict(base, Player=f"p{i:02d}", nineties=3.0, Gls=5.0, Ast=0.0,
                               ordinal=100 - i)[c] for c in P_COLS))
    out = impact.player_impact(player_rows(spark, rows).repartition(4),
                               Params(snapshot_date="2026-01-05"))
    names = [r["player_name"] for r in out.orderBy("rank").collect()]
    assert len(names) == 10 and names[0] == "star"
    assert names[1:] == [f"p{i:02d}" for i in range(12, 3, -1)]   # smallest ordinal first


# ------------------------------------------------------------- names, text

def test_strip_and_canonical_names(spark):
    raw = ["  Spurs\t", " Manchester City ", "\x1cLeeds United\x1f", "Brighton", "brighton",
           "Nott'm Forest", "unknown FC ", None]
    df = spark.createDataFrame([(r,) for r in raw], "s string")
    got = [r[0] for r in df.select(canonical_team("s")).collect()]
    from pitchside.params import TEAM_ALIASES

    exp = [None if r is None else TEAM_ALIASES.get(r.strip().lower(), r.strip()) for r in raw]
    assert got == exp
    assert [r[0] for r in df.select(py_strip("s")).collect()] == [None if r is None else r.strip() for r in raw]


def test_number_parsing_rules(spark):
    texts = ["1", " 2 ", "1e3", "1d", "2F", "x", "", "inf", "-inf", "nan", "3.5", None, "1d ", "2f\t", "3D  ", " inf "]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(to_number("s")).collect()]
    exp = [1.0, 2.0, 1000.0, None, None, None, None, math.inf, -math.inf, math.nan, 3.5, None, None, None, None, math.inf]
    for g, e in zip(got, exp):
        assert (g is None and e is None) or (isinstance(e, float) and math.isnan(e) and math.isnan(g)) or g == e


def test_rounding_matches_numpy(spark):
    rng = np.random.default_rng(1)
    vals = list(rng.integers(0, 10**6, 500) / 2**rng.integers(1, 12, 500)) + [0.00005, 1.23455, 2.5e-5]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = [r[0] for r in df.select(rnd("x", 4)).collect()]
    assert got == [float(np.round(v, 4)) for v in vals]


# -------------------------------------------------------------- enrichment

def test_fallback_join_on_canonical_name(spark):
    s = spark.createDataFrame([("Spurs", 1.0), ("Arsenal", 1.2), ("Leeds", 0.9)], "team string, attack double")
    f = spark.createDataFrame([("Tottenham", 1.5, 2.0, 3.0, 4), ("Arsenal", 0.5, 0.6, 0.7, 2)],
                              "team string, attack_index double, creation_index double, defensive_index double, squad_depth int")
    got = by_team(enrich.enrich_strengths(s, f))
    assert got["Spurs"]["attack_index"] == 1.5 and got["Arsenal"]["squad_depth"] == 2
    assert got["Leeds"]["attack_index"] is None
    assert enrich.enriched_count(enrich.enrich_strengths(s, f)).first()[0] == 2


# ------------------------------------------------------------------- style

def test_style_literals_and_rates(spark):
    rows = [("{'home_team_name': \"Nott'm Forest\", 'g': None}", "{'away_team_name': 'Spurs'}", "2", "0"),
            ("Arsenal", "{'away_team_name': 'Tottenham Hotspur', 'x': True}", "1", "1"),
            ("{'x': 1}", "Arsenal", "1", "0"),                  # key absent -> dropped
            ("Arsenal", "Spurs", "nan", "0")]                   # NaN score -> dropped
    df = spark.createDataFrame(rows, "home_team string, away_team string, home_score string, away_score string")
    got = by_team(style.team_style(df), "team_name")
    assert set(got) == {"Nott'm Forest", "Tottenham", "Arsenal"}
    t = got["Tottenham"]
    assert t["matches_count"] == 2 and t["avg_goals_scored"] == 0.5 and t["avg_goals_conceded"] == 1.5
    assert t["clean_sheet_rate"] == 0.0 and t["btts_rate"] == 0.5 and t["avg_goal_diff"] == -1.0


# ------------------------------------------------------------------ upsert

def test_upsert_rerun_is_idempotent_and_keeps_absent_keys(spark):
    stored = spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "k string, v int, ordinal int")
    batch = spark.createDataFrame([("a", 10, 1), ("a", 11, 2), ("c", 3, 1)], "k string, v int, ordinal int")
    once = upsert.upsert(stored, batch, ["k"], ["ordinal"])
    twice = upsert.upsert(once, batch, ["k"], ["ordinal"])
    as_set = lambda d: sorted(tuple(r) for r in d.select("k", "v").collect())
    assert as_set(once) == [("a", 11), ("b", 2), ("c", 3)]
    assert as_set(twice) == as_set(once)


def test_upsert_null_keys_and_schema_drift(spark):
    stored = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    out = upsert.upsert(stored, spark.createDataFrame([(None, 5)], "k string, v int"), ["k"])
    assert sorted((r["k"] or "", r["v"]) for r in out.collect()) == [("", 5), ("a", 2)]
    with pytest.raises(upsert.SchemaDrift):
        upsert.upsert(stored, spark.createDataFrame([("a", 1)], "k string, w int"), ["k"])


def test_stored_rows_are_not_sorted(spark):
    stored = spark.range(100).selectExpr("id AS k", "id AS v")
    plan = upsert.upsert(stored, stored, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Window" not in plan


def test_top_k_is_limited_before_the_exchange_on_team(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [tuple(dict(zip(P_COLS, ["p", "MF", "Arsenal", "Premier League", 5.0, float(i % 90), 0.0, 0.0, 0.0, "0", 0.0, 0.0, 0.0, 0.0,
                                        0.0, 0.0, i]))[c] for c in P_COLS) for i in range(500)]
        out = impact.player_impact(player_rows(spark, rows), Params(snapshot_date="2026-01-05"))
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        final = plan.index("hashpartitioning(team_name")
        assert "WindowGroupLimit [team_name" in plan and plan.count("WindowGroupLimit") >= 3 and final > 0
        assert [r["goals"] for r in out.orderBy("rank").collect()] == [89] * 5 + [88] * 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_absent_player_and_position_columns_are_empty_text(spark):
    rows = [("Arsenal", "Premier League", 5.0, 3.0, 1.0, 1)]
    df = spark.createDataFrame(rows, ["Squad", "Comp", "nineties", "Gls", "Ast", "ordinal"])
    r = impact.player_impact(df, Params(snapshot_date="2026-01-05")).first()
    assert r["player_name"] == "" and r["position"] == ""


# -------------------------------------------------------------------- gate

def test_row_gate_99_fails_100_passes(spark):
    df99 = spark.range(99)
    assert quality.row_gate(df99, 100).first()["passed"] is False
    with pytest.raises(quality.GateError):
        quality.require_rows(99, 100)
    assert quality.require_rows(100, 100) == 100
