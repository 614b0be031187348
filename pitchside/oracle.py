"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each statement is written from the documented semantics, directly against the
driver's tables (``lineitem``, ``orders``, ... pre-registered as views), and
does not reuse any Spark code.  Only fixture label lists and the alias table
are rendered in from Python, as VALUES / list literals.

Rounding is ``round_even(x * 10^d, 0) / 10^d``, which equals the library's
``rint`` form bit for bit.
"""

from __future__ import annotations

from pitchside.params import (
    CARD_ALGORITHM, CARD_FEATURES, CARD_LEAGUE, CARD_MODEL_NAME, CARD_TRAINING_SOURCE,
    CARD_VERSION, FIXED_DATE, FIXED_TS, PANDAS_NA_TOKENS, TEAM_ALIASES,
)
from pitchside.functions.text import PY_WHITESPACE
from pitchside.sources.fixtures import (
    COMPETITIONS, POSITIONS, SQUAD_LABELS, TEAM_LABELS, UPSERT_SPLIT, XG_PRICE,
)


def q(s: str) -> str:
    """SQL string literal; control characters spliced in with chr()."""
    parts, buf = [], ""
    for ch in s:
        if ord(ch) < 32:
            if buf:
                parts.append("'" + buf.replace("'", "''") + "'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not parts:
        parts.append("'" + buf.replace("'", "''") + "'")
    return parts[0] if len(parts) == 1 else "(" + " || ".join(parts) + ")"


def _list(values) -> str:
    return "list_value(" + ", ".join(q(v) for v in values) + ")"


ALIASES = ("aliases(alias_key, canonical) AS (VALUES "
           + ", ".join(f"({q(k)}, {q(v)})" for k, v in TEAM_ALIASES.items()) + ")")
COMPS = ("comps(p_type, comp) AS (VALUES "
         + ", ".join(f"({q(k)}, {q(v)})" for k, v in COMPETITIONS.items()) + ")")

# Python str.strip() white space, as a trim character set.
_WS = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)


def canon(expr: str) -> str:
    """Canonical team name of ``expr`` (needs the ``aliases`` CTE)."""
    return (f"coalesce((SELECT canonical FROM aliases WHERE alias_key = lower(trim({expr}, {_WS}))),"
            f" trim({expr}, {_WS}))")


def R(expr: str, d: int) -> str:
    return f"(round_even(({expr}) * 1e{d}, 0) / 1e{d})"


TEAMS = f"""teams_fx AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id,
         coalesce({_list(TEAM_LABELS)}[n_nationkey + 1], n_name) AS name
  FROM nation)"""

LINES = """lines_fx AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   strftime(l_shipdate, '%Y%m%d'), CAST(l_quantity AS BIGINT)) AS event_id,
         CAST(s_nationkey AS BIGINT) AS home_team_id,
         CAST(c_nationkey AS BIGINT) AS away_team_id,
         CAST(CAST(trunc(l_quantity) AS BIGINT) % 5 AS DOUBLE) AS home_score,
         CAST(l_linenumber % 4 AS DOUBLE) AS away_score,
         o_orderdate AS time_utc,
         CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'P' THEN 1 ELSE 0 END AS time_status,
         l_partkey, l_linenumber
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey)"""

FINISHED = """fin AS (
  SELECT e.event_id, ht.name AS home_team_name, awt.name AS away_team_name,
         e.home_score, e.away_score, e.time_utc
  FROM lines_fx e
  JOIN teams_fx ht ON ht.id = e.home_team_id
  JOIN teams_fx awt ON awt.id = e.away_team_id
  WHERE e.time_status = 3 AND e.home_score IS NOT NULL AND e.away_score IS NOT NULL)"""

BASE = f"WITH {TEAMS},\n{LINES},\n{FINISHED}"

# Per-team role aggregates, as two grouped frames aligned by a full outer join.
ROLE_FRAMES = """lg AS (SELECT avg(home_score) AS avg_home, avg(away_score) AS avg_away,
                  count(*) AS n FROM fin),
hs AS (SELECT home_team_name AS team, sum(home_score) AS gs, sum(away_score) AS gc,
              count(*) AS n FROM fin WHERE home_team_name IS NOT NULL GROUP BY 1),
aw AS (SELECT away_team_name AS team, sum(away_score) AS gs, sum(home_score) AS gc,
              count(*) AS n FROM fin WHERE away_team_name IS NOT NULL GROUP BY 1),
tot AS (SELECT coalesce(hs.team, aw.team) AS team,
               hs.gs AS hgs, hs.gc AS hgc, coalesce(hs.n, 0) AS hn,
               aw.gs AS ags, aw.gc AS agc, coalesce(aw.n, 0) AS an
        FROM hs FULL OUTER JOIN aw ON hs.team = aw.team)"""

_F = "CAST(0.1 AS DOUBLE)"


def _strength_select() -> str:
    tot_avg = "((lg.avg_home + lg.avg_away) / 2)"
    pooled = lambda a, b: (
        f"CASE WHEN hn + an = 0 THEN 1.0::DOUBLE ELSE "
        f"{R(f'greatest(((coalesce({a}, 0) + coalesce({b}, 0)) / (hn + an)) / {tot_avg}, {_F})', 4)} END")
    role = lambda g, n, avg: (
        f"CASE WHEN {n} > 0 THEN {R(f'greatest(({g} / {n}) / {avg}, {_F})', 4)} ELSE 1.0::DOUBLE END")
    return f"""SELECT team,
       {pooled('hgs', 'ags')} AS attack,
       {pooled('hgc', 'agc')} AS defense,
       {role('hgs', 'hn', 'lg.avg_home')} AS attack_home,
       {role('ags', 'an', 'lg.avg_away')} AS attack_away,
       {role('hgc', 'hn', 'lg.avg_away')} AS defense_home,
       {role('agc', 'an', 'lg.avg_home')} AS defense_away
FROM tot, lg"""


STRENGTHS_CTE = f"strengths AS ({_strength_select()})"

XG_ROWS = f"""xgr AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   strftime(l_shipdate, '%Y%m%d'), CAST(l_quantity AS BIGINT)) AS event_id,
         l_discount * 10 AS xg_home, l_tax * 10 AS xg_away
  FROM lineitem WHERE l_extendedprice > {XG_PRICE}),
xgm AS (
  SELECT x.event_id, x.xg_home, x.xg_away, ht.name AS home_team_name, awt.name AS away_team_name
  FROM xgr x JOIN lines_fx e ON e.event_id = x.event_id
  JOIN teams_fx ht ON ht.id = e.home_team_id
  JOIN teams_fx awt ON awt.id = e.away_team_id
  WHERE e.time_status = 3)"""

XG_STRENGTHS_CTE = f"""xlg AS (SELECT avg(xg_home) AS xh, avg(xg_away) AS xa FROM xgm),
xh AS (SELECT home_team_name AS team, count(*) AS n, avg(xg_home) AS f, avg(xg_away) AS a
       FROM xgm GROUP BY 1),
xa AS (SELECT away_team_name AS team, count(*) AS n, avg(xg_away) AS f, avg(xg_home) AS a
       FROM xgm GROUP BY 1),
xgs AS (
  SELECT s.team,
         coalesce(xh.n, 0) + coalesce(xa.n, 0) AS n_xg,
         CASE WHEN xh.n > 0 THEN {R(f'greatest(xh.f / xlg.xh, {_F})', 4)} ELSE 1.0::DOUBLE END AS atk_h,
         CASE WHEN xh.n > 0 THEN {R(f'greatest(xh.a / xlg.xa, {_F})', 4)} ELSE 1.0::DOUBLE END AS def_h,
         CASE WHEN xa.n > 0 THEN {R(f'greatest(xa.f / xlg.xa, {_F})', 4)} ELSE 1.0::DOUBLE END AS atk_a,
         CASE WHEN xa.n > 0 THEN {R(f'greatest(xa.a / xlg.xh, {_F})', 4)} ELSE 1.0::DOUBLE END AS def_a
  FROM strengths s CROSS JOIN xlg
  LEFT JOIN xh ON xh.team = s.team LEFT JOIN xa ON xa.team = s.team),
xgout AS (
  SELECT team,
         CASE WHEN n_xg >= 10 THEN atk_h END AS xg_attack_home,
         CASE WHEN n_xg >= 10 THEN def_h END AS xg_defense_home,
         CASE WHEN n_xg >= 10 THEN atk_a END AS xg_attack_away,
         CASE WHEN n_xg >= 10 THEN def_a END AS xg_defense_away,
         CASE WHEN n_xg >= 10 THEN CAST(n_xg AS BIGINT) END AS xg_matches
  FROM xgs)"""

PLAYERS = f"""{COMPS},
pl AS (
  SELECT p_name || ' #' || CAST(p_partkey AS VARCHAR) AS player,
         {_list(POSITIONS)}[p_size % 4 + 1] AS pos,
         coalesce({_list(SQUAD_LABELS)}[TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER)], p_brand) AS squad,
         coalesce(comps.comp, part.p_type) AS comp,
         p_size / CAST(10 AS DOUBLE) AS nineties,
         CAST(p_partkey % 7 AS DOUBLE) AS gls,
         CAST(p_partkey % 5 AS DOUBLE) AS ast,
         (p_partkey % 11) / CAST(2 AS DOUBLE) AS xg,
         (p_partkey % 13) / CAST(4 AS DOUBLE) AS xag,
         coalesce(TRY_CAST(CASE WHEN p_partkey % 97 = 0 THEN 'n/a'
                                ELSE CAST(p_partkey % 17 AS VARCHAR) END AS DOUBLE), 0) AS kp,
         CAST(p_partkey % 19 AS DOUBLE) AS prgp,
         CAST(p_partkey % 6 AS DOUBLE) AS tklw,
         CAST(p_partkey % 4 AS DOUBLE) AS intc,
         CASE WHEN TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) % 5 = 0 THEN 0.0::DOUBLE
              ELSE CAST(p_partkey % 9 AS DOUBLE) END AS tkl_int,
         CAST(p_partkey % 3 AS DOUBLE) AS blocks,
         CAST(p_partkey % 8 AS DOUBLE) AS clr,
         p_partkey AS ordinal
  FROM part LEFT JOIN comps ON comps.p_type = part.p_type)"""

# Per raw squad, weights = 90s / squad total, as the modelled job computes them.
SQUAD_IDX = f"""pe AS (SELECT *, nineties / sum(nineties) OVER (PARTITION BY squad) AS w
       FROM pl WHERE contains(comp, 'Premier League') AND nineties >= 1.0 AND squad IS NOT NULL),
sq AS (
  SELECT squad,
         {R('sum(w * (gls + xg))', 4)} AS attack_index,
         {R('sum(w * (ast + xag + kp + prgp))', 4)} AS creation_index,
         CASE WHEN sum(tkl_int) > 0 THEN {R('sum(w * (tkl_int + blocks + clr))', 4)}
              ELSE {R('sum(w * (tklw + intc))', 4)} END AS defensive_index,
         CAST(count(*) FILTER (WHERE nineties >= 5) AS INTEGER) AS squad_depth
  FROM pe GROUP BY squad HAVING sum(nineties) >= 1.0),
sqc AS (SELECT {canon('squad')} AS team, * FROM sq),
feats AS (
  SELECT team, attack_index, creation_index, defensive_index, squad_depth FROM (
    SELECT *, row_number() OVER (PARTITION BY team ORDER BY squad DESC) AS rn FROM sqc)
  WHERE rn = 1)"""

ENRICHED = f"""enr AS (
  SELECT s.*,
         CASE WHEN fe.team IS NOT NULL THEN fe.attack_index ELSE fc.attack_index END AS attack_index,
         CASE WHEN fe.team IS NOT NULL THEN fe.creation_index ELSE fc.creation_index END AS creation_index,
         CASE WHEN fe.team IS NOT NULL THEN fe.defensive_index ELSE fc.defensive_index END AS defensive_index,
         CASE WHEN fe.team IS NOT NULL THEN fe.squad_depth ELSE fc.squad_depth END AS squad_depth
  FROM strengths s
  LEFT JOIN feats fe ON fe.team = s.team
  LEFT JOIN feats fc ON fc.team = {canon('s.team')})"""

IMPACT = f"""ip AS (
  SELECT *, {canon('squad')} AS team_name, gls + ast + nineties * CAST(0.1 AS DOUBLE) AS raw_impact
  FROM pl WHERE contains(comp, 'Premier League') AND nineties >= 3.0),
ipm AS (SELECT *, max(raw_impact) OVER (PARTITION BY team_name) AS mx FROM ip WHERE team_name IS NOT NULL),
ips AS (SELECT *, {R('raw_impact / mx * 10', 2)} AS impact_score FROM ipm WHERE mx > 0),
ipr AS (SELECT *, row_number() OVER (PARTITION BY team_name ORDER BY impact_score DESC, ordinal ASC) AS rk
        FROM ips),
impact AS (
  SELECT team_name, coalesce(player, '') AS player_name, coalesce(pos, '') AS position,
         {R('nineties', 2)} AS minutes_90s, CAST(trunc(gls) AS INTEGER) AS goals,
         CAST(trunc(ast) AS INTEGER) AS assists, impact_score, CAST(rk AS INTEGER) AS rank,
         DATE '{FIXED_DATE}' AS snapshot_date
  FROM ipr WHERE rk <= 10)"""


def _py_lit(key: str, name_expr: str, tail: str) -> str:
    """Python repr of ``{key: name, <tail>}`` built in SQL."""
    quote = f"CASE WHEN contains({name_expr}, '''') THEN '\"' ELSE '''' END"
    return (f"'{{''{key}'': ' || {quote} || {name_expr} || {quote} || '{tail}}}'")


SCORE_TEXT = """CASE WHEN e.l_partkey % 41 = 0 THEN 'x'
              WHEN e.l_partkey % 43 = 0 THEN ' ' || CAST(e.home_score AS VARCHAR) || ' '
              WHEN e.l_partkey % 47 = 0 THEN CAST(CAST(e.home_score AS INTEGER) AS VARCHAR) || 'd'
              WHEN e.l_partkey % 79 = 0 THEN CAST(CAST(e.home_score AS INTEGER) AS VARCHAR) || 'd '
              WHEN e.l_partkey % 83 = 0 THEN CAST(CAST(e.home_score AS INTEGER) AS VARCHAR) || 'f' || chr(9)
              WHEN e.l_partkey % 71 = 0 THEN 'nan'
              WHEN e.l_partkey % 73 = 0 THEN NULL
              WHEN e.l_partkey % 61 = 0 THEN CAST(CAST(e.home_score AS INTEGER) AS VARCHAR) || 'e0'
              ELSE CAST(e.home_score AS VARCHAR) END"""


def parse_num(t: str) -> str:
    """Text -> double or NULL; Java-style float suffixes rejected."""
    return (f"(CASE WHEN regexp_matches({t}, '(?i)[df]\\s*$') AND NOT regexp_matches({t}, '(?i)inf\\s*$')"
            f" THEN NULL ELSE TRY_CAST({t} AS DOUBLE) END)")


# Expected raw names per the literal rules, computed from how the cells are made.
STYLE = f"""sty AS (
  SELECT e.l_partkey, e.l_linenumber, ht.name AS hname, awt.name AS aname,
         {SCORE_TEXT} AS hs_txt,
         {parse_num(SCORE_TEXT)} AS hs,
         e.away_score AS as_,
         CASE WHEN e.l_linenumber = 1 THEN ht.name
              WHEN e.l_partkey % 53 = 0 THEN ''
              WHEN e.l_partkey % 59 = 0 THEN '{{''home_team_name'': None, ''g'': 1}}'
              ELSE ht.name END AS hraw,
         awt.name AS araw
  FROM lines_fx e JOIN teams_fx ht ON ht.id = e.home_team_id
  JOIN teams_fx awt ON awt.id = e.away_team_id),
styn AS (SELECT {canon('hraw')} AS home_name, {canon('araw')} AS away_name, hs, as_ FROM sty
         WHERE hs IS NOT NULL AND NOT isnan(hs) AND as_ IS NOT NULL),
styv AS (SELECT * FROM styn WHERE home_name <> '' AND away_name <> ''),
style AS (
  SELECT team AS team_name, CAST(count(*) AS BIGINT) AS matches_count,
         {R('avg(gf)', 4)} AS avg_goals_scored,
         {R('avg(ga)', 4)} AS avg_goals_conceded,
         {R('avg(CASE WHEN ga = 0 THEN 1.0 ELSE 0.0 END)', 4)} AS clean_sheet_rate,
         {R('avg(CASE WHEN gf > 0 AND ga > 0 THEN 1.0 ELSE 0.0 END)', 4)} AS btts_rate,
         {R('avg(gf) - avg(ga)', 4)} AS avg_goal_diff
  FROM (SELECT home_name AS team, hs AS gf, as_ AS ga FROM styv
        UNION ALL SELECT away_name, as_, hs FROM styv)
  GROUP BY team)"""

TS = FIXED_TS.strftime("%Y-%m-%d %H:%M:%S")


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["finished_matches"] = f"{BASE}\nSELECT * FROM fin"
    sql["league_averages"] = f"""{BASE},
{ROLE_FRAMES}
SELECT {R('avg_home', 6)} AS league_avg_home_goals, {R('avg_away', 6)} AS league_avg_away_goals,
       {R('avg_home + avg_away', 4)} AS total_goals_per_match, CAST(n AS BIGINT) AS n_matches
FROM lg"""
    sql["home_away_totals"] = f"""{BASE},
{ROLE_FRAMES}
SELECT team, hgs AS home_goals_scored, hgc AS home_goals_conceded, CAST(hn AS BIGINT) AS home_matches,
       ags AS away_goals_scored, agc AS away_goals_conceded, CAST(an AS BIGINT) AS away_matches
FROM tot"""
    sql["role_unpivot"] = f"""{BASE}
SELECT event_id, home_team_name AS team, true AS is_home, home_score AS goals_for, away_score AS goals_against FROM fin
UNION ALL
SELECT event_id, away_team_name, false, away_score, home_score FROM fin"""
    sql["team_strengths"] = f"{BASE},\n{ROLE_FRAMES}\n{_strength_select()}"
    sql["sorted_teams"] = f"""{BASE}
SELECT DISTINCT team FROM (SELECT home_team_name AS team FROM fin UNION ALL SELECT away_team_name FROM fin)
WHERE team IS NOT NULL ORDER BY team"""
    sql["row_gate"] = f"""{BASE}
SELECT CAST(count(*) AS BIGINT) AS n_matches, CAST(100 AS BIGINT) AS min_required,
       count(*) >= 100 AS passed FROM fin"""
    sql["xg_matches"] = f"{BASE},\n{XG_ROWS}\nSELECT * FROM xgm"
    sql["xg_strengths"] = f"""{BASE},
{ROLE_FRAMES},
{STRENGTHS_CTE},
{XG_ROWS},
{XG_STRENGTHS_CTE}
SELECT * FROM xgout"""
    sql["player_strength_index"] = f"""WITH {ALIASES},
{PLAYERS},
{SQUAD_IDX}
SELECT * FROM feats"""
    sql["last_wins_squads"] = f"""WITH {ALIASES},
{PLAYERS},
{SQUAD_IDX}
SELECT team, max(squad) AS winning_squad, CAST(count(*) AS BIGINT) AS raw_squads FROM sqc GROUP BY team"""
    sql["canonical_names"] = f"""WITH {ALIASES},
{PLAYERS}
SELECT squad, {canon('squad')} AS canonical, CAST(count(*) AS BIGINT) AS players
FROM pl GROUP BY squad"""
    sql["enriched_strengths"] = f"""{BASE},
{ROLE_FRAMES},
{STRENGTHS_CTE},
{ALIASES},
{PLAYERS},
{SQUAD_IDX},
{ENRICHED}
SELECT * FROM enr"""
    sql["player_impact_top10"] = f"""WITH {ALIASES},
{PLAYERS},
{IMPACT}
SELECT * FROM impact"""
    sql["team_style"] = f"""{BASE},
{ALIASES},
{STYLE}
SELECT * FROM style"""
    sql["literal_names"] = f"""{BASE},
{ALIASES},
{STYLE}
SELECT {canon('hraw')} AS home_name, {canon('araw')} AS away_name, CAST(count(*) AS BIGINT) AS rows
FROM sty GROUP BY ALL"""
    sql["numeric_coercion"] = f"""{BASE},
{ALIASES},
{STYLE}
SELECT hs_txt AS score_text, CASE WHEN NOT isnan(hs) THEN hs END AS parsed, coalesce(isnan(hs), false) AS is_nan,
       coalesce(CASE WHEN isnan(hs) THEN 0.0::DOUBLE ELSE hs END, 0.0::DOUBLE) AS filled,
       CAST(count(*) AS BIGINT) AS rows
FROM sty GROUP BY hs_txt, hs"""
    full = f"""{BASE},
{ROLE_FRAMES},
{STRENGTHS_CTE},
{XG_ROWS},
{XG_STRENGTHS_CTE},
{ALIASES},
{PLAYERS},
{SQUAD_IDX},
{ENRICHED},
fullt AS (SELECT enr.*, x.xg_attack_home, x.xg_defense_home, x.xg_attack_away,
                x.xg_defense_away, x.xg_matches
         FROM enr JOIN xgout x ON x.team = enr.team),
nenr AS (SELECT CAST(count(*) FILTER (WHERE attack_index IS NOT NULL) AS BIGINT) AS k FROM fullt)"""
    sql["full_training"] = f"{full}\nSELECT * FROM fullt"
    sql["league_params"] = f"""{full}
SELECT {R('avg_home', 6)} AS league_avg_home_goals, {R('avg_away', 6)} AS league_avg_away_goals,
       CAST(n AS BIGINT) AS n_matches, true AS fitted, TIMESTAMP '{TS}' AS trained_at,
       k > 0 AS kaggle_enriched, k AS kaggle_enriched_teams
FROM lg, nenr"""
    sql["model_card"] = f"""{full}
SELECT {q(CARD_MODEL_NAME)} AS model_name, {q(CARD_VERSION)} AS version,
       {q(CARD_ALGORITHM)} AS algorithm, {q(CARD_TRAINING_SOURCE)} AS training_source,
       CAST(n AS BIGINT) AS training_matches,
       (SELECT strftime(min(time_utc), '%Y-%m-%d') FROM fin) AS date_from,
       (SELECT strftime(max(time_utc), '%Y-%m-%d') FROM fin) AS date_to,
       {q(CARD_LEAGUE)} AS league,
       {R('avg_home', 4)} AS home_goals_per_match, {R('avg_away', 4)} AS away_goals_per_match,
       {R('avg_home + avg_away', 4)} AS total_goals_per_match,
       (SELECT CAST(count(*) AS BIGINT) FROM tot) AS teams_trained,
       k AS kaggle_enriched_teams, {q(",".join(CARD_FEATURES))} AS kaggle_features,
       TIMESTAMP '{TS}' AS trained_at
FROM lg, nenr"""
    sql["upsert_latest"] = f"""WITH u AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, 0 AS b FROM orders
  WHERE o_orderdate < TIMESTAMP '{UPSERT_SPLIT}'
  UNION ALL
  SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, 1 AS b FROM orders
  WHERE o_orderdate >= TIMESTAMP '{UPSERT_SPLIT}')
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY b DESC, o_orderkey DESC) AS rn FROM u)
WHERE rn = 1"""
    stamp = f"DATE '{FIXED_DATE}' AS snapshot_date, TIMESTAMP '{TS}' AS created_at"
    sql["snapshot_player_strength"] = f"""WITH {ALIASES},
{PLAYERS},
{SQUAD_IDX}
SELECT team AS team_name, '2025/2026' AS season, attack_index, creation_index, defensive_index,
       squad_depth, {stamp} FROM feats"""
    sql["snapshot_style"] = f"""{BASE},
{ALIASES},
{STYLE}
SELECT team_name, '2025/2026' AS season, matches_count, avg_goals_scored, avg_goals_conceded,
       clean_sheet_rate, btts_rate, avg_goal_diff, {stamp} FROM style"""
    sql["snapshot_impact"] = f"""WITH {ALIASES},
{PLAYERS},
{IMPACT},
ded AS (SELECT *, row_number() OVER (PARTITION BY team_name, player_name, snapshot_date
                                     ORDER BY rank DESC) AS rn FROM impact)
SELECT team_name, player_name, position, minutes_90s, goals, assists, impact_score, snapshot_date,
       TIMESTAMP '{TS}' AS created_at
FROM ded WHERE rn = 1"""
    early = "DATE '2026-01-01' AS snapshot_date, TIMESTAMP '" + TS + "' AS created_at"
    even = PLAYERS.replace("FROM part LEFT", "FROM (SELECT * FROM part WHERE p_partkey % 2 = 0) part LEFT")
    late = PLAYERS + ",\nplx AS (SELECT * FROM pl WHERE squad <> 'Arsenal')"
    feats = lambda pl, idx: f"(WITH {ALIASES},\n{pl},\n{idx}\nSELECT * FROM feats)"
    cols = "team AS team_name, '2025/2026' AS season, attack_index, creation_index, defensive_index, squad_depth"
    sql["snapshot_player_strength_merge"] = f"""WITH b AS (SELECT {cols}, {stamp} FROM {feats(late, SQUAD_IDX.replace("FROM pl ", "FROM plx "))}),
st AS (SELECT {cols}, {early} FROM {feats(even, SQUAD_IDX)})
SELECT * FROM b UNION ALL SELECT * FROM st WHERE team_name NOT IN (SELECT team_name FROM b)"""
    impact = lambda pl: f"(WITH {ALIASES},\n{pl},\n{IMPACT}\nSELECT * FROM impact)"
    history = "\nUNION ALL ".join(
        f"SELECT team_name, player_name, position, minutes_90s, goals, assists, impact_score, DATE '{day}' AS snapshot_date, rank FROM {impact(pl)}"
        for day, pl in (("2026-01-01", even), (FIXED_DATE, PLAYERS)))
    sql["impact_history"] = f"""SELECT * EXCLUDE (rank, rn), TIMESTAMP '{TS}' AS created_at FROM (
SELECT *, row_number() OVER (PARTITION BY team_name, player_name, snapshot_date ORDER BY rank DESC) AS rn FROM ({history})) WHERE rn = 1"""
    style_cols = """team_name, '2025/2026' AS season, matches_count, avg_goals_scored, avg_goals_conceded,
       clean_sheet_rate, btts_rate, avg_goal_diff"""
    some = STYLE.replace("FROM sty\n", "FROM (SELECT * FROM sty WHERE hraw NOT LIKE '%Arsenal%' AND araw NOT LIKE '%Arsenal%')\n")
    sql["snapshot_style_merge"] = f"""WITH b AS (SELECT {style_cols}, {stamp} FROM ({BASE},\n{ALIASES},\n{some}\nSELECT * FROM style)),
st AS (SELECT {style_cols}, {early} FROM ({BASE},\n{ALIASES},\n{STYLE}\nSELECT * FROM style))
SELECT * FROM b UNION ALL SELECT * FROM st WHERE team_name NOT IN (SELECT team_name FROM b)"""
    name = f"{_list(TEAM_LABELS)}[p_partkey % 25 + 1]"
    sql["literal_names_nested"] = f"""SELECT name, by_python, count(*)::BIGINT AS rows FROM (
SELECT CASE p_partkey % 7 WHEN 3 THEN 'Nott''m Forest' WHEN 5 THEN '' WHEN 6 THEN '{{''home_team_name'': [''a'', ''b'']}}' ELSE {name} END AS name,
       p_partkey % 7 IN (3, 4) AS by_python FROM part) GROUP BY ALL"""
    bare = PLAYERS
    for column in ("(p_partkey % 13) / CAST(4 AS DOUBLE) AS xag", "CAST(p_partkey % 3 AS DOUBLE) AS blocks", "CAST(p_partkey % 8 AS DOUBLE) AS clr"):
        bare = bare.replace(column, "0.0::DOUBLE AS " + column.split(" AS ")[-1])
    bare = bare.replace("ELSE CAST(p_partkey % 9 AS DOUBLE) END AS tkl_int", "ELSE 0.0::DOUBLE END AS tkl_int")
    sql["missing_columns"] = f"WITH {ALIASES},\n{bare},\n{SQUAD_IDX}\nSELECT * FROM feats"
    tokens = [*PANDAS_NA_TOKENS, "na", "none", " NA", "N/A ", "nil"]
    sql["na_tokens"] = f"""SELECT CASE WHEN NOT list_contains({_list(PANDAS_NA_TOKENS)}, c) THEN c END AS cell, count(*)::BIGINT AS rows FROM (
SELECT CASE WHEN p_partkey % 3 = 0 THEN {_list(tokens)}[p_partkey % {len(tokens)} + 1] ELSE p_brand END AS c FROM part) GROUP BY 1"""
    sql["ordered_matches"] = f"{BASE}\nSELECT event_id, time_utc FROM fin ORDER BY time_utc"
    text = lambda x: f"'\"' || {x} || '\"'"
    fields = [("model_name", text("model_name")), ("version", text("version")), ("algorithm", text("algorithm")),
              ("training_source", text("training_source")), ("training_matches", "training_matches"),
              ("date_range", f"'{{\"from\":' || {text('date_from')} || ',\"to\":' || {text('date_to')} || '}}'"), ("league", text("league")),
              ("league_averages", "'{\"home_goals_per_match\":' || home_goals_per_match || ',\"away_goals_per_match\":' || away_goals_per_match"
                                  " || ',\"total_goals_per_match\":' || total_goals_per_match || '}'"),
              ("teams_trained", "teams_trained"), ("kaggle_enriched_teams", "kaggle_enriched_teams"),
              ("kaggle_features", q("[" + ",".join(f'"{c}"' for c in CARD_FEATURES) + "]")),
              ("trained_at", q(f'"{FIXED_TS.strftime("%Y-%m-%dT%H:%M:%S")}.000"'))]
    body = " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in fields)
    sql["model_card_json"] = f"SELECT '{{' || {body} || '}}' AS model_card FROM ({sql['model_card']})"
    nothing = ", ".join(f"NULL::{t} AS {c}" for c, t in (
        ("xg_attack_home", "DOUBLE"), ("xg_defense_home", "DOUBLE"), ("xg_attack_away", "DOUBLE"), ("xg_defense_away", "DOUBLE"),
        ("xg_matches", "BIGINT"), ("attack_index", "DOUBLE"), ("creation_index", "DOUBLE"), ("defensive_index", "DOUBLE"), ("squad_depth", "INTEGER")))
    sql["plain_training"] = f"{BASE},\n{ROLE_FRAMES},\n{STRENGTHS_CTE}\nSELECT strengths.*, {nothing} FROM strengths"
    eligible = "SELECT count(*)::BIGINT FROM pl WHERE contains(comp, 'Premier League') AND nineties >="
    sql["stage_counts"] = f"""{BASE},
{ALIASES},
{PLAYERS}
SELECT 'matches' AS stage, count(*)::BIGINT AS rows FROM fin
UNION ALL SELECT 'xg', count(*)::BIGINT FROM lineitem WHERE l_extendedprice > {XG_PRICE}
UNION ALL SELECT 'players', ({eligible} 1.0)
UNION ALL SELECT 'impact_players', ({eligible} 3.0)
UNION ALL SELECT 'style', count(*)::BIGINT FROM lines_fx
UNION ALL SELECT 'residual_literals', 0::BIGINT"""
    key = "('0x' || substr(md5(event_id), 1, 6))::INTEGER"
    sql["null_names"] = f"""{BASE},
fin2 AS (SELECT * REPLACE (CASE WHEN {key} % 11 <> 0 THEN home_team_name END AS home_team_name)
         FROM fin WHERE {key} % 13 <> 0),
{ROLE_FRAMES.replace("FROM fin", "FROM fin2")},
{STRENGTHS_CTE}
SELECT * FROM strengths"""
    sql["alias_table"] = """WITH dim AS (SELECT p_brand, min(p_type) AS to_ FROM part WHERE p_brand >= 'Brand#3' GROUP BY p_brand)
SELECT coalesce(d.to_, upper(p.p_brand)) AS canonical, count(*)::BIGINT AS rows FROM part p LEFT JOIN dim d USING (p_brand) GROUP BY 1"""
    sql["unknown_names"] = """SELECT upper(p_brand) AS name, count(*)::BIGINT AS rows FROM part
WHERE p_brand >= 'Brand#2' AND p_brand < 'Brand#3' GROUP BY 1"""
    return sql


ORACLE_SQL = build()
