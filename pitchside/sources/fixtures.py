"""Fixture adapters: the driver's TPC-H-style tables seen as the match data model.

The modelled job reads a match fact (``events``), a team dimension
(``teams``), a long metric table (``match_stats``), a player-season file and a
style-match file.  The adapters below derive each of them from the given
parquet tables with plain projections and joins, so every query's work grows
with the input:

* V1 matches: one match per line item.  home team = supplier nation, away team
  = customer nation, ``home_score = int(l_quantity) % 5``,
  ``away_score = l_linenumber % 4``, ended when the order status is ``F``,
  kick-off = order date.  The match id is the line's natural key rendered as
  text (``(l_orderkey, l_linenumber)`` alone is not unique in these tables).
* teams: nation key -> a club label (below), so alias lookups, name
  collisions and the fallback join all occur in real data.
* V2 metrics: ``xg`` rows for lines priced above 103,500 (``l_discount*10``,
  ``l_tax*10``), ``shots`` rows for the rest.
* V3 players: one player-season per part.  squad from the brand, competition
  from the type, ``90s = p_size / 10``, measures from ``p_partkey`` moduli.
* V4 style matches: V1 rendered as dict-literal / bare-name cells.
* V5 upsert: orders split at a date into a stored table and a new batch.

The label lists are fixture design, not modelled values.  The same lists are
rendered into the DuckDB oracle SQL by :mod:`pitchside.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.functions import sqltext as S
from pitchside.params import PANDAS_NA_TOKENS, STATUS_ENDED, XG_METRIC

# Fixture labels: club name per nation key 0..24 (teams as stored in the match
# database, mostly canonical; "Spurs" is deliberately not).
TEAM_LABELS = [
    "Arsenal", "Aston Villa", "Bournemouth", "Brentford", "Brighton",
    "Chelsea", "Crystal Palace", "Everton", "Fulham", "Ipswich",
    "Leicester", "Liverpool", "Man City", "Man Utd", "Newcastle",
    "Nott'm Forest", "Southampton", "Spurs", "West Ham", "Wolves",
    "Luton", "Burnley", "Sheffield Utd", "Leeds", "Sunderland",
]
# Fixture labels: raw player-file squad per brand number 1..25.
SQUAD_LABELS = [
    "Arsenal", "Aston Villa", "Bournemouth", "Brentford", "Brighton and Hove Albion",
    "Chelsea", "Crystal Palace", "Everton", "Fulham", "Ipswich Town",
    "Leicester City", "Liverpool", "Manchester City", "Manchester Utd", "Manchester United",
    "Newcastle Utd", "Nottingham Forest", "Tottenham Hotspur", "West Ham",
    "Wolverhampton Wanderers", "Luton Town", "Burnley", "\tSheffield United ",
    "Leeds United", "Southampton",
]
# Fixture labels: competition per part type (one lower-case on purpose).
COMPETITIONS = {
    "ECONOMY": "eng Premier League",
    "STANDARD": "eng Premier League",
    "MEDIUM": "eng Premier League",
    "SMALL": "eng Premier League",
    "LARGE": "es La Liga",
    "PROMO": "eng premier league",
}
POSITIONS = ["GK", "DF", "MF", "FW"]
XG_PRICE = 103500.0
UPSERT_SPLIT = "1999-01-01"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_EVENT_ID = ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
             "date_format(l_shipdate, 'yyyyMMdd'), CAST(l_quantity AS BIGINT))")


def match_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their match id, both team ids, scores and status."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate",
    )
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    cust = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # orders x customer first: it is a quarter of the line count
    order_side = orders.join(cust, orders.o_custkey == cust.c_custkey)
    lines = li.join(order_side, li.l_orderkey == order_side.o_orderkey).join(supp, li.l_suppkey == supp.s_suppkey)
    return lines.selectExpr(
        f"{_EVENT_ID} AS event_id",
        "CAST(s_nationkey AS BIGINT) AS home_team_id",
        "CAST(c_nationkey AS BIGINT) AS away_team_id",
        "CAST(CAST(l_quantity AS INT) % 5 AS DOUBLE) AS home_score",
        "CAST(l_linenumber % 4 AS DOUBLE) AS away_score",
        "o_orderdate AS time_utc",
        f"IF(o_orderstatus <=> 'F', {STATUS_ENDED}, 0) AS time_status",
        "l_partkey", "l_linenumber",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 match fact: ``id, home_team_id, away_team_id, home_score, away_score,
    time_utc, time_status``."""
    return match_lines(spark, sf_dir).selectExpr(
        "event_id AS id", "home_team_id", "away_team_id",
        "home_score", "away_score", "time_utc", "time_status",
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team dimension ``id, name`` from nation."""
    return _read(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS id",
        f"coalesce(try_element_at({S.array_of(TEAM_LABELS)}, n_nationkey + 1), n_name) AS name",
    )


def match_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 long metric table ``event_id, metric, home_value, away_value``."""
    is_xg = f"l_extendedprice > {XG_PRICE!r}D"
    return _read(spark, sf_dir, "lineitem").selectExpr(
        f"{_EVENT_ID} AS event_id",
        f"CASE WHEN {is_xg} THEN {S.lit(XG_METRIC)} ELSE 'shots' END AS metric",
        f"CASE WHEN {is_xg} THEN l_discount * 10 ELSE l_quantity END AS home_value",
        f"CASE WHEN {is_xg} THEN l_tax * 10 ELSE CAST(l_linenumber AS DOUBLE) END AS away_value",
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 player-season rows with the player file's column names.

    ``90s`` and ``Tkl+Int`` arrive renamed (``nineties``, ``tkl_int``), as the
    file reader does; ``KP`` arrives as text with some unparsable cells.
    ``ordinal`` is the file order.
    """
    brand = "try_cast(substring_index(p_brand, '#', -1) AS INT)"
    return _read(spark, sf_dir, "part").selectExpr(
        "concat(p_name, ' #', CAST(p_partkey AS STRING)) AS Player",
        f"element_at({S.array_of(POSITIONS)}, p_size % 4 + 1) AS Pos",
        f"coalesce(try_element_at({S.array_of(SQUAD_LABELS)}, {brand}), p_brand) AS Squad",
        f"coalesce(try_element_at({S.map_of(COMPETITIONS)}, p_type), p_type) AS Comp",
        "p_size / 10.0D AS nineties",
        "CAST(p_partkey % 7 AS DOUBLE) AS Gls",
        "CAST(p_partkey % 5 AS DOUBLE) AS Ast",
        "(p_partkey % 11) / 2.0D AS xG",
        "(p_partkey % 13) / 4.0D AS xAG",
        "CASE WHEN p_partkey % 97 = 0 THEN 'n/a' ELSE CAST(p_partkey % 17 AS STRING) END AS KP",
        "CAST(p_partkey % 19 AS DOUBLE) AS PrgP",
        "CAST(p_partkey % 6 AS DOUBLE) AS TklW",
        "CAST(p_partkey % 4 AS DOUBLE) AS `Int`",
        f"CASE WHEN {brand} % 5 = 0 THEN 0.0D ELSE CAST(p_partkey % 9 AS DOUBLE) END AS tkl_int",
        "CAST(p_partkey % 3 AS DOUBLE) AS Blocks",
        "CAST(p_partkey % 8 AS DOUBLE) AS Clr",
        "p_partkey AS ordinal",
    )


def _py_dict(key: str, name: str) -> str:
    """SQL building ``repr({key: name, 'g': None})`` (double quotes when the
    name holds a single quote, as ``repr`` does)."""
    quote = f"""CASE WHEN instr({name}, "'") > 0 THEN '"' ELSE "'" END"""
    return f"""concat("{{'{key}': ", {quote}, {name}, {quote}, ", 'g': None}}")"""


def score_text(pk: str, score: str) -> str:
    """Score cell text: mostly ``str(float)``, some padded, exponent or
    suffixed forms and some junk, chosen by a rule on the part key."""
    whole = f"CAST(CAST({score} AS INT) AS STRING)"
    return (f"CASE WHEN {pk} % 41 = 0 THEN 'x' "
            f"WHEN {pk} % 43 = 0 THEN concat(' ', CAST({score} AS STRING), ' ') "
            f"WHEN {pk} % 47 = 0 THEN concat({whole}, 'd') "
            f"WHEN {pk} % 79 = 0 THEN concat({whole}, 'd ') "
            f"WHEN {pk} % 83 = 0 THEN concat({whole}, 'f', chr(9)) "
            f"WHEN {pk} % 71 = 0 THEN 'nan' "
            f"WHEN {pk} % 73 = 0 THEN CAST(NULL AS STRING) "
            f"WHEN {pk} % 61 = 0 THEN concat({whole}, 'e0') "
            f"ELSE CAST({score} AS STRING) END")


def style_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 style-match rows: ``home_team, away_team`` cells holding a dict
    literal or a bare name, scores as text (some unparsable), plus ``ordinal``."""
    lines = match_lines(spark, sf_dir)
    t = teams(spark, sf_dir)
    ht, at = t.alias("ht"), t.alias("at")
    j = (lines.join(ht, F.col("home_team_id") == F.col("ht.id"))
         .join(at, F.col("away_team_id") == F.col("at.id")))
    return j.selectExpr(
        "event_id AS ordinal",
        f"""CASE WHEN l_linenumber = 1 THEN ht.name
                 WHEN l_partkey % 53 = 0 THEN "{{'x': 1}}"
                 WHEN l_partkey % 59 = 0 THEN "{{'home_team_name': None, 'g': 1}}"
                 ELSE {_py_dict('home_team_name', 'ht.name')} END AS home_team""",
        f"""CASE WHEN l_linenumber = 2 THEN at.name
                 ELSE {_py_dict('away_team_name', 'at.name')} END AS away_team""",
        f"{score_text('l_partkey', 'home_score')} AS home_score",
        "CAST(away_score AS STRING) AS away_score",
    )


def nested_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dict literal per part: flat, nested, with escapes, with a trailing comma, a list or no key."""
    name = f"try_element_at({S.array_of(TEAM_LABELS)}, CAST(p_partkey % 25 AS INT) + 1)"
    quoted = f"""concat(IF(instr({name}, "'") > 0, '"', "'"), {name}, IF(instr({name}, "'") > 0, '"', "'"))"""
    return _read(spark, sf_dir, "part").selectExpr(
        "p_partkey", f"""CASE CAST(p_partkey % 7 AS INT)
            WHEN 0 THEN concat("{{'home_team_name': ", {quoted}, "}}")
            WHEN 1 THEN concat("{{'home_team_id': 27, 'home_team_name': ", {quoted}, ", 'country': {{'id': 68, 'home_team_name': 'None', 'ok': True}}}}")
            WHEN 2 THEN concat("{{'managers': [{{'id': 1, 'nick': None}}, {{'id': 2}}], 'home_team_name': ", {quoted}, "}}")
            WHEN 3 THEN "{{'home_team_name': 'Nott\\\\'m Forest'}}"
            WHEN 4 THEN concat("{{'home_team_name': ", {quoted}, ",}}")
            WHEN 5 THEN "{{'country': {{'home_team_name': 'Inner'}}}}"
            ELSE "{{'home_team_name': ['a', 'b']}}" END AS cell""")


def token_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text cell per part, every third of them a missing-value token or close to one."""
    tokens = [*PANDAS_NA_TOKENS, "na", "none", " NA", "N/A ", "nil"]
    return _read(spark, sf_dir, "part").selectExpr(
        f"IF(p_partkey % 3 = 0, element_at({S.array_of(tokens)}, CAST(p_partkey % {len(tokens)} AS INT) + 1), p_brand) AS cell")


def upsert_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """V5: (stored rows, new batch) of per-customer order facts keyed by
    ``o_custkey``; ``ordinal`` orders rows within a batch."""
    orders = _read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    split = F.lit(UPSERT_SPLIT).cast("timestamp_ntz")
    ordinal = F.col("o_orderkey").alias("ordinal")   # later order key = later row
    stored = orders.filter(F.col("o_orderdate") < split).select("*", ordinal)
    batch = orders.filter(F.col("o_orderdate") >= split).select("*", ordinal)
    return stored, batch
