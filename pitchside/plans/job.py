"""The scheduled job C9: load -> features -> train -> gate -> model -> snapshots.

``python -m pitchside.plans.job --matches DIR --out DIR [--players CSV] [--style CSV] [--season 2025/2026 ...]`` runs it
on the tables ``events``, ``teams`` and ``match_stats``, parquet folders in ``DIR``, with ``--jdbc URL`` in place of
``--matches`` the tables of a database, or with ``--bucketed PREFIX`` catalog tables bucketed by match
(:mod:`pitchside.sources.bucketed`).  Every field of :class:`pitchside.params.Params` with a plain value is an option.

The model is published before the snapshots are tried, and a snapshot that fails is logged and
leaves the model in place; so is an xG source that fails, after which training goes on without xG.
One UTC timestamp marks all outputs of a run.  Each file is parsed once, into a columnar copy (players split by
the league's, so that later steps open only their files); rows that do not match the header are counted and put out as ``bad_rows``.  The counts of all stages (G3) are observed on frames that are written
anyway and published with the model; the gate (G1) fails the write of the trained rows.

Fault tolerance: the per-team totals and the trained rows, which several outputs share, are
checkpointed into the cluster's shared ``spark.checkpoint.dir``; all writes go to fresh version
folders and become visible through a commit made after them (:mod:`pitchside.plans.sinks`).
"""

from __future__ import annotations

import argparse
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.operators import card, impact, players, quality, strength, style
from pitchside.params import Params, utc_now
from pitchside.plans import sinks, snapshots
from pitchside.plans.training import train_from_events
from pitchside.session import ensure_checkpoint_dir
from pitchside.sources import files, jdbc

log = logging.getLogger(__name__)

IMPACT = "player_absence_impact"


@dataclass
class JobInputs:
    events: DataFrame                   # all matches of the source, ended or not
    teams: DataFrame
    match_stats: DataFrame | Callable[[], DataFrame] | None = None  # the long metric table, or what reads it
    players: DataFrame | None = None    # S3 shape (renamed columns)
    style_matches: DataFrame | None = None  # S4 shape


def load(events: DataFrame, teams: DataFrame, match_stats: Callable[[], DataFrame], players_csv: str | None = None,
         style_csv: str | None = None) -> JobInputs:
    """C4 and the file sources; a missing file means no such input."""
    spark = events.sparkSession
    read = lambda path, reader: reader(spark, path, keep_bad=True) if path and files.exists(spark, path) else None
    return JobInputs(events, teams, match_stats, players=read(players_csv, files.read_players),
                     style_matches=read(style_csv, files.read_style_matches))


def run(spark: SparkSession, inputs: JobInputs, out_base: str, params: Params = Params()) -> dict[str, str]:
    """Run the whole job; returns table -> written path."""
    ensure_checkpoint_dir(spark)
    now = utc_now()
    params = replace(params, trained_at=params.trained_at or now, created_at=params.created_at or now,
                     snapshot_date=params.snapshot_date or now.date().isoformat())
    counts, failed = quality.Counts(), []

    scratch = f"{ensure_checkpoint_dir(spark)}/job-{uuid.uuid4()}"
    bad: dict[str, DataFrame] = {}

    def once(name: str, df: DataFrame, flag: str = "true") -> DataFrame:
        """A columnar copy of a file, its rows and the bad ones among them counted on the way."""
        df = counts(f"{name}_read", df)
        if files.BAD in df.columns:
            df = counts(f"{name}_bad_rows", df, f"count_if({files.BAD} IS NOT NULL)")
        copy = files.columnar(df, f"{scratch}/{name}", F.expr(flag))
        if counts.take(f"{name}_read", f"{name}_bad_rows").get(f"{name}_bad_rows"):
            bad[name] = files.bad_rows(copy)
        return copy

    features = league = None
    if inputs.players is not None:
        league = counts("league_players", once("players", inputs.players, players.in_competition(params)).filter("flagged"))
        features = players.player_strength_index(league, params, counts).checkpoint()
        counts.take("league_players", "players", "featured_teams")
        league = spark.read.schema(league.schema).parquet(f"{scratch}/players").filter("flagged")  # read again, not counted again

    def no_xg(exc: Exception) -> None:
        log.warning("no xG: %s", exc)
        failed.append("xg")

    result = train_from_events(inputs.events, inputs.teams, inputs.match_stats, features, params,
                               materialise=lambda df: df.checkpoint(), on_xg_failure=no_xg, seen=counts)
    rows = counts("teams", counts("enriched_teams", result.everything, "count_if(attack_index IS NOT NULL)"))
    seen = result.totals.agg(F.sum("raw_home_rows").alias("n"))
    try:
        rows = quality.guarded(rows, seen, params.min_matches).checkpoint()   # G1, on rows before coercion
    except Exception as exc:  # noqa: BLE001
        if quality.GATE in str(exc):
            raise quality.GateError(next(x for x in str(exc).splitlines() if quality.GATE in x)) from exc
        raise
    counts.take("matches", "teams", "enriched_teams", *([] if failed or inputs.match_stats is None else ["xg_records"]))

    version = sinks.new_version()
    written = {
        "team_strengths": sinks.write_table(rows.drop(*strength.LEAGUE_COLS), out_base, "team_strengths", version),
        "league_params": sinks.write_table(card.model_header(rows, params), out_base, "league_params", version),
        "model_card": sinks.write_table(card.card_json(card.model_card(rows, params)), out_base, "model_card", version, fmt="text"),
    }
    written |= {f"bad_rows/{name}": sinks.write_table(df, out_base, f"bad_rows/{name}", version) for name, df in bad.items()}
    sinks.publish(spark, out_base, version, written, counts=counts.rows)
    log.info("published model %s: %s", version, counts.rows)                 # G3
    try:
        rows = once("style", inputs.style_matches) if inputs.style_matches is not None else None
        snapshots_written = write_snapshots(spark, features, league, rows, out_base, params, counts)
        if "style" in bad:
            late = {"bad_rows/style": sinks.write_table(bad["style"], out_base, "bad_rows/style", version)}
            sinks.publish(spark, out_base, version, late)
            snapshots_written |= late
        written |= snapshots_written
        log.info("published snapshots: %s", counts.rows)
    except Exception as exc:  # noqa: BLE001  the model stays published whatever a snapshot raises
        log.warning("snapshots failed, the model is published: %s", exc)
    files.delete(spark, scratch)
    return written


def write_snapshots(spark: SparkSession, features: DataFrame | None, league_players: DataFrame | None, style_matches: DataFrame | None,
                    out_base: str, params: Params, counts: quality.Counts | None = None) -> dict[str, str]:
    """Upsert the three snapshot tables, only the buckets that change, and publish them together."""
    counts = counts or quality.Counts()
    batches = []
    if features is not None:
        batches.append(("team_player_strength_snapshot", snapshots.player_strength_batch(features, params),
                        snapshots.PLAYER_STRENGTH_KEYS, None))
        top = snapshots.impact_batch(counts("impact_rows", impact.player_impact(league_players, params)), params).checkpoint()
        # other days stay as they are
        batches.append((f"{IMPACT}/{params.snapshot_date}", top, snapshots.IMPACT_KEYS, ["rank"]))
        counts.take("impact_rows")
    if style_matches is not None:
        rates = snapshots.style_batch(style.team_style(style_matches, params, counts), params).checkpoint()
        counts.take("style", "residual_literals", "style_teams")
        batches.append(("team_style_snapshot", rates, snapshots.STYLE_KEYS, None))

    def write(current: dict[str, str], version: str) -> tuple[dict[str, str], dict[str, str | None]]:
        tables: dict[str, str] = {}
        based_on: dict[str, str | None] = {}
        for name, batch, keys, order in batches:
            merge = lambda b, stored, keys=keys, order=order: snapshots.apply(stored, b, keys, params, order).drop("rank")
            new, old = snapshots.upsert_buckets(batch, out_base, name, version, current, keys, merge, params.snapshot_buckets)
            tables, based_on = tables | new, based_on | old
        return tables, based_on

    return sinks.commit(spark, out_base, write)


def arguments(argv: list[str] | None = None) -> tuple[argparse.Namespace, Params]:
    args = argparse.ArgumentParser(prog="pitchside.plans.job")
    source = args.add_mutually_exclusive_group(required=True)
    source.add_argument("--matches", help="folder with the tables events, teams and match_stats as parquet")
    source.add_argument("--jdbc", help="JDBC URL of a database with these tables")
    source.add_argument("--bucketed", help="prefix of the catalog tables events, teams and match_stats")
    for name, default in (("lower", 0), ("upper", 1 << 31), ("partitions", 64)):
        args.add_argument(f"--jdbc-{name}", type=int, default=default, help="ranges of match ids that tables are read in")
    args.add_argument("--out", required=True)
    args.add_argument("--players", help="player-season CSV")
    args.add_argument("--style", help="style-match CSV")
    given = [f for f in fields(Params) if isinstance(f.default, (int, float, str)) or f.name == "snapshot_date"]
    for f in given:
        args.add_argument(f"--{f.name.replace('_', '-')}", type=str if f.name == "snapshot_date" else type(f.default), default=f.default)
    a = args.parse_args(argv)
    return a, Params(**{f.name: getattr(a, f.name) for f in given})


def main(argv: list[str] | None = None) -> None:
    a, params = arguments(argv)
    spark = SparkSession.builder.getOrCreate()
    if a.jdbc:
        read = lambda name: jdbc.match_table(spark, a.jdbc, name, a.jdbc_lower, a.jdbc_upper, a.jdbc_partitions)
    elif a.bucketed is not None:
        read = lambda name: spark.table(f"{a.bucketed}{name}")
    else:
        read = lambda name: spark.read.parquet(f"{a.matches}/{name}")
    run(spark, load(read("events"), read("teams"), lambda: read("match_stats"), a.players, a.style), a.out, params)


if __name__ == "__main__":
    main()
