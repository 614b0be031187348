"""Composite training plan C5 (and the feature plan C2 it consumes).

Header and card need no xG, so they come from the strengths enriched without it.  From the raw tables
(:func:`train_from_events`) the goals are one pass over the matches without any shuffle of them, and the xG
another one in an inner join with the metric's few matches, which lets Spark put a Bloom filter of these ahead of
the shuffle, or leave the shuffle out where both tables are bucketed by match (:mod:`pitchside.sources.bucketed`).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.operators import card, enrich, strength, xg
from pitchside.operators.matches import finished_matches, xg_matches
from pitchside.operators.quality import Seen, unseen
from pitchside.params import Params


@dataclass
class TrainingResult:
    totals: DataFrame          # per team (null group kept), one pass over matches
    team_strengths: DataFrame  # §1.1 team_strengths
    params: Params

    with_league: DataFrame     # enriched strengths without xG, with league figures (card input)
    everything: DataFrame      # team_strengths with the league figures, for a job that writes all outputs

    @property
    def league_params(self) -> DataFrame:
        """One row (K1 header); planned only when asked for."""
        return card.model_header(self.with_league, self.params)

    @property
    def model_card(self) -> DataFrame:
        """One row, nested (K2); planned only when asked for."""
        return card.model_card(self.with_league, self.params)


def team_totals(matches: DataFrame, time_col: str | None = "time_utc") -> DataFrame:
    """The single pass over the match fact."""
    if time_col is not None and time_col not in matches.columns:
        time_col = None
    return strength.role_totals(matches, time_col=time_col)


def _without(df: DataFrame, columns: list[str]) -> DataFrame:
    whole = {"xg_matches": "bigint", "squad_depth": "int"}
    return df.select("*", *[F.lit(None).cast(whole.get(c, "double")).alias(c) for c in columns])


def train(matches: DataFrame, xg_rows: DataFrame | None = None,
          features: DataFrame | None = None, params: Params = Params(),
          totals: DataFrame | None = None, xg_sums: DataFrame | None = None, materialised: bool = False) -> TrainingResult:
    """Strengths (A1, A3-A6) -> xG adjustment (A7) -> enrichment (J5) ->
    header and card (A14-A16).

    ``totals`` may be supplied pre-computed (e.g. checkpointed by the job) so
    several outputs share one pass over ``matches``; ``xg_sums`` likewise in place of ``xg_rows``;
    ``materialised`` says that both are checkpoints and cheap to read again.
    """
    def enriched(s: DataFrame) -> DataFrame:
        return _without(s, enrich.INDEX_COLS) if features is None else enrich.enrich_strengths(s, features, params)

    totals = team_totals(matches) if totals is None else totals
    base = strength.strengths_from_totals(totals, params, keep_league=True, materialised=materialised)
    if xg_sums is None and xg_rows is not None:
        xg_sums = xg.xg_team_sums(xg_rows)
    everything = enriched(_without(base, xg.XG_COLS) if xg_sums is None else xg.strengths_from_sums(xg_sums, base, params, materialised))
    return TrainingResult(totals=totals, team_strengths=everything.drop(*strength.LEAGUE_COLS), params=params,
                          with_league=enriched(base), everything=everything)


def train_from_events(events: DataFrame, teams: DataFrame, match_stats: DataFrame | Callable[[], DataFrame] | None,
                      features: DataFrame | None = None, params: Params = Params(), materialise: Callable[[DataFrame], DataFrame] | None = None,
                      on_xg_failure: Callable[[Exception], None] | None = None, seen: Seen = unseen) -> TrainingResult:
    """C5 from the raw tables.  Teams that only have xG are not trained.

    ``materialise`` (a checkpoint) is put on the per-team totals that several outputs share.  If the xG source fails
    there (S5), ``on_xg_failure`` is told and training goes on without xG; without it the failure is raised.
    ``seen`` counts the stages ``matches`` and ``xg_records``.
    """
    keep = materialise or (lambda df: df)
    totals = keep(team_totals(seen("matches", finished_matches(events, teams))))
    sums = None
    try:
        if match_stats is not None:
            metric = match_stats() if callable(match_stats) else match_stats
            sums = keep(xg.xg_team_sums(seen("xg_records", xg_matches(metric, events, teams))))
    except Exception as exc:  # noqa: BLE001  whatever the source raises, there is no xG then
        if on_xg_failure is None:
            raise
        on_xg_failure(exc)
    return train(events, None, features, params, totals=totals, xg_sums=sums, materialised=materialise is not None)
