"""The campaign chain, one function per stage, shared by batch and stream.

    geo events -> clean -> watermark -> dedup -> window aggregate
               -> consents -> cells -> candidates -> decide -> alerts

``campaign_plan`` wires the stages for an events frame (batch or streaming)
and returns every intermediate frame, so callers and tests can pick any.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from surgecast.config import CampaignConfig
from surgecast.functions.columns import event_time
from surgecast.operators import clean as C
from surgecast.operators import decide as D
from surgecast.operators import dedup as DD
from surgecast.operators import enrich as E
from surgecast.operators import reports as R
from surgecast.operators import windows as W
from surgecast.operators.joins import StaticSide, as_side


@dataclass
class CampaignPlan:
    cleaned: DataFrame
    deduped: DataFrame
    aggregated: DataFrame
    with_consents: DataFrame
    with_cells: DataFrame
    candidates: DataFrame
    decisions: DataFrame
    consents: StaticSide
    cells: StaticSide

    def alerts(self, with_stamp: bool = True) -> DataFrame:
        return R.alerts(self.decisions, with_stamp=with_stamp)


def with_event_time(events: DataFrame) -> DataFrame:
    if "eventTime" in events.columns:
        return events
    return events.withColumn("eventTime", event_time("timestamp"))


def campaign_plan(
    events: DataFrame,
    consents: DataFrame | StaticSide,
    cells: DataFrame | StaticSide,
    cfg: CampaignConfig | None = None,
    prefilter: bool | None = None,
    replies: DataFrame | None = None,
) -> CampaignPlan:
    """Wire the chain over ``events`` (8 geo fields, eventTime optional).

    With ``prefilter`` (default from the config) events of non-consenting
    clients and inactive cells are dropped before the stateful stages, however
    large those tables are; ``deduped`` and ``aggregated`` then hold eligible
    traffic only, and every later frame is unchanged.

    ``replies`` (see ``operators.decide.REPLY_KEYS``) are decisions of an
    outside service; the rules decide where none is usable.
    """
    cfg = cfg or CampaignConfig()
    consents_side = as_side(consents, "consents", cfg.broadcast_max_bytes)
    cells_side = as_side(cells, "cells", cfg.broadcast_max_bytes)
    prefilter = cfg.prefilter_eligible if prefilter is None else prefilter

    cleaned = C.clean(with_event_time(events), cfg.max_ahead)
    watermarked = DD.with_watermark(cleaned, cfg.watermark_delay)
    if prefilter:
        watermarked = E.eligible_events(watermarked, consents_side, cells_side)
    deduped = DD.dedup(watermarked, combine=cfg.combine_copies)
    aggregated = W.window_aggregate(deduped, cfg)
    wc = E.with_consents(aggregated, consents_side)
    wcell = E.with_cells(wc, cells_side)
    cands = E.candidates(wcell, cfg)
    decisions = D.decide(cands, cfg) if replies is None else D.decide_with_replies(cands, replies, cfg)
    return CampaignPlan(
        cleaned=cleaned,
        deduped=deduped,
        aggregated=aggregated,
        with_consents=wc,
        with_cells=wcell,
        candidates=cands,
        decisions=decisions,
        consents=consents_side,
        cells=cells_side,
    )
