"""Enrichment from static tables and the candidate filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast.config import CampaignConfig
from surgecast.functions.columns import in_comma_list
from surgecast.operators.joins import StaticSide, semi_filter


def consent_ok() -> Column:
    # a null flag is not consent; as a comparison it is pushed into the scan,
    # and Spark takes it as selective enough for a Bloom filter of the clients
    return F.col("hasConsent").eqNullSafe(F.lit(True))


def campaign_active() -> Column:
    return F.col("campaignActive").eqNullSafe(F.lit(True))


def with_consents(agg: DataFrame, consents: StaticSide) -> DataFrame:
    """Inner equi-join on clientId, consenting clients only."""
    return agg.join(consents.for_join(), on="clientId", how="inner").where(consent_ok())


def with_cells(df: DataFrame, cells: StaticSide) -> DataFrame:
    """Inner equi-join on cellId, cells with an active campaign only."""
    return df.join(cells.for_join(), on="cellId", how="inner").where(campaign_active())


def over_threshold() -> Column:
    # averages are already truncated ints; inclusive, column to column
    return F.col("avgCongestion") >= F.col("congestionThreshold")


def candidates(enriched: DataFrame, cfg: CampaignConfig | None = None) -> DataFrame:
    """Clients whose window average reaches their cell's own threshold,
    plus the optional minimum-evidence and target-cell rules."""
    cfg = cfg or CampaignConfig()
    cond = over_threshold()
    if cfg.min_events is not None:
        cond = cond & (F.col("eventCount") >= F.lit(cfg.min_events))
    if cfg.require_target_cell:
        cond = cond & in_comma_list("cellId", "targetCells")
    return enriched.where(cond)


def eligible_events(events: DataFrame, consents: StaticSide, cells: StaticSide) -> DataFrame:
    """Drop events of clients without consent and of inactive cells before
    the stateful stages. Window aggregates are per (client, cell), so
    removing whole clients and cells leaves every other group unchanged and
    the candidate set identical, while state and shuffle shrink to eligible
    traffic. The rows that pass are the same for tables of any size."""
    out = semi_filter(events, consents, "clientId", consent_ok())
    return semi_filter(out, cells, "cellId", campaign_active())
