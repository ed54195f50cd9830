"""The job that keeps dimension tables current."""

from __future__ import annotations

from pyspark.sql import DataFrame

from waybill.sources.changelog import LOG_POSITION, live_changes, parse_envelope


def dim_changes(ods: DataFrame) -> DataFrame:
    """Live changes as ``op, ts, position, table, after``: what dimensions need of an envelope."""
    kept = [c for c in ("value", LOG_POSITION) if c in ods.columns]
    changes = live_changes(parse_envelope(ods.select(kept)))
    return changes.select("op", "ts", "position", "table", "after")
