"""Dimension tables kept current from a change log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybill.config import JobConfig
from waybill.operators.routing import DimConfig, config_rows, dim_rows
from waybill.plans.dim import dim_changes
from waybill.streaming.sinks import trigger
from waybill.streaming.tables import POSITION, RETAIN_SECONDS, KeyedTable


class DimTables:
    """One keyed table per dimension below ``root``; every column is text."""

    def __init__(self, spark: SparkSession, root: str, retain_seconds: float = RETAIN_SECONDS):
        self.spark, self.root, self.retain_seconds = spark, root.rstrip("/"), retain_seconds

    def table(self, config: DimConfig) -> KeyedTable:
        ddl = ", ".join(f"`{c}` string" for c in config.columns)
        return KeyedTable(self.spark, f"{self.root}/{config.sink_table}", ddl, [config.key], retain_seconds=self.retain_seconds)

    def read(self, config: DimConfig) -> DataFrame:
        return self.table(config).read()


def apply_dim_changes(
    tables: DimTables, changes: DataFrame, config: DataFrame, batch_id: int, compact_every: int = 50
) -> None:
    """Route one batch of live changes into the dimension tables.

    Tables differ in their columns, so each with changes is written by itself from the
    batch, which is kept for that long; their number is that of the config rows.
    """
    rows = config_rows(config)
    known = changes.filter(F.col("table").isin([c.source_table for c in rows])).persist()
    try:
        present = {r[0] for r in known.select("table").distinct().collect()}
        for dim in rows:
            table = tables.table(dim)
            table.create()
            if dim.source_table in present:
                order = [F.col(c) for c in ("ts", POSITION) if c in known.columns]
                table.upsert(dim_rows(known, dim, order), batch_id)
            if batch_id % compact_every == compact_every - 1:
                table.compact()
    finally:
        known.unpersist()


def start_dim_sink(
    ods: DataFrame, read_config: Callable[[], DataFrame], config: JobConfig, name: str
) -> StreamingQuery:
    """Keep the tables current. The routing config is read anew for every micro-batch."""
    tables = DimTables(ods.sparkSession, config.need("dim-root"))

    def save(batch: DataFrame, batch_id: int) -> None:
        routing = read_config()
        if "table" in batch.columns:  # other tables' rows are not even parsed
            wanted = [c.source_table for c in config_rows(routing)]
            batch = batch.filter(F.col("table").isin(wanted))
        apply_dim_changes(tables, dim_changes(batch), routing, batch_id)

    return (
        ods.writeStream.queryName(name)
        .trigger(**trigger(config))
        .option("checkpointLocation", f"{config.need('checkpoint-root')}/{name}")
        .foreachBatch(save)
        .start()
    )
