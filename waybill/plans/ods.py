"""Raw change log to the operational topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.schemas import CONFIG_TABLE, DIM_TABLES, FACT_TABLES, ODS_TOPIC
from waybill.sources.changelog import live_changes, parse_envelope

# Which tables a source option covers. Facts start at the newest change, the others with a
# snapshot of the table.
SOURCES = {
    "dwd": (FACT_TABLES, "latest"),
    "realtime_dim": (DIM_TABLES, "earliest"),
    "config_dim": ([CONFIG_TABLE], "earliest"),
}


def source_tables(option: str) -> tuple[list[str], str]:
    """Tables and start position of a source option."""
    if option not in SOURCES:
        raise ValueError(f"unsupported source option {option!r}")
    return SOURCES[option]


def ods_rows(lines: DataFrame, options: tuple[str, ...] = ("dwd", "realtime_dim")) -> DataFrame:
    """Change lines to ``topic, key, table, value``.

    Malformed lines and deletes are left out, ``ts_ms`` is renamed to ``ts``. The key is the
    row's id, which spreads the tables' rows and keeps one row's changes in order.
    """
    tables = [t for option in options for t in source_tables(option)[0]]
    image = "struct<id:string>"
    changes = live_changes(parse_envelope(lines, image)).filter(F.col("table").isin(tables))
    return changes.select(
        F.lit(ODS_TOPIC).alias("topic"),
        F.col("after.id").alias("key"),
        "table",
        rename_ts("value").alias("value"),
    )


def rename_ts(value: str) -> Column:
    """Envelope text with ``ts_ms`` under the name ``ts``; the images stay as they were."""
    e = F.from_json(
        value,
        "before string, after string, source string, op string, ts_ms bigint, ts bigint, "
        "transaction string",
    )

    def part(name: str, text: Column) -> Column:
        return F.concat(F.lit(f',"{name}":'), F.coalesce(text, F.lit("null")))

    escaped = F.to_json(F.array(e["op"]))
    op = F.when(e["op"].isNotNull(), F.substring(escaped, F.lit(2), F.length(escaped) - 2))
    return F.concat(
        F.lit('{"op":'),
        F.coalesce(op, F.lit("null")),
        part("ts", F.coalesce(e["ts_ms"], e["ts"]).cast("string")),
        part("source", e["source"]),
        part("before", e["before"]),
        part("after", e["after"]),
        F.when(e["transaction"].isNotNull(), part("transaction", e["transaction"])).otherwise(""),
        F.lit("}"),
    )
