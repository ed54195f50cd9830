"""The three jobs that turn the change log into detail topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.operators.events import (
    bound_events,
    bound_messages,
    cargo_changes,
    order_changes,
    order_events,
    order_messages,
    transport_finishes,
    transport_messages,
)
from waybill.schemas import (
    ORDER_CARGO,
    ORDER_INFO,
    ORDER_ORG_BOUND,
    TRANSPORT_TASK,
    TRANSPORT_TOPIC,
)
from waybill.sources.changelog import live_changes, parse_envelope, route
from waybill.streaming.order_events import order_events_stream


def _changes(ods: DataFrame, table: str, after: str, before: str | None = None) -> DataFrame:
    """One table's changes, parsed with just the fields it has."""
    if "table" in ods.columns:  # files partitioned by table: other tables are not read
        ods = ods.filter(F.col("table") == table).drop("table")
    return route(live_changes(parse_envelope(ods, after, before)), table)


def order_details(ods: DataFrame, salts: int = 4) -> DataFrame:
    """``event`` and detail columns of all order events; batch and streaming."""
    orders = order_changes(_changes(ods, "order_info", f"struct<{_ddl(ORDER_INFO)}>", "struct<status:string>"))
    cargo = cargo_changes(_changes(ods, "order_cargo", f"struct<{_ddl(ORDER_CARGO)}>", "struct<id:string>"))
    if ods.isStreaming:
        return order_events_stream(orders, cargo, salts=salts)
    return order_events(orders, cargo)


def bound_details(ods: DataFrame) -> DataFrame:
    return bound_events(_changes(ods, "order_org_bound", f"struct<{_ddl(ORDER_ORG_BOUND)}>"))


def transport_details(ods: DataFrame) -> DataFrame:
    row = f"struct<{_ddl(TRANSPORT_TASK)}>"
    return transport_finishes(_changes(ods, "transport_task", row, "struct<actual_end_time:string>"))


def order_topics(ods: DataFrame, salts: int = 4) -> DataFrame:
    return order_messages(order_details(ods, salts))


def bound_topics(ods: DataFrame) -> DataFrame:
    return bound_messages(bound_details(ods))


def transport_topic(ods: DataFrame) -> DataFrame:
    return transport_messages(transport_details(ods), TRANSPORT_TOPIC)


def _ddl(columns: str) -> str:
    """``a int, b string`` to ``a:int,b:string``."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(columns).simpleString().removeprefix("struct<").removesuffix(">")
