"""The eight daily metrics. Each works on batch detail rows and on a stream of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.timez import processing_millis
from waybill.operators.daily import ROWS, daily_totals
from waybill.operators.first import first_per_key, first_per_key_stream
from waybill.operators.lookup import Changing, lookup_join, org_city, region_climb
from waybill.schemas import (
    BOUND_EVENT,
    BOUND_TOPICS,
    METRIC_TYPES,
    METRICS,
    ORDER_EVENT,
    ORDER_TOPICS,
    TRANSPORT_FINISH,
    TRANSPORT_TOPIC,
)

# How far out of order rows may arrive. Where orders are counted once, the delay is also
# how long an order is remembered.
DISORDER = "5 seconds"
REMEMBER = "5 minutes"
DELIVERY_DISORDER = "1 day"


@dataclass(frozen=True)
class Dims:
    """The dimension tables lookups go to; a metric needs only some of them.

    Those that a stream looks grouping keys up in may be streams of changes.
    """

    organ: DataFrame | Changing | None = None
    region: DataFrame | None = None
    dic: DataFrame | None = None
    truck: DataFrame | Changing | None = None
    truck_model: DataFrame | None = None


@dataclass(frozen=True)
class Metric:
    """``totals`` runs on rows (or in the stream), ``named`` adds names to its result."""

    table: str
    topic: str
    ddl: str
    time_field: str
    delay: str
    totals: Callable[..., DataFrame]
    named: Callable[[DataFrame, Dims], DataFrame]

    @property
    def counts_orders(self) -> bool:
        """Whether rows are reduced to one per order first."""
        return self.ddl == ORDER_EVENT

    @property
    def keyed_by_dims(self) -> bool:
        """Whether grouping keys are looked up, which a stream does before it totals."""
        return self.totals in (_trade_org_totals, _receive_totals, _deliver_totals, _trip_totals)

    @property
    def uses_dims(self) -> bool:
        return self.named is not _unnamed

    def batch(self, detail: DataFrame, dims: Dims = Dims(), **options) -> DataFrame:
        """The metric of all detail rows, columns in insert order."""
        return self.finish(self.totals(detail, dims, **options), dims)

    def stream(
        self, detail: DataFrame, dims: Dims = Dims(), delay: str | None = None, **options
    ) -> DataFrame:
        """Running totals of a detail stream; ``finish`` each micro-batch of them."""
        return self.totals(detail.withWatermark("ts", delay or self.delay), dims, **options)

    def finish(self, totals: DataFrame, dims: Dims = Dims()) -> DataFrame:
        stamped = self.named(totals, dims).withColumn("ts", processing_millis())
        typed = {c: F.col(c).cast(t) for c, t in METRIC_TYPES.items() if c in stamped.columns}
        return stamped.withColumns(typed).select(METRICS[self.table])


def once_per_order(rows: DataFrame, salts: int = 16) -> DataFrame:
    """The first row of each order: by ``(ts, id)`` in batch, by arrival in a stream."""
    if salts < 1:
        raise ValueError("salts must be 1 at least")
    if rows.isStreaming:
        return first_per_key_stream(rows, ["order_id"], "id", salts)
    return first_per_key(rows, ["order_id"], ["ts", "id"])


def _unnamed(totals: DataFrame, dims: Dims) -> DataFrame:
    return totals


def _district_org(dims: Dims) -> Callable[[DataFrame], DataFrame]:
    """The organisation serving a district: any one, here the smallest id."""
    return lambda rows: lookup_join(
        rows,
        dims.organ,
        {"district_id": "region_id"},
        {"id": "org_id", "org_name": "org_name"},
    )


def _place(detail: DataFrame, side: str, *more: Column) -> DataFrame:
    return detail.select(
        "id",
        "order_id",
        "ts",
        F.col(f"{side}_district_id").alias("district_id"),
        F.col(f"{side}_city_id").alias("city_id"),
        F.col(f"{side}_province_id").alias("province_id"),
        *more,
    )


def _org_totals(rows: DataFrame, dims: Dims, measures: dict, carried: list[str]) -> DataFrame:
    return daily_totals(
        rows,
        ["org_id"],
        measures,
        carried=carried,
        resolve=_district_org(dims),
        raw_keys=["district_id"],
        found=["org_name"],
    )


def _city_and_province(totals: DataFrame, dims: Dims) -> DataFrame:
    named = lookup_join(totals, dims.region, {"city_id": "id"}, {"name": "city_name"}, unique=True)
    return lookup_join(
        named, dims.region, {"province_id": "id"}, {"name": "province_name"}, unique=True
    )


# --- sorts per organisation ---------------------------------------------------------------


def _sort_totals(detail: DataFrame, dims: Dims) -> DataFrame:
    return daily_totals(detail.select("org_id", "ts"), ["org_id"], {"sort_count_base": ROWS})


def _sort_named(totals: DataFrame, dims: Dims) -> DataFrame:
    placed = org_city(totals, dims.organ).withColumnRenamed("found_org_name", "org_name")
    return region_climb(placed, dims.region)


# --- orders and amount per cargo type -----------------------------------------------------


def _cargo_totals(
    detail: DataFrame, dims: Dims, salts: int = 16, dedup: bool = True
) -> DataFrame:
    """The whole order counts for the cargo type of its first line.

    ``dedup=False`` says the rows are one per order already.
    """
    rows = detail.select("id", "order_id", "cargo_type", "amount", "ts")
    rows = once_per_order(rows, salts) if dedup else rows
    return daily_totals(
        rows,
        ["cargo_type"],
        {"order_amount_base": "amount", "order_count_base": ROWS},
    )


def _cargo_named(totals: DataFrame, dims: Dims) -> DataFrame:
    return lookup_join(
        totals, dims.dic, {"cargo_type": "id"}, {"name": "cargo_type_name"}, unique=True
    )


# --- orders and amount per organisation ---------------------------------------------------


def _trade_org_totals(
    detail: DataFrame, dims: Dims, salts: int = 16, dedup: bool = True
) -> DataFrame:
    """An order counts once; ``dedup=False`` says the rows are one per order already."""
    rows = _place(detail, "sender", F.col("amount")).drop("province_id")
    rows = once_per_order(rows, salts) if dedup else rows
    return _org_totals(
        rows,
        dims,
        {"order_amount_base": "amount", "order_count_base": ROWS},
        ["city_id"],
    )


def _city(totals: DataFrame, dims: Dims) -> DataFrame:
    return lookup_join(totals, dims.region, {"city_id": "id"}, {"name": "city_name"}, unique=True)


# --- orders received and delivered per organisation ---------------------------------------


def _receive_totals(
    detail: DataFrame, dims: Dims, salts: int = 16, dedup: bool = True, side: str = "sender"
) -> DataFrame:
    """An order counts once; with ``dedup=False`` each of its cargo lines counts."""
    rows = _place(detail, side)
    rows = once_per_order(rows, salts) if dedup else rows
    return _org_totals(
        rows, dims, {"receive_order_count_base": ROWS}, ["city_id", "province_id"]
    )


def _deliver_totals(
    detail: DataFrame, dims: Dims, salts: int = 16, side: str = "sender"
) -> DataFrame:
    rows = once_per_order(_place(detail, side), salts)
    return _org_totals(rows, dims, {"deliver_suc_count_base": ROWS}, ["city_id", "province_id"])


# --- orders dispatched and transferred per day --------------------------------------------


def _order_count(name: str) -> Callable[..., DataFrame]:
    def totals(detail: DataFrame, dims: Dims, salts: int = 16) -> DataFrame:
        rows = once_per_order(detail.select("id", "order_id", "ts"), salts)
        return daily_totals(rows, [], {name: ROWS})

    return totals


# --- finished trips per organisation and truck model --------------------------------------


def _trip_totals(detail: DataFrame, dims: Dims) -> DataFrame:
    rows = detail.select(
        F.col("start_org_id").alias("org_id"),
        F.col("start_org_name").alias("org_name"),
        "truck_id",
        "actual_distance",
        "transport_time",
        "ts",
    )
    return daily_totals(
        rows,
        ["org_id", "truck_model_id"],
        {
            "trans_finish_count_base": ROWS,
            "trans_finish_distance_base": "actual_distance",
            "trans_finish_dur_time_base": "transport_time",
        },
        carried=["org_name"],
        resolve=lambda r: lookup_join(
            r, dims.truck, {"truck_id": "id"}, {"truck_model_id": "truck_model_id"}, unique=True
        ),
        raw_keys=["org_id", "truck_id"],
    )


def _trip_named(totals: DataFrame, dims: Dims) -> DataFrame:
    modelled = lookup_join(
        totals,
        dims.truck_model,
        {"truck_model_id": "id"},
        {"model_name": "truck_model_name"},
        unique=True,
    )
    return _city(org_city(modelled, dims.organ).drop("found_org_name"), dims)


def _order_metric(table: str, event: str, delay: str, totals, named=_unnamed) -> Metric:
    topic, time_field = ORDER_TOPICS[event]
    return Metric(table, topic, ORDER_EVENT, time_field, delay, totals, named)


BOUND_ORG_SORT_DAY = Metric(
    "dws_bound_org_sort_day",
    BOUND_TOPICS["sort"][0],
    BOUND_EVENT,
    BOUND_TOPICS["sort"][1],
    DISORDER,
    _sort_totals,
    _sort_named,
)
TRADE_CARGO_TYPE_ORDER_DAY = _order_metric(
    "dws_trade_cargo_type_order_day", "order", REMEMBER, _cargo_totals, _cargo_named
)
TRADE_ORG_ORDER_DAY = _order_metric(
    "dws_trade_org_order_day", "order", REMEMBER, _trade_org_totals, _city
)
TRANS_BOUND_FINISH_DAY = _order_metric(
    "dws_trans_bound_finish_day",
    "bound_finish",
    REMEMBER,
    _order_count("bound_finish_order_count_base"),
)
TRANS_DISPATCH_DAY = _order_metric(
    "dws_trans_dispatch_day", "dispatch", REMEMBER, _order_count("dispatch_order_count_base")
)
TRANS_ORG_DELIVER_SUC_DAY = _order_metric(
    "dws_trans_org_deliver_suc_day",
    "deliver_suc",
    DELIVERY_DISORDER,
    _deliver_totals,
    _city_and_province,
)
TRANS_ORG_RECEIVE_DAY = _order_metric(
    "dws_trans_org_receive_day", "receive", REMEMBER, _receive_totals, _city_and_province
)
TRANS_ORG_TRUCK_MODEL_TRANS_FINISH_DAY = Metric(
    "dws_trans_org_truck_model_trans_finish_day",
    TRANSPORT_TOPIC,
    TRANSPORT_FINISH,
    "actual_end_time",
    DISORDER,
    _trip_totals,
    _trip_named,
)
ALL = {
    m.table: m
    for m in (
        BOUND_ORG_SORT_DAY,
        TRADE_CARGO_TYPE_ORDER_DAY,
        TRADE_ORG_ORDER_DAY,
        TRANS_BOUND_FINISH_DAY,
        TRANS_DISPATCH_DAY,
        TRANS_ORG_DELIVER_SUC_DAY,
        TRANS_ORG_RECEIVE_DAY,
        TRANS_ORG_TRUCK_MODEL_TRANS_FINISH_DAY,
    )
}
