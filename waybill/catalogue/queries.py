"""Every operator as a query over the benchmark tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill import session
from waybill.catalogue import standins as S
from waybill.catalogue.standins import table
from waybill.functions import masking, timez
from waybill.operators import events as ev
from waybill.operators.first import latest_per_key, with_first_flag
from waybill.operators.lookup import lookup_join, org_city, region_climb
from waybill.operators.routing import DimConfig, dim_rows, route_by_config
from waybill.plans import dws, ods
from waybill.sources.changelog import live_changes, malformed, parse_envelope, route
from waybill.streaming.dims import DimTables, apply_dim_changes
from waybill.streaming.sinks import load_topic, save_topics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(session.use_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def money(*names: str) -> dict[str, Column]:
    """Decimal results as doubles, which compare alike across engines."""
    return {n: F.col(n).cast("double") for n in names}


# --- detail rows --------------------------------------------------------------------------


@query
def order_detail_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.order_lines(spark, sf_dir).select(
        "order_id",
        F.col("id.l_linenumber").alias("line"),
        "cargo_type",
        "status",
        "collect_type",
        "user_id",
        "sender_district_id",
        "sender_province_id",
        masking.mask_name("sender_name").alias("sender_name"),
        "payment_type",
        *[c.alias(n) for n, c in money("weight", "amount").items()],
        timez.local_text("ts").alias("order_time"),
    )


@query
def first_line_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dws.once_per_order(S.cargo_lines(table(spark, sf_dir, "lineitem"))).select(
        "order_id",
        F.col("id.l_linenumber").alias("line"),
        "cargo_type",
        timez.local_text("ts").alias("order_time"),
    )


@query
def first_line_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line kept, the first of its order counting 1 and the others 0."""
    flagged = with_first_flag(S.cargo_lines(table(spark, sf_dir, "lineitem")), "order_id", ["ts", "id"], "counted")
    return flagged.select(
        "order_id", F.col("id.l_linenumber").alias("line"), "cargo_type", "counted"
    )


def _order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.order_events(
        ev.order_changes(S.order_log(table(spark, sf_dir, "orders"))),
        ev.cargo_changes(S.cargo_log(table(spark, sf_dir, "lineitem"))),
    )


def per_order(events: DataFrame) -> DataFrame:
    """Events summed per order.

    What an order's lines share is part of the key, so all buffers are numbers.
    """
    totals = events.groupBy("order_id", "event", "sender_name", "estimate_arrive_time").agg(
        F.count("*").alias("line_count"),
        F.sum("weight").cast("double").alias("weight"),
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
        F.min("amount").cast("double").alias("amount"),
    )
    return totals.withColumns(
        {"first_time": timez.local_text("first"), "last_time": timez.local_text("last")}
    ).drop("first", "last")


@query
def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events per cargo line, summed per order."""
    return per_order(_order_events(spark, sf_dir))


@query
def bound_event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inbound, sort and outbound events per organisation and day."""
    totals = (
        ev.bound_events(S.bound_log(table(spark, sf_dir, "lineitem")))
        .groupBy("event", "org_id", timez.day_window("ts").alias("day"))
        .agg(
            F.count("*").alias("event_count"),
            F.min("ts").alias("first"),
            F.sum("emp_id").alias("emp_sum"),
        )
    )
    return totals.select(
        "event",
        "org_id",
        timez.local_date("day.start").alias("cur_date"),
        "event_count",
        timez.local_text("first").alias("first_time"),
        "emp_sum",
    )


@query
def transport_finish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.transport_finishes(S.transport_log(table(spark, sf_dir, "lineitem"))).select(
        F.col("id.l_linenumber").alias("line"),
        "start_org_id",
        "start_org_name",
        "driver1_name",
        "truck_id",
        "truck_no",
        "actual_start_time",
        "actual_end_time",
        "transport_time",
        *[c.alias(n) for n, c in money("actual_distance").items()],
    )


@query
def status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = S.user_steps(spark, sf_dir).select(
        "op", "event_id", "user_id", F.col("before.status").alias("b"), F.col("after.status").alias("a")
    )
    named = steps.withColumn("event", ev.order_event_name("op", "b", "a"))
    return named.filter("event is not null").select("event_id", "user_id", "event")


@query
def null_to_value_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = ev.filled_in("op", F.col("before.value"), F.col("after.value"))
    return S.user_steps(spark, sf_dir).filter(filled).select(
        "event_id", "user_id", F.col("after.value").alias("value")
    )


# --- daily metrics ------------------------------------------------------------------------


def _metric(metric: dws.Metric, detail: DataFrame, dims: dws.Dims, **options) -> DataFrame:
    """A metric without its processing time, sums as doubles."""
    rows = metric.batch(detail, dims, **options).drop("ts")
    sums = [f.name for f in rows.schema if f.dataType.typeName() == "decimal"]
    return rows.withColumns(money(*sums)) if sums else rows


@query
def org_order_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric(
        dws.TRADE_ORG_ORDER_DAY,
        S.first_order_lines(spark, sf_dir, S.senders(spark, sf_dir)),
        S.dims(spark, sf_dir),
        dedup=False,
    )


@query
def cargo_type_order_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").cast(S.MONEY).alias("amount")
    )
    return _metric(
        dws.TRADE_CARGO_TYPE_ORDER_DAY,
        S.first_order_lines(spark, sf_dir, amounts),
        S.dims(spark, sf_dir),
        dedup=False,
    )


def _event_detail(spark: SparkSession, sf_dir: str, event: str) -> DataFrame:
    return _order_events(spark, sf_dir).filter(F.col("event") == event)


def _placed_detail(spark: SparkSession, sf_dir: str, event: str) -> DataFrame:
    """One event's detail rows with the place of their sender."""
    place = ["sender_district_id", "sender_city_id", "sender_province_id"]
    return lookup_join(
        _event_detail(spark, sf_dir, event),
        S.places(spark, sf_dir),
        {"user_id": "c_custkey"},
        {c: c for c in place},
        unique=True,
    )


@query
def dispatch_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = _event_detail(spark, sf_dir, "dispatch")
    return _metric(dws.TRANS_DISPATCH_DAY, detail, dws.Dims())


@query
def bound_finish_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = _event_detail(spark, sf_dir, "bound_finish")
    return _metric(dws.TRANS_BOUND_FINISH_DAY, detail, dws.Dims())


@query
def org_deliver_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = _placed_detail(spark, sf_dir, "deliver_suc")
    return _metric(dws.TRANS_ORG_DELIVER_SUC_DAY, detail, S.dims(spark, sf_dir))


@query
def org_receive_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = _placed_detail(spark, sf_dir, "receive")
    return _metric(dws.TRANS_ORG_RECEIVE_DAY, detail, S.dims(spark, sf_dir))


@query
def org_receive_line_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Received cargo lines rather than orders."""
    detail = _placed_detail(spark, sf_dir, "receive")
    return _metric(dws.TRANS_ORG_RECEIVE_DAY, detail, S.dims(spark, sf_dir), dedup=False)


def _sorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.bound_events(S.bound_log(table(spark, sf_dir, "lineitem"))).filter("event = 'sort'")


@query
def sort_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric(dws.BOUND_ORG_SORT_DAY, _sorts(spark, sf_dir), S.dims(spark, sf_dir))


@query
def truck_model_finish_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric(
        dws.TRANS_ORG_TRUCK_MODEL_TRANS_FINISH_DAY,
        ev.transport_finishes(S.transport_log(table(spark, sf_dir, "lineitem"))),
        S.dims(spark, sf_dir),
    )


@query
def metric_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest of many versions of a daily row."""
    versions = table(spark, sf_dir, "events").select(
        "user_id",
        timez.local_date(F.col("ts").cast("timestamp")).alias("cur_date"),
        F.col("event_id").alias("batch_id"),
        F.col("value").alias("total"),
    )
    return latest_per_key(versions, ["cur_date", "user_id"], ["batch_id"])


# --- change-log envelopes -----------------------------------------------------------------


def _envelope(name: str, op: Column, millis: Column, after: Column, before: Column | None = None) -> Column:
    return F.to_json(
        F.struct(
            op.alias("op"),
            millis.alias("ts_ms"),
            F.struct(F.lit(name).alias("table"), F.lit("tms").alias("db")).alias("source"),
            *([before.alias("before")] if before is not None else []),
            after.alias("after"),
        )
    ).alias("value")


def order_lines_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as envelope text: inserts, updates, deletes, snapshot rows, some cut short."""
    key = F.col("o_orderkey")
    op = F.element_at(F.array(*map(F.lit, "cudr")), (key % 4 + 1).cast("int"))
    text = _envelope(
        "order_info",
        op,
        F.unix_millis(F.col("o_orderdate").cast("timestamp")),
        F.struct(
            key.alias("id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").cast(S.MONEY).alias("amount"),
        ),
    )
    lines = table(spark, sf_dir, "orders").select(key, text)
    cut = F.when(key % 97 == 0, F.substring("value", 1, 40)).otherwise(F.col("value"))
    return lines.select(cut.alias("value"))


@query
def cdc_filter_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = "struct<id:bigint,status:string,amount:decimal(18,2)>"
    changes = live_changes(parse_envelope(order_lines_text(spark, sf_dir), image))
    return changes.select(
        "op",
        "table",
        timez.to_millis("ts").alias("ts"),
        "after.id",
        "after.status",
        F.col("after.amount").cast("double").alias("amount"),
    )


@query
def cdc_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return malformed(order_lines_text(spark, sf_dir)).groupBy("value").agg(
        F.count("*").alias("line_count")
    )


def _customer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _envelope(
            "user_info",
            F.lit("r"),
            F.col("c_custkey"),
            F.struct(
                F.col("c_custkey").alias("id"),
                F.col("c_mktsegment").alias("passwd"),
                F.col("c_name").alias("real_name"),
                _phone("c_custkey").alias("phone_num"),
                _email().alias("email"),
                F.col("c_nationkey").alias("nation"),
            ),
        )
    )


def _org_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        _envelope(
            "base_organ",
            F.lit("c"),
            F.col("s_suppkey"),
            F.struct(
                F.col("s_suppkey").alias("id"),
                F.col("s_name").alias("org_name"),
                F.col("s_nationkey").alias("region_id"),
            ),
        )
    )


def _phone(key: str) -> Column:
    """Phone-like text: some keys give a prefix that is not in use, some a digit too few."""
    digits = (F.lit(13000000000) + F.col(key) * 7919391 % 7000000000).cast("string")
    return F.when(F.col(key) % 11 == 0, F.substring(digits, 1, 10)).otherwise(digits)


def _email() -> Column:
    at = F.when(F.col("c_custkey") % 5 == 0, "#").otherwise("@")
    return F.concat(F.lower("c_mktsegment"), at, F.lit("mail."), text_of("c_custkey"))


def _id_card() -> Column:
    """18 digits whose month runs from 00 to 13."""
    key = F.col("c_custkey")
    month = F.lpad((key % 14).cast("string"), 2, "0")
    day = F.lpad((key % 33).cast("string"), 2, "0")
    check = F.when(key % 3 == 0, "X").otherwise("5")
    return F.concat(F.lit("1101011990"), month, day, F.lpad((key % 1000).cast("string"), 3, "0"), check)


def text_of(column: str) -> Column:
    return F.col(column).cast("string")


@query
def cdc_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixed change log: only two of its tables are kept."""
    mixed = (
        order_lines_text(spark, sf_dir)
        .unionByName(_customer_text(spark, sf_dir))
        .unionByName(_org_text(spark, sf_dir))
    )
    changes = route(live_changes(parse_envelope(mixed, "struct<id:bigint>")), "order_info", "base_organ")
    return changes.groupBy("table", "op").agg(
        F.count("*").alias("change_count"), F.sum("after.id").alias("id_sum")
    )


@query
def ods_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operational topic, written, read back and parsed."""
    root = session.work_dir(spark, "ods")
    mixed = order_lines_text(spark, sf_dir).unionByName(_customer_text(spark, sf_dir))
    save_topics(ods.ods_rows(mixed).drop("table"), root)
    changes = parse_envelope(load_topic(spark, root, "tms_ods").select("key", "value"), "struct<id:bigint>")
    return changes.groupBy("table", "op").agg(
        F.count("*").alias("change_count"),
        F.sum("after.id").alias("id_sum"),
        F.sum(F.col("key").cast("bigint")).alias("key_sum"),
        F.min(timez.to_millis("ts")).alias("min_ts"),
    )


@query
def dwd_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfer events to their three topics, and back with the fields of one."""
    root = session.work_dir(spark, "dwd")
    save_topics(ev.bound_messages(ev.bound_events(S.bound_log(table(spark, sf_dir, "lineitem")))), root)
    fields = F.from_json("value", "org_id bigint, sort_time string")
    is_sort = F.col("topic") == "tms_dwd_bound_sort"
    return (
        spark.read.parquet(root)
        .select("topic", F.when(is_sort, fields).alias("sort"))
        .groupBy("topic")
        .agg(
            F.count("*").alias("row_count"),
            F.sum("sort.org_id").alias("org_sum"),
            F.max("sort.sort_time").alias("last_time"),
        )
    )


@query
def order_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events to their eight topics."""
    root = session.work_dir(spark, "orders")
    save_topics(ev.order_messages(_order_events(spark, sf_dir)), root)
    return (
        spark.read.parquet(root)
        .groupBy("topic")
        .agg(
            F.count("*").alias("row_count"),
            F.sum(F.get_json_object("value", "$.order_id").cast("bigint")).alias("order_sum"),
            F.min(F.get_json_object("value", "$.ts").cast("bigint")).alias("min_ts"),
            F.max(
                F.coalesce(
                    *[
                        F.get_json_object("value", f"$.{field}")
                        for _, field in ev.ORDER_TOPICS.values()
                    ]
                )
            ).alias("last_time"),
        )
    )


# --- masking ------------------------------------------------------------------------------


@query
def mask_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        masking.mask_name("c_name").alias("name"),
        masking.mask_name("c_mktsegment").alias("segment"),
    )


@query
def md5_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", masking.md5_hex("c_name").alias("hash")
    )


@query
def valid_hash_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        masking.phone_hash(_phone("c_custkey")).alias("phone"),
        masking.id_card_hash(_id_card()).alias("id_card"),
        masking.email_hash(_email()).alias("email"),
    )


# --- dimensions ---------------------------------------------------------------------------

USER_DIM = DimConfig("user_info", "dim_user_info", "id,passwd,real_name,phone_num,email")
ORG_DIM = DimConfig("base_organ", "dim_base_organ", "id,org_name")


def _dim_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = _customer_text(spark, sf_dir).unionByName(_org_text(spark, sf_dir))
    return live_changes(parse_envelope(mixed))


def _config(spark: SparkSession, *rows: DimConfig) -> DataFrame:
    values = [
        (r.source_table, r.sink_table, r.sink_columns, r.primary_key, r.sink_extend, r.foreign_keys)
        for r in rows
    ]
    from waybill.schemas import DIM_CONFIG

    return spark.createDataFrame(values, DIM_CONFIG)


@query
def mask_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_rows(_dim_changes(spark, sf_dir), USER_DIM)


@query
def dim_prune_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users have no config row and are dropped; ``region_id`` is not a wanted column."""
    routed = route_by_config(_dim_changes(spark, sf_dir), _config(spark, ORG_DIM))
    return routed.select(
        "sink_table",
        F.col("data")["id"].alias("id"),
        F.col("data")["org_name"].alias("org_name"),
        F.array_join(F.array_sort(F.map_keys("data")), ",").alias("columns"),
    )


@query
def dim_latest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User rows changed by events, applied in two batches, compacted in between."""
    dim = DimConfig("user_state", "dim_user_state", "id,event_type,event_id")
    tables = DimTables(spark, session.work_dir(spark, "dim"))
    e = table(spark, sf_dir, "events")
    changes = e.select(
        F.lit("u").alias("op"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("user_state").alias("table"),
        F.create_map(
            F.lit("id"), text_of("user_id"),
            F.lit("event_type"), F.col("event_type"),
            F.lit("event_id"), text_of("event_id"),
        ).alias("after"),
    )
    early = F.date_format("ts", "dd") < "16"
    config = _config(spark, dim)
    apply_dim_changes(tables, changes.filter(early), config, 0, compact_every=1)
    apply_dim_changes(tables, changes.filter(~early), config, 1)
    return tables.read(dim)


@query
def dim_tie_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as changes of one time: the place in the log decides."""
    dim = DimConfig("order_state", "dim_order_state", "id,part,line")
    tables = DimTables(spark, session.work_dir(spark, "dim-tie"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.lit("u").alias("op"),
        F.timestamp_seconds(F.col("l_orderkey") % 3).alias("ts"),
        F.concat(F.lit("bin.1/"), F.lpad(((F.col("l_partkey") * 7919) % 100003 * 10 + F.col("l_linenumber")).cast("string"), 20, "0")).alias("position"),
        F.lit("order_state").alias("table"),
        F.create_map(
            F.lit("id"), text_of("l_orderkey"),
            F.lit("part"), text_of("l_partkey"),
            F.lit("line"), text_of("l_linenumber"),
        ).alias("after"),
    )
    apply_dim_changes(tables, rows, _config(spark, dim), 0)
    return tables.read(dim)


@query
def lookup_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders to customers by primary key; every row of the left side once."""
    customer = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lookup_join(
        o, customer, {"o_custkey": "c_custkey"}, {"c_name": "user_name"}, unique=True
    )


@query
def lookup_nonpk_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers to one of many organisations of their nation."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("c"), text_of("c_nationkey")).alias("district_id")
    )
    return lookup_join(
        c,
        S.organ(spark, sf_dir),
        {"district_id": "region_id"},
        {"id": "org_id", "org_name": "org_name"},
    )


@query
def lookup_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to a part by two columns ANDed; most have none."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), "p_size", "p_brand", "p_name"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("size"),
        F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 40).cast("string")).alias("brand"),
    )
    return lookup_join(
        lines, part, {"size": "p_size", "brand": "p_brand"}, {"id": "part_id", "p_name": "part_name"}
    )


@query
def parent_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    org = S.organ(spark, sf_dir)
    return org_city(org.select(F.col("id").alias("org_id")), org)


@query
def region_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("c"), text_of("c_nationkey")).alias("city_id")
    )
    return region_climb(c, S.nation_region(spark, sf_dir))


# --- time ---------------------------------------------------------------------------------


@query
def time_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    e = table(spark, sf_dir, "events").select(
        "event_id", S.iso(ts).alias("iso"), F.unix_millis(ts).alias("millis")
    )
    instant = timez.iso_instant("iso")
    local = timez.local_millis_instant("millis")
    return e.select(
        "event_id",
        "iso",
        timez.to_millis(instant).alias("ts"),
        timez.local_text(instant).alias("local_time"),
        timez.local_date(instant).alias("local_day"),
        timez.local_compact_date(instant).alias("partition_day"),
        timez.to_millis(local).alias("clock_ts"),
        timez.local_text(local).alias("clock_time"),
        timez.duration_millis(local, instant).alias("difference"),
        timez.to_millis(timez.date_instant(timez.local_date(instant))).alias("day_start"),
    )
