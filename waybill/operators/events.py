"""Row changes to business events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import timez
from waybill.functions.masking import mask_name, md5_hex
from waybill.operators.history import last_before
from waybill.operators.skew import split_join
from waybill.schemas import BOUND_TOPICS, MONEY, ORDER_EVENT, ORDER_TOPICS, columns

# Status change -> event. Any other change to CANCELLED is a cancel,
# any other change at all is no event.
TRANSITIONS = {
    "60010 -> 60020": "pay_suc",
    "60020 -> 60030": "receive",
    "60040 -> 60050": "dispatch",
    "60050 -> 60060": "bound_finish",
    "60060 -> 60070": "deliver_suc",
    "60070 -> 60080": "sign",
}
CANCELLED = "60999"
# After these an order changes no more and its cargo lines are forgotten.
CLOSING = ["sign", "cancel"]
# How long after its order a cargo line may still arrive to be part of the placed order.
ORDER_TTL = "5 seconds"


def status_event(before: Column, after: Column) -> Column:
    """The event of a status change, null when it is none."""
    event = F.when((after == CANCELLED) & (before != after), F.lit("cancel"))
    change = F.concat(before, F.lit(" -> "), after)
    for transition, name in reversed(TRANSITIONS.items()):
        event = F.when(change == transition, F.lit(name)).otherwise(event)
    return event


def order_event_name(op, before_status, after_status) -> Column:
    """``order`` for an insert, the status event for an update, else null."""
    return F.when(F.col(op) == "c", F.lit("order")).when(
        F.col(op) == "u", status_event(F.col(before_status), F.col(after_status))
    )


def filled_in(op: str, before: Column, after: Column) -> Column:
    """An update that sets a field which was empty."""
    return (F.col(op) == "u") & before.isNull() & after.isNotNull()


def order_changes(changes: DataFrame) -> DataFrame:
    """``order_info`` envelopes to rows ``event, at, <order fields>``; other changes dropped.

    ``at`` is when the change was captured. Names are masked here, before any row moves.
    """
    flat = changes.select(
        F.col("op"),
        F.col("ts").alias("at"),
        F.col("before.status").alias("__old_status"),
        "after.*",
    )
    named = flat.withColumn("event", order_event_name("op", "__old_status", "status"))
    return (
        named.filter(F.col("event").isNotNull())
        .withColumns({n: mask_name(n) for n in ("sender_name", "receiver_name")})
        .withColumnRenamed("id", "order_id")
        .drop("op", "__old_status", "create_time", "is_deleted")
    )


def cargo_changes(changes: DataFrame) -> DataFrame:
    """``order_cargo`` envelopes to the inserted lines, with their capture time ``at``."""
    return (
        changes.filter(F.col("op") == "c")
        .select(F.col("ts").alias("at"), "after.*")
        .drop("update_time", "is_deleted")
    )


def merged_row(cargo: str, order: str) -> list[Column]:
    """Select list of one detail row: a cargo line widened by its order.

    A placed order happens when the line was created, every other event when the order was
    last updated.
    """

    def c(name: str) -> Column:
        return F.col(f"{cargo}.{name}")

    def o(name: str) -> Column:
        return F.col(f"{order}.{name}")

    moment = timez.iso_instant(
        F.when(o("event") == "order", c("create_time")).otherwise(o("update_time"))
    )
    computed = {
        "id": c("id"),
        "order_id": c("order_id"),
        "cargo_type": c("cargo_type"),
        "volume_length": c("volumn_length"),
        "volume_width": c("volumn_width"),
        "volume_height": c("volumn_height"),
        "weight": c("weight"),
        "event_time": timez.local_text(moment),
        "estimate_arrive_time": timez.local_text(
            timez.local_millis_instant(o("estimate_arrive_time"))
        ),
        "ts": moment,
    }
    return [
        o("event").alias("event"),
        *[computed.get(n, o(n)).alias(n) for n in columns(ORDER_EVENT)],
    ]


def order_events(
    orders: DataFrame,
    cargo: DataFrame,
    order_ttl: str | None = ORDER_TTL,
    bucket: Column | None = None,
) -> DataFrame:
    """One row per event and cargo line, from ``order_changes`` and ``cargo_changes``.

    A placed order meets the lines known by then and those arriving within ``order_ttl``
    (``None``: ever). A status event meets the lines known by then. Signing and cancelling
    forget an order's lines, so later changes of it give nothing.

    ``bucket`` splits the history of an order for the look-back to its last closing event;
    by default by day. In the join, adaptive execution splits the lines of a hot order.
    """
    bucket = F.date_trunc("day", F.col("at")) if bucket is None else bucket
    history = last_before(
        orders,
        "order_id",
        ["at", "event"],
        F.col("at"),
        "forgotten_at",
        counts=F.col("event").isin(*CLOSING),
        bucket=bucket,
    )
    c_at, o_at, gone = F.col("r.at"), F.col("l.at"), F.col("l.forgotten_at")
    known = (c_at <= o_at) & (gone.isNull() | (c_at > gone))
    late = (F.col("l.event") == "order") & (c_at > o_at)
    if order_ttl is not None:
        late = late & (c_at <= o_at + F.expr(f"interval {order_ttl}"))
    lines = cargo.filter(F.col("order_id").isNotNull())
    return split_join(history, lines, "order_id", known | late).select(*merged_row("r", "l"))


def bound_events(changes: DataFrame) -> DataFrame:
    """``order_org_bound`` envelopes to inbound, sort and outbound rows in one pass.

    An insert is an inbound event; one update may give both a sort and an outbound event.
    """
    before, after = F.col("before"), F.col("after")
    # Flat columns first: the scan then reads the fields used and not whole images.
    fields = [f for _, time_field, emp_field in BOUND_TOPICS.values() for f in (time_field, emp_field)]
    flat = changes.select(
        "op",
        *[after[c].alias(c) for c in ("id", "order_id", "org_id", *fields)],
        before.isNotNull().alias("__updated"),
        *[before[c].alias(f"__old_{c}") for c in ("sort_time", "outbound_time")],
    )

    def event(name: str) -> Column:
        _, time_field, emp_field = BOUND_TOPICS[name]
        return F.struct(
            F.lit(name).alias("event"),
            F.col(time_field).cast("string").alias("millis"),
            F.col(emp_field).alias("emp_id"),
        )

    sorted_ = filled_in("op", F.col("__old_sort_time"), F.col("sort_time"))
    left = filled_in("op", F.col("__old_outbound_time"), F.col("outbound_time"))
    found = F.when(F.col("op") == "c", F.array(event("inbound"))).when(
        F.col("__updated"),
        F.when(sorted_ & left, F.array(event("sort"), event("outbound")))
        .when(sorted_, F.array(event("sort")))
        .when(left, F.array(event("outbound"))),
    )
    return flat.select("id", "order_id", "org_id", F.inline(found)).select(
        "event",
        "id",
        "order_id",
        "org_id",
        timez.local_text(timez.local_millis_instant("millis")).alias("event_time"),
        "emp_id",
        timez.local_millis_instant("millis").alias("ts"),
    )


def transport_finishes(changes: DataFrame) -> DataFrame:
    """``transport_task`` envelopes to finished trips: the end time was filled in."""
    done = changes.filter(
        F.col("before").isNotNull()
        & filled_in("op", F.col("before.actual_end_time"), F.col("after.actual_end_time"))
    ).select("after.*")
    start = timez.local_millis_instant("actual_start_time")
    end = timez.local_millis_instant("actual_end_time")
    return done.select(
        "id", "shift_id", "line_id", "start_org_id", "start_org_name", "end_org_id",
        "end_org_name", "order_num", "driver1_emp_id",
        mask_name("driver1_name").alias("driver1_name"),
        "driver2_emp_id",
        mask_name("driver2_name").alias("driver2_name"),
        "truck_id",
        md5_hex("truck_no").alias("truck_no"),
        timez.local_text(start).alias("actual_start_time"),
        timez.local_text(end).alias("actual_end_time"),
        timez.duration_millis(start, end).alias("transport_time"),
        F.col("actual_distance").cast(MONEY).alias("actual_distance"),
        end.alias("ts"),
    )


def order_messages(events: DataFrame) -> DataFrame:
    """Detail rows to ``topic, key, value``: JSON text with the event's own time field."""
    rest = [c for c in columns(ORDER_EVENT) if c not in ("event_time", "ts")]
    return _messages(
        events,
        {e: (topic, {"event_time": field}) for e, (topic, field) in ORDER_TOPICS.items()},
        rest,
    )


def bound_messages(events: DataFrame) -> DataFrame:
    """Transfer rows to ``topic, key, value``."""
    return _messages(
        events,
        {
            e: (topic, {"event_time": field, "emp_id": emp})
            for e, (topic, field, emp) in BOUND_TOPICS.items()
        },
        ["id", "order_id", "org_id"],
    )


def transport_messages(events: DataFrame, topic: str) -> DataFrame:
    fields = [c for c in events.columns if c != "ts"]
    value = F.to_json(F.struct(*fields, timez.to_millis("ts").alias("ts")))
    return events.select(F.lit(topic).alias("topic"), F.col("id").alias("key"), value.alias("value"))


def _messages(events: DataFrame, topics: dict, rest: list[str]) -> DataFrame:
    """Null fields are left out of the text, as readers treat both alike."""
    topic, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for event, (name, renames) in topics.items():
        fields = [F.col(c).alias(renames[c]) for c in renames]
        text = F.to_json(F.struct(*rest, *fields, timez.to_millis("ts").alias("ts")))
        is_event = F.col("event") == event
        topic = F.when(is_event, F.lit(name)).otherwise(topic)
        value = F.when(is_event, text).otherwise(value)
    return events.select(topic.alias("topic"), F.col("id").alias("key"), value.alias("value"))


def parse_detail(values: DataFrame, ddl: str, value: str = "value") -> DataFrame:
    """Topic text back to detail rows; ``ts`` arrives as epoch milliseconds."""
    wire = ddl.replace("ts timestamp", "ts bigint")
    return (
        values.select(F.from_json(value, wire).alias("__r"))
        .select("__r.*")
        .withColumn("ts", timez.millis_instant("ts"))
    )
