import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F
from util import BASE, cargo, envelope, lines, order, rows

from waybill.operators import events as ev
from waybill.plans import dwd
from waybill.sources.changelog import by_row_id, live_changes, parse_envelope, typed


def details(spark, *texts):
    return rows(dwd.order_details(lines(spark, *texts)).select("event", "id"))


def status(spark, before, after):
    df = spark.createDataFrame([(before, after)], "b string, a string")
    return df.select(ev.status_event(F.col("b"), F.col("a"))).first()[0]


@pytest.mark.parametrize(
    "before, after, event",
    [
        ("60010", "60020", "pay_suc"),
        ("60020", "60030", "receive"),
        ("60030", "60040", None),
        ("60040", "60050", "dispatch"),
        ("60050", "60060", "bound_finish"),
        ("60060", "60070", "deliver_suc"),
        ("60070", "60080", "sign"),
        ("60020", "60999", "cancel"),
        ("60999", "60999", None),
        ("60020", "60020", None),
        ("60010", "60030", None),
    ],
)
def test_status_event(spark, before, after, event):
    assert status(spark, before, after) == event


def test_placed_order_meets_early_and_slightly_late_lines(spark):
    got = details(
        spark,
        envelope("order_cargo", "c", 0, cargo("early", "1")),
        envelope("order_info", "c", 10_000, order("1", "60010")),
        envelope("order_cargo", "c", 14_999, cargo("soon", "1")),
        envelope("order_cargo", "c", 16_000, cargo("late", "1")),
        envelope("order_cargo", "c", 10_000, cargo("other", "2")),
    )
    assert got == [("order", "early"), ("order", "soon")]


def test_cancel_emits_each_line_then_silence(spark):
    got = details(
        spark,
        envelope("order_cargo", "c", 0, cargo("a", "1")),
        envelope("order_cargo", "c", 0, cargo("b", "1")),
        envelope("order_info", "u", 1000, order("1", "60999"), order("1", "60020")),
        envelope("order_info", "u", 2000, order("1", "60020"), order("1", "60010")),
        envelope("order_cargo", "c", 3000, cargo("c", "1")),
        envelope("order_info", "u", 4000, order("1", "60030"), order("1", "60020")),
    )
    assert got == [("cancel", "a"), ("cancel", "b"), ("receive", "c")]


def test_snapshot_rows_and_deletes_are_no_events(spark):
    got = details(
        spark,
        envelope("order_cargo", "c", 0, cargo("a", "1")),
        envelope("order_cargo", "r", 0, cargo("b", "1")),
        envelope("order_info", "r", 1000, order("1", "60010")),
        envelope("order_info", "d", 2000, None, order("1", "60010")),
        "{broken",
        "",
    )
    assert got == []


def test_merged_row(spark):
    df = dwd.order_details(
        lines(
            spark,
            envelope("order_cargo", "c", 0, cargo("a", "1", created="2023-01-10T16:30:00Z")),
            envelope("order_info", "c", 0, order("1", "60010")),
            envelope("order_info", "u", 9000, order("1", "60020"), order("1", "60010")),
        )
    )
    placed, paid = (r.asDict() for r in df.orderBy("event").collect())
    assert placed["event_time"] == "2023-01-11 00:30:00"  # the line's creation
    assert paid["event_time"] == "2023-01-11 22:30:00"  # the order's update
    assert paid["ts"] == dt.datetime(2023, 1, 11, 14, 30)
    assert (paid["sender_name"], paid["receiver_name"]) == ("李**", "李")
    assert paid["estimate_arrive_time"] == "2023-01-10 14:30:00"
    assert (paid["volume_length"], float(paid["weight"]), paid["status"]) == (3, 1.25, "60020")


def test_messages_carry_the_event_time_name_and_come_back(spark):
    df = dwd.order_details(
        lines(
            spark,
            envelope("order_cargo", "c", 0, cargo("a", "1")),
            envelope("order_info", "u", 9000, order("1", "60020"), order("1", "60010")),
        )
    )
    message = ev.order_messages(df).first()
    assert message.topic == "tms_dwd_trade_pay_suc_detail"
    assert '"pay_time":"2023-01-11 22:30:00"' in message.value
    assert f'"ts":{1673447400000}' in message.value
    back = ev.parse_detail(ev.order_messages(df), ev.ORDER_EVENT.replace("event_time", "pay_time"))
    assert rows(back.select("id", "pay_time", "amount", "ts")) == rows(
        df.select("id", F.col("event_time").alias("pay_time"), "amount", "ts")
    )


def bound(sort=None, outbound=None):
    return {
        "id": "1",
        "order_id": "o",
        "org_id": "g",
        "inbound_time": "1673361000000",
        "inbound_emp_id": "e1",
        "sort_time": sort,
        "sorter_emp_id": "e2",
        "outbound_time": outbound,
        "outbound_emp_id": "e3",
    }


def test_bound_events(spark):
    got = dwd.bound_details(
        lines(
            spark,
            envelope("order_org_bound", "c", 0, bound()),
            envelope("order_org_bound", "u", 1, bound("1673361060000", "1673361120000"), bound()),
            envelope("order_org_bound", "u", 2, bound("1673361099999"), bound("1673361060000")),
            envelope("order_org_bound", "r", 3, bound("1673361060000")),
        )
    )
    assert rows(got.select("event", "event_time", "emp_id")) == [
        ("inbound", "2023-01-10 14:30:00", "e1"),
        ("outbound", "2023-01-10 14:32:00", "e3"),
        ("sort", "2023-01-10 14:31:00", "e2"),
    ]
    topics = {r.topic: r.value for r in ev.bound_messages(got).collect()}
    assert set(topics) == {"tms_dwd_bound_inbound", "tms_dwd_bound_sort", "tms_dwd_bound_outbound"}
    assert '"sorter_emp_id":"e2"' in topics["tms_dwd_bound_sort"]


def test_transport_finish(spark):
    task = {
        "id": "1", "start_org_id": "g", "start_org_name": "G", "driver1_name": "张三",
        "driver2_name": None, "truck_id": "t", "truck_no": "A1", "order_num": 2,
        "actual_start_time": "1673361000000", "actual_distance": 12.5,
    }
    done = task | {"actual_end_time": "1673364600000"}
    got = dwd.transport_details(
        lines(
            spark,
            envelope("transport_task", "u", 0, done, task),
            envelope("transport_task", "u", 0, done, done),
            envelope("transport_task", "c", 0, done),
            envelope("transport_task", "u", 0, task, task),
        )
    ).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.driver1_name, row.driver2_name) == ("张*", None)
    assert row.truck_no == hashlib.md5(b"A1").hexdigest()
    assert (row.transport_time, row.actual_end_time) == (3600000, "2023-01-10 15:30:00")
    assert row.ts == dt.datetime(2023, 1, 10, 7, 30)


def test_envelope_parsing(spark):
    df = lines(spark, envelope("t", "u", 5, {"id": 7, "x": 1.50}, {"id": 7}), "nonsense", "[1]")
    parsed = live_changes(parse_envelope(df))
    row = parsed.select("op", "table", F.unix_millis("ts").alias("ts"), *typed(F.col("after"), "id int, x decimal(9,2), y string")).first()
    assert (row.op, row.table, row.ts, row.id, str(row.x), row.y) == ("u", "t", BASE + 5, 7, "1.50", None)
    assert parsed.count() == 1
    assert by_row_id(parsed, 3).rdd.getNumPartitions() == 3
