"""Hand-written change logs."""

import json

BASE = 1704067200000  # 2024-01-01T00:00:00Z


def envelope(table, op, at, after, before=None):
    """One change-log line; ``at`` is milliseconds after BASE."""
    return json.dumps(
        {
            "op": op,
            "ts_ms": BASE + at,
            "source": {"table": table, "ts_ms": BASE},
            "before": before,
            "after": after,
        },
        ensure_ascii=False,
    )


def order(id, status, updated="2023-01-11T14:30:00Z", **more):
    return {
        "id": id,
        "order_no": f"no{id}",
        "status": status,
        "sender_name": "李依依",
        "receiver_name": "李",
        "sender_district_id": "d1",
        "sender_city_id": "c1",
        "sender_province_id": "p1",
        "amount": 10.5,
        "cargo_num": 2,
        "estimate_arrive_time": 1673361000000,
        "distance": 3.25,
        "create_time": "2023-01-10T14:30:00Z",
        "update_time": updated,
    } | more


def cargo(id, order_id, created="2023-01-10T14:30:00Z", **more):
    return {
        "id": id,
        "order_id": order_id,
        "cargo_type": "t1",
        "volumn_length": 3,
        "weight": 1.25,
        "create_time": created,
    } | more


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
