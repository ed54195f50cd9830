import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from util import rows

from waybill.operators.daily import ROWS, daily_totals
from waybill.operators.first import first_per_key, latest_per_key, with_first_flag
from waybill.operators.history import last_before
from waybill.operators.lookup import lookup_join, org_city, region_climb


def test_first_per_key_is_independent_of_order(spark):
    data = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "n"), (None, 4, "m")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, ts int, id string").repartition(3)
        assert rows(first_per_key(df, ["k"], ["ts", "id"])) == [("a", 1, "y"), (None, 4, "m")]
        assert rows(latest_per_key(df, ["k"], ["ts", "id"])) == [("a", 2, "x"), (None, 5, "n")]
        flagged = rows(with_first_flag(df, "k", ["ts", "id"], "n"))
        assert sorted(r[3] for r in flagged) == [0, 0, 0, 1, 1]
        assert ("a", 1, "y", 1) in flagged and (None, 4, "m", 1) in flagged


@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_last_before_matches_brute_force(spark, width):
    rng = random.Random(1)
    data = [(rng.choice("aab"), t, rng.random() < 0.3, f"v{t}") for t in range(120)]
    data += [(None, 3, True, "n1"), (None, 9, False, "n2")]
    df = spark.createDataFrame(data, "k string, t int, counts boolean, v string")
    bucket = None if width is None else F.floor(F.col("t") / width)
    got = last_before(df, "k", ["t"], F.col("v"), "prev", F.col("counts"), bucket)
    want = []
    for k, t, counts, v in data:
        earlier = [r for r in data if r[0] == k and r[1] < t and r[2]]
        want.append((k, t, counts, v, max(earlier, key=lambda r: r[1])[3] if earlier else None))
    assert rows(got) == sorted(want, key=repr)


def test_last_before_keeps_null_payloads(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 3, "y")], "k string, t int, v string")
    for bucket in (None, F.col("t"), F.lit(0)):
        got = last_before(df, "k", ["t"], F.col("v"), "prev", bucket=bucket)
        assert rows(got.select("t", "prev")) == [(1, None), (2, "x"), (3, None)]


ORG = [
    ("1", "head", None, "c1"),
    ("2", "branch", "1", "d1"),
    ("3", "other branch", "1", "d1"),
    ("4", "lost branch", "99", "d2"),
]
REGION = [("p1", "Province", None), ("c1", "City", "p1"), ("d1", "District", "c1")]


def dims(spark):
    org = spark.createDataFrame(ORG, "id string, org_name string, org_parent_id string, region_id string")
    return org, spark.createDataFrame(REGION, "id string, name string, parent_id string")


def test_lookup_never_changes_row_count(spark):
    org, _ = dims(spark)
    facts = spark.createDataFrame([("d1",), ("d1",), ("d2",), ("d9",), (None,)], "d string")
    got = lookup_join(facts, org, {"d": "region_id"}, {"id": "org_id", "org_name": "name"})
    assert rows(got) == [
        ("d1", "2", "branch"),
        ("d1", "2", "branch"),
        ("d2", "4", "lost branch"),
        ("d9", None, None),
        (None, None, None),
    ]


def test_lookup_by_several_columns(spark):
    org, _ = dims(spark)
    facts = spark.createDataFrame([("d1", "1"), ("d1", "2")], "d string, p string")
    got = lookup_join(facts, org, {"d": "region_id", "p": "org_parent_id"}, {"id": "org_id"})
    assert rows(got) == [("d1", "1", "2"), ("d1", "2", None)]


def test_org_city_uses_the_parent(spark):
    org, region = dims(spark)
    facts = spark.createDataFrame([(i,) for i in ("1", "2", "4", "7", None)], "org_id string")
    got = region_climb(org_city(facts, org), region)
    assert rows(got.select("org_id", "found_org_name", "city_id", "city_name", "province_name")) == [
        ("1", "head", "c1", "City", "Province"),
        ("2", "branch", "c1", "City", "Province"),
        ("4", "lost branch", None, None, None),
        ("7", None, None, None, None),
        (None, None, None, None, None),
    ]


def test_daily_totals_carry_the_first_value(spark):
    at = dt.datetime(2023, 1, 10, 15)
    data = [
        ("k", "late", at + dt.timedelta(minutes=5), 1),
        ("k", "first", at, 2),
        ("k", "next day", at + dt.timedelta(hours=1), 4),
        (None, "none", at, 8),
    ]
    df = spark.createDataFrame(data, "k string, c string, ts timestamp, x int")
    got = daily_totals(df, ["k"], {"total": "x", "n": ROWS}, carried=["c"])
    assert rows(got) == [
        ("2023-01-10", "k", "first", 3, 2),
        ("2023-01-10", None, "none", 8, 1),
        ("2023-01-11", "k", "next day", 4, 1),
    ]
