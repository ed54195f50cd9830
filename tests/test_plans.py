"""The physical plans the operators are written for."""

import contextlib
import os
import re

import pytest
from pyspark.sql import functions as F
from util import rows

import __spark_entry__ as driver
from waybill.catalogue import standins as S
from waybill.operators import events as ev
from waybill.operators.first import with_first_flag

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no benchmark tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def conf(spark, **settings):
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@needs_tables
@pytest.mark.parametrize("name", sorted(n for n in driver.queries() if not n.startswith("stream")))
def test_no_pairing_of_everything(spark, name):
    text = plan(driver.queries()[name](spark, SF))
    assert not re.search("Cartesian|NestedLoop|BatchEvalPython|ArrowEvalPython", text)


@needs_tables
def test_first_per_order_is_limited_before_the_shuffle(spark):
    text = plan(driver.queries()["first_line_per_order"](spark, SF))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert text.count("Exchange") == 1


@needs_tables
def test_scans_read_the_columns_used(spark):
    text = plan(driver.queries()["org_order_day"](spark, SF))
    scans = [re.sub(r"#\d+L?", "", s) for s in re.findall(r"FileScan parquet \[([^\]]*)\]", text)]
    assert {"o_orderkey,o_custkey,o_totalprice", "c_custkey,c_nationkey"} <= set(scans)


@needs_tables
def test_names_are_looked_up_on_the_totals(spark):
    text = plan(driver.queries()["sort_day"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("BroadcastHashJoin") < text.index("HashAggregate")


@needs_tables
@pytest.mark.parametrize("name", ["org_order_day", "org_deliver_day", "region_chain", "lookup_composite"])
def test_large_dimensions_are_shuffled_with_equal_results(spark, name):
    query = driver.queries()[name]
    small = rows(query(spark, SF))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        df = query(spark, SF)
        assert "BroadcastHashJoin" not in plan(df)
        assert rows(df) == small


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__shuffle__partitions": "16",
}


@needs_tables
def test_a_hot_order_is_split(spark):
    """Two thirds of the lines belong to one order; results and plans hold."""
    lines = S.table(spark, SF, "lineitem").repartition(8)
    hot = F.when(F.xxhash64(*S.LINE) % 3 != 0, F.lit(7)).otherwise(F.col("l_orderkey"))
    lines = lines.withColumn("l_orderkey", hot.cast("bigint"))
    orders = ev.order_changes(S.order_log(S.table(spark, SF, "orders")))

    def per_order():
        events = ev.order_events(orders, ev.cargo_changes(S.cargo_log(lines)))
        return events.groupBy("order_id", "event").agg(F.count("*"), F.sum("weight"))

    def flags():
        return with_first_flag(S.cargo_lines(lines), "order_id", ["ts", "id"], "n").select("order_id", "n")

    for build in (per_order, flags):
        want = rows(build())
        with conf(spark, **SKEW):
            df = build()
            assert rows(df) == want
            assert "skew=true" in plan(df)
