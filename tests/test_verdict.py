"""Arguments, salts, and tables that are folders of files."""

import json

import pytest
from pyspark.sql import functions as F

from waybill.catalogue import live, standins
from waybill.config import JobConfig
from waybill.operators.lookup import lookup_join
from waybill.plans import dws
from waybill.plans.ods import rename_ts

SF = "/root/testdata/sf0.001"


def test_unknown_arguments_and_small_numbers_are_refused():
    with pytest.raises(ValueError, match="unknown"):
        JobConfig.from_args(["--cuont-salts", "3"])
    with pytest.raises(ValueError, match="at least"):
        JobConfig.from_args(["--count-salts", "0"]).number("count-salts")
    assert JobConfig.from_args(["--state-partitions=12"]).number("state-partitions") == 12


def test_no_salts_are_refused(spark):
    with pytest.raises(ValueError):
        dws.once_per_order(spark.range(1), 0)


def test_messages_without_op_are_kept(spark):
    values = ['{"op":null,"ts_ms":3,"after":{"id":1}}', '{"op":"a\\"b","ts_ms":3}']
    rows = spark.createDataFrame([(v,) for v in values], "value string").select(rename_ts("value"))
    got = [json.loads(r[0]) for r in rows.collect()]
    assert [(g["op"], g["ts"]) for g in got] == [(None, 3), ('a"b', 3)]
    assert got[0]["after"] == {"id": 1}


def test_a_missing_dimension_is_named(spark):
    with pytest.raises(ValueError, match="dimension"):
        lookup_join(spark.range(1), None, {"id": "id"}, {"name": "name"})


def test_streams_read_tables_that_are_folders(spark, tmp_path):
    for name in ("lineitem", "orders", "supplier", "nation", "region", "customer", "part"):
        rows = spark.read.parquet(f"{SF}/{name}.parquet")
        rows.repartition(4).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert standins.table(spark, str(tmp_path), "lineitem").count() > 0

    def found(sf_dir):
        return {tuple(r) for r in live.stream_day_count(spark, sf_dir).select(F.struct("*")).collect()}

    assert found(str(tmp_path)) == found(SF) != set()


def test_renamed_organisation_keeps_its_total(spark, tmp_path):
    """A rename between two runs of one query neither splits the total nor loses counts."""
    ddl = (
        "id string, order_id string, ts timestamp, sender_district_id string, "
        "sender_city_id string, sender_province_id string, amount decimal(38,2)"
    )
    totals = {}

    def run(order, name):
        rows = spark.sql("SELECT timestamp'2024-01-10 02:00:00' AS ts, 10.00 AS amount")
        rows = rows.withColumn("ts", F.col("ts") + F.make_dt_interval(hours=F.lit(int(order))))
        more = {"id": order, "order_id": order, "sender_district_id": "d", "sender_city_id": "c"}
        rows = rows.withColumns({k: F.lit(v) for k, v in more.items()} | {"sender_province_id": F.lit("p")})
        rows.select([F.col(f.name).cast(f.dataType) for f in spark.createDataFrame([], ddl).schema]).write.mode(
            "append"
        ).parquet(str(tmp_path / "in"))
        organ = spark.createDataFrame([("o", name, "d")], "id string, org_name string, region_id string")
        detail = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
        made = dws.TRADE_ORG_ORDER_DAY.stream(detail, dws.Dims(organ=organ))
        query = made.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state"))

        def keep(batch, _):
            for r in batch.collect():
                totals[r.cur_date, r.org_id] = (r.org_name, r.order_count_base, float(r.order_amount_base))

        query.foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()

    run("1", "Old")
    run("2", "New")
    assert list(totals.values()) == [("Old", 2, 20.0)]
