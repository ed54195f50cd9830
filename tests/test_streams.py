import datetime as dt

import pytest
from pyspark.sql import functions as F
from util import BASE, cargo, envelope, order, rows

from waybill.config import JobConfig
from waybill.operators import events as ev
from waybill.operators.routing import DimConfig
from waybill.plans import dwd, dws, jobs
from waybill.schemas import DIM_CONFIG, METRICS
from waybill.sources.changelog import live_changes, parse_envelope, read_changes, route
from waybill.streaming.order_events import order_events_stream, placed_orders_join
from waybill.streaming.sinks import latest_metric, metric_table, write_metric

AT = dt.datetime(2023, 1, 10, 3)


class Feed:
    """A folder that receives one file per step."""

    def __init__(self, path):
        self.path, self.step = path, 0
        path.mkdir(parents=True)

    def add(self, *texts):
        # Written under a name the stream skips, then renamed, as it may be listing.
        part = self.path / f"_{self.step}"
        part.write_text("\n".join(texts) + "\n", encoding="utf8")
        part.rename(self.path / f"{self.step}.txt")
        self.step += 1


def config(tmp_path, **more):
    return JobConfig(
        trigger="0 seconds",
        metric_root=str(tmp_path / "metric"),
        checkpoint_root=str(tmp_path / "checkpoint"),
        **more,
    )


def detail(spark, feed, schema):
    return spark.readStream.schema(schema).option("header", "false").csv(str(feed.path))


def run_metric(spark, tmp_path, metric, schema, steps, dims=dws.Dims(), **options):
    """Totals after feeding ``steps`` one file each, and all versions on the way."""
    feed, cfg = Feed(tmp_path / "in"), config(tmp_path)
    totals = metric.stream(detail(spark, feed, schema), dims, **options)
    q = write_metric(totals, lambda b: metric.finish(b, dims), cfg, metric.table)
    try:
        for step in steps:
            feed.add(*step)
            q.processAllAvailable()
        dropped = sum(
            s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"]
        )
    finally:
        q.stop()
    root = str(tmp_path / "metric")
    versions = metric_table(spark, root, metric.table).versions().count()
    return rows(latest_metric(spark, root, metric.table).drop("ts")), versions, dropped


def sorts(*moments):
    return [f"g,{(AT + m).isoformat()}Z" for m in moments]


def organs(spark):
    return dws.Dims(
        organ=spark.createDataFrame(
            [("g", "G", None, "c")], "id string, org_name string, org_parent_id string, region_id string"
        ),
        region=spark.createDataFrame(
            [("c", "City", "p"), ("p", "Province", None)], "id string, name string, parent_id string"
        ),
    )


def test_early_results_and_late_rows(spark, tmp_path):
    hour = dt.timedelta(hours=1)
    got, versions, dropped = run_metric(
        spark,
        tmp_path,
        dws.BOUND_ORG_SORT_DAY,
        "org_id string, ts timestamp",
        [
            sorts(0 * hour, hour),
            sorts(2 * hour),  # the running total is refreshed
            sorts(40 * hour),  # closes the first day
            sorts(45 * hour),
            sorts(3 * hour),  # too late for it
        ],
        organs(spark),
    )
    names = ("g", "G", "c", "City", "p", "Province")
    assert got == [("2023-01-10", *names, 3), ("2023-01-12", *names, 2)]
    assert (versions, dropped) == (4, 1)


@pytest.mark.parametrize("salts", [1, 16])
def test_orders_count_once_across_batches(spark, tmp_path, salts):
    def line(id, order_id, minutes):
        return f"{id},{order_id},{(AT + dt.timedelta(minutes=minutes)).isoformat()}Z"

    got, _, _ = run_metric(
        spark,
        tmp_path,
        dws.TRANS_DISPATCH_DAY,
        "id string, order_id string, ts timestamp",
        [
            [line(i, "1", 0) for i in range(20)] + [line("x", "2", 1)],
            [line("y", "1", 2), line("z", "3", 2)],
        ],
        salts=salts,
    )
    assert got == [("2023-01-10", 3)]


STEPS = [
    [
        envelope("order_cargo", "c", 0, cargo("early", "1")),
        envelope("order_info", "c", 10_000, order("1", "60010")),
        envelope("order_info", "c", 10_000, order("2", "60010")),
    ],
    [
        envelope("order_cargo", "c", 14_000, cargo("soon", "1")),
        envelope("order_cargo", "c", 16_000, cargo("late", "1")),
    ],
    [
        envelope("order_info", "u", 20_000, order("1", "60020"), order("1", "60010")),
        envelope("order_cargo", "c", 30_000, cargo("far", "2")),
    ],
    [envelope("order_info", "u", 40_000, order("1", "60999"), order("1", "60020"))],
    [
        envelope("order_cargo", "c", 50_000, cargo("new", "1")),
        envelope("order_info", "u", 60_000, order("1", "60020"), order("1", "60010")),
        envelope("order_info", "u", 70_000, order("2", "60020"), order("2", "60010")),
    ],
]


def changes_of(ods):
    changes = live_changes(parse_envelope(ods, f"struct<{dwd._ddl(dwd.ORDER_INFO)}>"))
    lines = live_changes(parse_envelope(ods, f"struct<{dwd._ddl(dwd.ORDER_CARGO)}>"))
    return ev.order_changes(route(changes, "order_info")), ev.cargo_changes(route(lines, "order_cargo"))


def run_events(spark, tmp_path, build, steps):
    feed = Feed(tmp_path / "in")
    q = (
        build(*changes_of(read_changes(spark, str(feed.path), stream=True)))
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .start(str(tmp_path / "out"))
    )
    try:
        for step in steps:
            feed.add(*step)
            q.processAllAvailable()
    finally:
        q.stop()
    return rows(spark.read.parquet(str(tmp_path / "out")))


@pytest.mark.parametrize("options", [{"salts": 1}, {"salts": 3}, {"delay": "1 hour"}])
def test_order_events_stream_equals_batch(spark, tmp_path, options):
    texts = spark.createDataFrame([(t,) for step in STEPS for t in step], "value string")
    want = rows(ev.order_events(*changes_of(texts)))
    got = run_events(spark, tmp_path, lambda o, c: order_events_stream(o, c, **options), STEPS)
    assert got == want
    assert [(r[0], r[1]) for r in got] == [
        ("cancel", "early"), ("cancel", "late"), ("cancel", "soon"),
        ("order", "early"), ("order", "soon"),
        ("pay_suc", "early"), ("pay_suc", "far"), ("pay_suc", "late"), ("pay_suc", "new"), ("pay_suc", "soon"),
    ]


def test_placed_orders_join(spark, tmp_path):
    got = run_events(spark, tmp_path, placed_orders_join, STEPS)
    assert [(r[0], r[1]) for r in got] == [("order", "early"), ("order", "soon")]


def test_jobs_end_to_end(spark, tmp_path):
    """Change log files through all layers to metrics."""
    feed = Feed(tmp_path / "log")
    dims = [
        DimConfig("base_organ", "dim_base_organ", "id,org_name,org_parent_id,region_id"),
        DimConfig("base_region_info", "dim_base_region_info", "id,name,parent_id"),
        DimConfig("base_dic", "dim_base_dic", "id,name"),
        DimConfig("truck_info", "dim_truck_info", "id,truck_model_id,truck_no"),
        DimConfig("truck_model", "dim_truck_model", "id,model_name,model_no"),
    ]
    values = [(d.source_table, d.sink_table, d.sink_columns, None, None, None) for d in dims]
    spark.createDataFrame(values, DIM_CONFIG).write.parquet(str(tmp_path / "config"))
    day = 86_400_000
    trip = {
        "id": "1", "start_org_id": "o1", "start_org_name": "Org", "driver1_name": "张三",
        "truck_id": "t1", "truck_no": "A1", "actual_start_time": str(BASE), "actual_distance": 12.5,
    }
    bound = {"id": "1", "order_id": "1", "org_id": "o1", "inbound_time": str(BASE)}
    statuses = ["60010", "60020", "60030", "60040", "60050", "60060", "60070", "60080"]
    feed.add(
        envelope("base_organ", "r", 0, {"id": "o1", "org_name": "Org", "org_parent_id": None, "region_id": "d1"}),
        envelope("base_region_info", "r", 0, {"id": "c1", "name": "City", "parent_id": "p1"}),
        envelope("base_region_info", "r", 0, {"id": "d1", "name": "District", "parent_id": "c1"}),
        envelope("base_region_info", "r", 0, {"id": "p1", "name": "Province", "parent_id": None}),
        envelope("base_dic", "r", 0, {"id": "t1", "name": "Books"}),
        envelope("truck_info", "r", 0, {"id": "t1", "truck_model_id": "m1", "truck_no": "A1"}),
        envelope("truck_model", "r", 0, {"id": "m1", "model_name": "Big", "model_no": "x"}),
        envelope("order_cargo", "c", 0, cargo("a", "1")),
        envelope("order_cargo", "c", 0, cargo("b", "1")),
        envelope("order_info", "c", 1000, order("1", "60010")),
        *[
            envelope("order_info", "u", 2000 + i * 1000, order("1", new), order("1", old))
            for i, (old, new) in enumerate(zip(statuses, statuses[1:], strict=False))
        ],
        envelope("order_org_bound", "c", 0, bound),
        envelope("order_org_bound", "u", 1, bound | {"sort_time": str(BASE + day)}, bound),
        envelope("transport_task", "u", 0, trip | {"actual_end_time": str(BASE + 3_600_000)}, trip),
        envelope("order_info", "d", 9000, None, order("1", "60080")),
        "not json",
    )
    common = dict(
        checkpoint_root=str(tmp_path / "checkpoint"),
        trigger="available-now",
        change_log=str(tmp_path / "log"),
        dim_root=str(tmp_path / "dim"),
        config_path=str(tmp_path / "config"),
        metric_root=str(tmp_path / "metric"),
        topic_root=str(tmp_path / "topic"),
    )
    for name in jobs.JOBS:  # listed layer by layer
        config = JobConfig(**common)
        if name in ("dws_trans_dispatch_day", "dws_trans_bound_finish_day"):  # no names in them
            del config["dim-root"]
        jobs.JOBS[name](spark, config).awaitTermination()

    def metric(name):
        df = latest_metric(spark, str(tmp_path / "metric"), name)
        assert df.columns == METRICS[name]
        return [tuple(str(v) for v in r) for r in rows(df.drop("ts"))]

    order_day, org = "2023-01-10", ("o1", "Org", "c1", "City")
    assert metric("dws_trade_org_order_day") == [(order_day, *org, "10.50", "1")]
    assert metric("dws_trade_cargo_type_order_day") == [(order_day, "t1", "Books", "10.50", "1")]
    assert metric("dws_trans_dispatch_day") == [("2023-01-11", "1")]
    assert metric("dws_trans_bound_finish_day") == [("2023-01-11", "1")]
    for name in ("dws_trans_org_receive_day", "dws_trans_org_deliver_suc_day"):
        assert metric(name) == [("2023-01-11", *org, "p1", "Province", "1")]
    assert metric("dws_bound_org_sort_day") == [
        ("2024-01-02", "o1", "Org", "d1", "District", "c1", "City", "1")
    ]
    assert metric("dws_trans_org_truck_model_trans_finish_day") == [
        ("2024-01-01", "o1", "Org", "m1", "Big", "d1", "District", "1", "12.50", "3600000")
    ]


def test_config_arguments():
    cfg = JobConfig.from_args(["--bootstrap-severs", "h:1", "--topic=t", "--trigger", "1 minute"])
    assert (cfg["bootstrap-servers"], cfg["topic"], cfg["trigger"]) == ("h:1", "t", "1 minute")
    with pytest.raises(ValueError):
        JobConfig.from_args(["--topic"])
    with pytest.raises(ValueError):
        cfg.need("dim-root")


def test_kafka_options():
    from waybill.sources.topics import kafka_sink, kafka_source

    source = kafka_source(JobConfig(bootstrap_servers="h:1"), "t", "g")
    assert (source["subscribe"], source["startingOffsets"], source["kafka.group.id"]) == ("t", "latest", "g")
    assert "topic" not in kafka_sink(JobConfig())
    with pytest.raises(ValueError):
        kafka_source(JobConfig(), "", "g")


def test_topic_values_skip_empty(spark):
    from waybill.sources.topics import topic_values

    df = spark.createDataFrame([(b"a",), (b"",), (None,)], "value binary")
    assert rows(topic_values(df)) == [("a",)]
    assert rows(topic_values(df.select(F.lit("x").alias("k"), "value"))) == [("a",)]
