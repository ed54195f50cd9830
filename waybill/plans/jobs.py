"""The jobs by name. ``python -m waybill.plans.jobs <job> --name value ...``"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from waybill import session
from waybill.config import JobConfig
from waybill.operators.events import parse_detail
from waybill.plans import dwd, dws, ods
from waybill.plans.dws import Dims, Metric
from waybill.schemas import ODS_TOPIC
from waybill.sources.changelog import read_change_source
from waybill.sources.dims import live_dims, read_config, read_dims
from waybill.sources.topics import read_topic
from waybill.streaming.dims import start_dim_sink
from waybill.streaming.sinks import write_metric, write_topics


def run_ods(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    """Facts and dimensions, unless ``start-up-options`` names one of them."""
    wanted = config.get("start-up-options")
    options = (wanted,) if wanted else ("dwd", "realtime_dim")
    if config.get("change-log"):
        rows = ods.ods_rows(read_change_source(spark, config), options)
    else:  # a topic is read from different positions
        rows = None
        for option in options:
            lines = read_change_source(spark, config, ods.source_tables(option)[1])
            part = ods.ods_rows(lines, (option,))
            rows = part if rows is None else rows.unionByName(part)
    return write_topics(rows, config, "ods")


def run_dim(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    values = read_topic(spark, config, ODS_TOPIC, "tms_dim_sink_app")
    return start_dim_sink(values, lambda: read_config(spark, config), config, "dim_sink")


def _dwd(name: str, group_id: str, messages: Callable) -> Callable:
    def run(spark: SparkSession, config: JobConfig) -> StreamingQuery:
        values = read_topic(spark, config, ODS_TOPIC, group_id)
        return write_topics(messages(values, config), config, name)

    return run


def _dws(metric: Metric) -> Callable:
    def run(spark: SparkSession, config: JobConfig) -> StreamingQuery:
        def dims() -> Dims:
            return read_dims(spark, config) if metric.uses_dims else Dims()

        values = read_topic(spark, config, metric.topic, metric.table)
        detail = parse_detail(values, wire_ddl(metric))
        live = Dims()
        if metric.keyed_by_dims:
            snapshot = config["lookups"] == "snapshot"
            live = dims() if snapshot else live_dims(spark, config, config.number("count-salts"))
        options = {"salts": config.number("count-salts")} if metric.counts_orders else {}
        totals = metric.stream(detail, live, **options)
        return write_metric(totals, lambda b: metric.finish(b, dims()), config, metric.table)

    return run


def wire_ddl(metric: Metric) -> str:
    """The metric's detail row with the field names its topic uses."""
    return metric.ddl.replace("event_time string", f"{metric.time_field} string")


JOBS: dict[str, Callable[[SparkSession, JobConfig], StreamingQuery]] = {
    "ods": run_ods,
    "dim_sink": run_dim,
    "dwd_order_relevant": _dwd(
        "dwd_order_relevant",
        "dwd_order_relevant_app",
        lambda v, c: dwd.order_topics(v, c.number("line-salts")),
    ),
    "dwd_bound_relevant": _dwd(
        "dwd_bound_relevant", "dwd_bound_relevant_app", lambda v, c: dwd.bound_topics(v)
    ),
    "dwd_trans_trans_finish": _dwd(
        "dwd_trans_trans_finish", "dwd_trans_trans_finish", lambda v, c: dwd.transport_topic(v)
    ),
    **{name: _dws(metric) for name, metric in dws.ALL.items()},
}


def main(args: list[str]) -> None:
    if not args or args[0] not in JOBS:
        raise SystemExit(f"usage: jobs <{'|'.join(JOBS)}> --name value ...")
    config = JobConfig.from_args(args[1:])
    spark = session.use_rocksdb(session.build(args[0]))
    if config.get("checkpoint-root") is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if base:
            config["checkpoint-root"] = f"{base}/waybill"
    if config.get("state-partitions"):  # kept by a checkpoint for life
        spark.conf.set("spark.sql.shuffle.partitions", config.number("state-partitions"))
    JOBS[args[0]](spark, config).awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
