"""Reading dimension and config tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.config import JobConfig
from waybill.operators.routing import CONFIG_COLUMNS, DimConfig, config_rows, current_config
from waybill.plans.dws import Dims
from waybill.schemas import CONFIG_TABLE, ODS_TOPIC
from waybill.sources.changelog import parse_envelope, read_changes
from waybill.sources.topics import read_topic
from waybill.streaming.dims import DimTables
from waybill.streaming.lookups import DimChanges

# Which source table fills which part of ``Dims``.
DIM_SOURCES = {
    "organ": "base_organ",
    "region": "base_region_info",
    "dic": "base_dic",
    "truck": "truck_info",
    "truck_model": "truck_model",
}


def read_config(spark: SparkSession, config: JobConfig) -> DataFrame:
    """The routing config as it is now: a table over JDBC, a file, or its change log."""
    if config.get("config-url"):
        options = {"url": config["config-url"], "dbtable": f"tms_config.{CONFIG_TABLE}"}
        for arg, option in {"mysql-username": "user", "mysql-password": "password"}.items():
            if arg in config:
                options[option] = config[arg]
        return spark.read.format("jdbc").options(**options).load().select(CONFIG_COLUMNS)
    if config.get("config-log"):
        return current_config(parse_envelope(read_changes(spark, config["config-log"])))
    return spark.read.parquet(config.need("config-path")).select(CONFIG_COLUMNS)


def live_dims(spark: SparkSession, config: JobConfig, salts: int = 16) -> Dims:
    """The dimensions that streams look grouping keys up in, as streams of the operational topic.

    They are read from its start and whole, whatever bounds the facts' micro-batches: the topic
    must keep the last change of each dimension row.
    """
    whole = JobConfig(**{"offset-reset": "earliest"})
    own = {"topic", "offset-reset", "max-files-per-trigger", "max-bytes-per-trigger"}
    whole.update({k: v for k, v in config.items() if k not in own})
    values = read_topic(spark, whole, ODS_TOPIC, "tms_dws_dims")
    by_source = {c.source_table: c for c in config_rows(read_config(spark, config))}
    return Dims(
        **{
            part: DimChanges.of(values, by_source[DIM_SOURCES[part]], salts)
            for part in ("organ", "truck")
            if DIM_SOURCES[part] in by_source
        }
    )


def read_dims(spark: SparkSession, config: JobConfig) -> Dims:
    """Current dimension tables, one snapshot for all lookups of a run."""
    tables = DimTables(spark, config.need("dim-root"))
    by_source: dict[str, DimConfig] = {
        c.source_table: c for c in config_rows(read_config(spark, config))
    }
    return Dims(
        **{
            part: tables.read(by_source[source])
            for part, source in DIM_SOURCES.items()
            if source in by_source
        }
    )
