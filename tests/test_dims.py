import hashlib

import pytest
from pyspark.sql import functions as F
from util import envelope, lines, rows

from waybill.operators.routing import DimConfig, config_rows, current_config, route_by_config
from waybill.plans.dim import dim_changes
from waybill.schemas import DIM_CONFIG
from waybill.sources.changelog import parse_envelope
from waybill.streaming.dims import DimTables, apply_dim_changes

ORG = DimConfig("base_organ", "dim_base_organ", "id,org_name,org_parent_id")
DRIVER = DimConfig("truck_driver", "dim_truck_driver", "license_no,emp_id", primary_key="emp_id")


def config(spark, *dims):
    values = [
        (c.source_table, c.sink_table, c.sink_columns, c.primary_key, c.sink_extend, c.foreign_keys)
        for c in dims
    ]
    return spark.createDataFrame(values, DIM_CONFIG)


def changes(spark, *texts):
    return dim_changes(lines(spark, *texts))


def org(id, name, at, op="u", **more):
    return envelope("base_organ", op, at, {"id": id, "org_name": name} | more)


def test_upsert_keeps_the_newest_row_per_key(spark, tmp_path):
    tables, cfg = DimTables(spark, str(tmp_path), retain_seconds=0), config(spark, ORG, DRIVER)
    first = changes(
        spark,
        org("1", "old", 1, "r"),
        org("1", "newer", 5),
        org("2", "two", 2, "c", secret="x"),
        envelope("unknown", "c", 1, {"id": "9"}),
        envelope("base_organ", "d", 9, None),
        envelope("truck_driver", "c", 1, {"emp_id": "e", "license_no": "L"}),
    )
    apply_dim_changes(tables, first, cfg, 0)
    apply_dim_changes(tables, changes(spark, org("2", "two b", 7), org("3", None, 8)), cfg, 1)
    want = [("1", "newer", None), ("2", "two b", None), ("3", None, None)]
    assert rows(tables.read(ORG)) == want
    assert rows(tables.read(DRIVER)) == [(hashlib.md5(b"L").hexdigest(), "e")]

    # A repeated batch changes nothing, nor does folding changes into a snapshot.
    apply_dim_changes(tables, changes(spark, org("2", "two b", 7), org("3", None, 8)), cfg, 1)
    assert rows(tables.read(ORG)) == want
    tables.table(ORG).compact()
    assert rows(tables.read(ORG)) == want
    apply_dim_changes(tables, changes(spark, org("1", "last", 9)), cfg, 2)
    assert rows(tables.read(ORG)) == [("1", "last", None), *want[1:]]
    tables.table(ORG).compact()
    left = {p.name for p in (tmp_path / "dim_base_organ").iterdir()}
    assert left == {"batch_id=2", "upto=1", "upto=2"}
    with pytest.raises(ValueError, match="new checkpoint"):
        apply_dim_changes(tables, changes(spark, org("1", "x", 9)), cfg, 0)


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    tables, cfg = DimTables(spark, str(tmp_path)), config(spark, ORG)
    apply_dim_changes(tables, changes(spark, org("1", "a", 1)), cfg, 0)
    (tmp_path / "dim_base_organ" / "upto=0").mkdir()
    assert rows(tables.read(ORG)) == [("1", "a", None)]


def test_create_makes_an_empty_text_table(spark, tmp_path):
    tables = DimTables(spark, str(tmp_path))
    tables.table(ORG).create()
    tables.table(ORG).create()
    df = tables.read(ORG)
    assert df.count() == 0
    assert [f.simpleString() for f in df.schema] == [
        "id:string", "org_name:string", "org_parent_id:string",
    ]


def test_routing_keeps_configured_columns_exactly(spark):
    df = changes(spark, org("1", "a", 1, org_id="x"), envelope("other", "c", 1, {"id": "2"}))
    routed = route_by_config(df, config(spark, DimConfig("base_organ", "dim", " org_id , org_name")))
    got = routed.select("sink_table", "primary_key", F.to_json("data")).collect()
    assert [tuple(r) for r in got] == [("dim", "id", '{"org_name":"a","org_id":"x"}')]


def test_config_log_gives_current_rows(spark):
    def change(op, at, table, columns):
        image = {"source_table": table, "sink_table": "d", "sink_columns": columns}
        if op == "d":
            return envelope("tms_config_dim", op, at, None, image)
        return envelope("tms_config_dim", op, at, image)

    log = parse_envelope(
        lines(
            spark,
            change("r", 1, "a", "id"),
            change("u", 2, "a", "id,x"),
            change("c", 1, "b", "id"),
            change("d", 3, "b", "id"),
        )
    )
    got = config_rows(current_config(log))
    assert got == [DimConfig("a", "d", "id,x")]
    assert (got[0].columns, got[0].key) == (["id", "x"], "id")
