"""Dimensions that change while others read them."""

import random

import pytest
from pyspark.sql import functions as F
from util import envelope, lines, rows

from waybill.operators.lookup import lookup_join
from waybill.operators.routing import DimConfig
from waybill.plans.dim import dim_changes
from waybill.sources.changelog import parse_envelope
from waybill.streaming.dims import DimTables, apply_dim_changes
from waybill.streaming.lookups import DimChanges
from waybill.streaming.tables import KeyedTable

TRUCK = DimConfig("truck_info", "dim_truck_info", "id,truck_model_id")
ORG = DimConfig("base_organ", "dim_base_organ", "id,org_name,region_id")


def table(spark, path, **options):
    return KeyedTable(spark, str(path), "id bigint, v string", ["id"], **options)


def fill(spark, kept, batch):
    at = F.timestamp_seconds(F.lit(batch))
    kept.upsert(spark.createDataFrame([(batch % 3, f"v{batch}")], "id bigint, v string").withColumn("ts", at), batch)
    kept.compact()


def test_a_held_frame_outlives_compactions(spark, tmp_path):
    kept = table(spark, tmp_path / "t")
    kept.create()
    fill(spark, kept, 0)
    held = kept.read()
    for batch in range(1, 11):
        fill(spark, kept, batch)
    assert rows(held) == [(0, "v0")]
    assert rows(kept.read()) == [(0, "v9"), (1, "v10"), (2, "v8")]


def test_a_lease_keeps_files_that_age_would_drop(spark, tmp_path):
    kept = table(spark, tmp_path / "t", retain_seconds=0)
    kept.create()
    fill(spark, kept, 0)
    unheld = kept.read()
    with kept.reading() as held:
        for batch in range(1, 5):
            fill(spark, kept, batch)
        assert rows(held) == [(0, "v0")]
    for batch in range(5, 8):
        fill(spark, kept, batch)
    left = sorted(p.name for p in (tmp_path / "t").iterdir() if "=" in p.name)
    assert left == ["batch_id=7", "upto=6", "upto=7"]
    with pytest.raises(Exception, match="NOT_EXIST|not exist"):
        unheld.collect()


def test_a_stream_joins_a_held_frame_over_compactions(spark, tmp_path):
    kept = table(spark, tmp_path / "t")
    kept.create()
    fill(spark, kept, 0)
    (tmp_path / "in").mkdir()
    facts = spark.readStream.schema("id bigint").json(str(tmp_path / "in"))
    q = facts.join(kept.read(), "id").writeStream.format("memory").queryName("held").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for batch in range(1, 5):
            fill(spark, kept, batch)
            (tmp_path / "in" / f"{batch}.json").write_text('{"id": 0}')
            q.processAllAvailable()
    finally:
        q.stop()
    assert rows(spark.table("held")) == [(0, "v0")] * 4


def change(id, name, pos, file="bin.000001", at=5):
    line = envelope("base_organ", "u", at, {"id": id, "org_name": name})
    return line.replace('"source": {', f'"source": {{"file": "{file}", "pos": {pos}, "row": 0, ')


def test_equal_times_are_ordered_by_the_log(spark, tmp_path):
    texts = [change("1", f"n{p}", p) for p in (4, 99, 100, 1000, 20)]
    texts += [change("1", "next file", 3, "bin.000002"), change("2", "late", 1, at=9), change("2", "early", 500)]
    cfg = spark.createDataFrame([(ORG.source_table, ORG.sink_table, ORG.sink_columns, None, None, None)], "source_table string, sink_table string, sink_columns string, primary_key string, sink_extend string, foreign_keys string")
    for seed in range(3):
        random.Random(seed).shuffle(texts)
        tables = DimTables(spark, str(tmp_path / str(seed)))
        apply_dim_changes(tables, dim_changes(lines(spark, *texts)).repartition(3), cfg, 0)
        assert rows(tables.read(ORG).select("id", "org_name")) == [("1", "next file"), ("2", "late")]


def test_equal_changes_without_a_position_have_one_winner(spark, tmp_path):
    values, winners = [(1, f"v{i}") for i in range(6)], set()
    for seed in range(4):
        random.Random(seed).shuffle(values)
        kept = table(spark, tmp_path / str(seed))
        kept.create()
        kept.upsert(spark.createDataFrame(values, "id bigint, v string").withColumn("ts", F.timestamp_seconds(F.lit(1))).repartition(2), 0)
        winners.add(rows(kept.read())[0])
    assert len(winners) == 1


def test_positions_of_logs_and_topics(spark):
    log = lines(spark, change("1", "a", 7), envelope("t", "u", 1, {"id": "1"}), envelope("t", "u", 1, {"id": "1"}).replace('"source": {', '"source": {"lsn": 12, '))
    got = [r.position for r in parse_envelope(log.withColumn("log_position", F.lit("p"))).select("position").collect()]
    assert got == ["bin.000001/" + "7".zfill(20) + "/" + "0" * 20, "p", "/" + "12".zfill(20) + "/" + "0" * 20]
    assert "log_position" not in parse_envelope(log).columns


class Steps:
    """A stream fed step by step, its result after each."""

    def __init__(self, spark, tmp_path, dim, on, take, salts=3):
        self.spark, self.root = spark, tmp_path
        for name in ("facts", "log", "out"):
            (tmp_path / name).mkdir()
        self.dim, self.on, self.take, self.salts, self.step = dim, on, take, salts, 0

    def add(self, facts, *changes):
        self.step += 1
        (self.root / "log" / f"{self.step}.txt").write_text("\n".join(changes) + "\n")
        self.spark.createDataFrame(facts, "n long, k string, ts timestamp").write.mode("append").parquet(str(self.root / "facts"))
        facts = self.spark.readStream.schema("n long, k string, ts timestamp").parquet(str(self.root / "facts"))
        dim = DimChanges.of(self.spark.readStream.text(str(self.root / "log")), self.dim, self.salts)
        met = lookup_join(facts.withWatermark("ts", "1 day"), dim, self.on, self.take)
        q = met.writeStream.format("parquet").trigger(availableNow=True).outputMode("append")
        q.option("checkpointLocation", str(self.root / "c")).start(str(self.root / "out")).awaitTermination()
        return sorted(map(tuple, self.spark.read.parquet(str(self.root / "out")).drop("ts", "k").collect()), key=lambda r: r[0])


@pytest.fixture
def append_mode(monkeypatch):
    meet = DimChanges.meet
    monkeypatch.setattr(DimChanges, "meet", lambda *a, **k: meet(*a, **k, mode="Append"))


def facts(step, *keys):
    import datetime as dt

    return [(step * 100 + i, k, dt.datetime(2024, 1, 1, 0, step, i, 123456)) for i, k in enumerate(keys)]


def truck(id, model, at, before=None):
    old = {"id": id, "truck_model_id": before} if before else None
    return envelope("truck_info", "u" if before else "c", at, {"id": id, "truck_model_id": model}, old)


def test_trucks_are_met_as_they_are(spark, tmp_path, append_mode):
    s = Steps(spark, tmp_path, TRUCK, {"k": "id"}, {"truck_model_id": "model"})
    got = s.add(facts(0, "1", "2", None), truck("1", "m1", 1), envelope("other", "c", 1, {"id": "2"}))
    assert got == [(0, "m1"), (1, None), (2, None)]
    got = s.add(facts(1, "1", "2", "1"), truck("2", "m2", 2), truck("1", "m9", 9, "m1"), truck("1", "m5", 5, "m1"))
    assert got[3:] == [(100, "m9"), (101, "m2"), (102, "m9")]
    got = s.add(facts(2, "1", "2"), truck("1", "m7", 7, "m1"), envelope("truck_info", "d", 99, None, {"id": "2"}))
    assert got[6:] == [(200, "m9"), (201, "m2")]  # an older change and a delete change nothing


def organ(id, region, at, before=None):
    old = {"id": id, "org_name": f"o{id}", "region_id": before} if before else None
    return envelope("base_organ", "u" if before else "c", at, {"id": id, "org_name": f"o{id}", "region_id": region}, old)


def test_rows_leave_lookup_keys(spark, tmp_path, append_mode):
    s = Steps(spark, tmp_path, ORG, {"k": "region_id"}, {"id": "org", "org_name": "name"})
    got = s.add(facts(0, "a", "b"), organ("2", "a", 1), organ("1", "a", 2), organ("3", "c", 2))
    assert got == [(0, "1", "o1"), (1, None, None)]
    got = s.add(facts(1, "a", "b"), organ("1", "b", 3, "a"))
    assert got[2:] == [(100, "2", "o2"), (101, "1", "o1")]
    got = s.add(facts(2, "a", "b", "c"), organ("1", "b", 4, "b"), organ("2", "c", 5, "a"))
    assert got[4:] == [(200, None, None), (201, "1", "o1"), (202, "2", "o2")]
