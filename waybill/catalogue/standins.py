"""The benchmark tables read as warehouse tables.

Ids become text, as in the source system. Where the benchmark has no such column (times of
day, status histories, parent organisations) it is computed from the row's own keys, so
every stand-in grows with its table. All scans prune to the columns used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waybill.operators.history import last_before
from waybill.plans.dws import Dims, once_per_order
from waybill.schemas import MONEY, ORDER_INFO

# Change logs start here; order k's life starts k times PACE seconds later, modulo 30 days.
EPOCH = "2024-01-01T00:00:00Z"
SPREAD = 30 * 86400
PACE = 1733
STEP_HOURS = 6
# Status history by final state. The last step of F and P comes after the order has closed.
HISTORY = {
    "F": "60010,60020,60030,60040,60050,60060,60070,60080,60999",
    "O": "60010,60020,60030,60040,60050,60060",
    "P": "60010,60020,60999,60010,60020",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def live_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table, a file or a folder of files, as a stream of its files."""
    schema = table(spark, sf_dir, name).schema
    # as a pattern: a stream takes the path of one file only so
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def instant(column: str, minutes: Column) -> Column:
    """A date column moved to a time of day, as an instant."""
    return F.col(column).cast("timestamp") + F.make_dt_interval(mins=minutes.cast("int"))


def nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities (nations) below provinces (regions), one id space."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    cities = n.select(
        F.concat(F.lit("c"), text("n_nationkey")).alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("p"), text("n_regionkey")).alias("parent_id"),
    )
    provinces = r.select(
        F.concat(F.lit("p"), text("r_regionkey")).alias("id"),
        F.col("r_name").alias("name"),
        F.lit(None).cast("string").alias("parent_id"),
    )
    return cities.unionByName(provinces)


def organ(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as organisations; each not divisible by ten has a parent that is."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("id"),
        F.col("s_name").alias("org_name"),
        F.when(key % 10 != 0, key - key % 10).alias("org_parent_id"),
        F.concat(F.lit("c"), text("s_nationkey")).alias("region_id"),
    )


def dims(spark: SparkSession, sf_dir: str) -> Dims:
    part = table(spark, sf_dir, "part")
    return Dims(
        organ=organ(spark, sf_dir),
        region=nation_region(spark, sf_dir),
        dic=part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
        truck=part.select(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("truck_model_id")
        ),
        truck_model=part.groupBy(F.col("p_brand").alias("id")).agg(
            F.min("p_type").alias("model_name")
        ),
    )


# The line key of the benchmark is not unique; these tell all lines of an order apart.
LINE = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]


# Enough of an id where no line has to come first.
PASSAGE = ["l_linenumber", "l_partkey", "l_suppkey"]


def cargo_lines(lines: DataFrame) -> DataFrame:
    """Order lines with their creation time: the shipping date at a time of day."""
    return lines.select(
        F.struct(*LINE).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("cargo_type"),
        F.col("l_quantity").cast(MONEY).alias("weight"),
        instant("l_shipdate", F.col("l_orderkey") % 1440).alias("ts"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their city (nation) and province (region)."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey",
        F.concat(F.lit("c"), text("n_nationkey")).alias("sender_district_id"),
        F.concat(F.lit("c"), text("n_nationkey")).alias("sender_city_id"),
        F.concat(F.lit("p"), text("n_regionkey")).alias("sender_province_id"),
        F.col("c_name").alias("sender_name"),
        F.col("c_mktsegment").alias("payment_type"),
    )


def senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the place of their customer."""
    o = table(spark, sf_dir, "orders")
    joined = o.join(places(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("collect_type"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        "sender_district_id",
        "sender_city_id",
        "sender_province_id",
        "sender_name",
        "payment_type",
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order detail rows: every line widened by its order."""
    return cargo_lines(table(spark, sf_dir, "lineitem")).join(senders(spark, sf_dir), "order_id")


def first_order_lines(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Detail rows of first lines only, with the columns of ``orders``.

    A placed order's time is its line's, so the first line is known before the join: one row
    per order is shuffled instead of every line, and a hot order is thinned out first.
    """
    first = once_per_order(cargo_lines(table(spark, sf_dir, "lineitem")))
    return first.join(orders, "order_id")


# --- change logs --------------------------------------------------------------------------


def born(key: str) -> Column:
    """When the life of order ``key`` starts in the change logs."""
    start = F.unix_seconds(F.lit(EPOCH).cast("timestamp"))
    return F.timestamp_seconds(start + F.col(key) * PACE % SPREAD)


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def images(fields: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def order_log(orders: DataFrame) -> DataFrame:
    """Typed ``order_info`` envelopes: each order's insert and its status updates."""
    path = F.lit(None).cast("string")
    for state, steps in HISTORY.items():
        path = F.when(F.col("o_orderstatus") == state, F.lit(steps)).otherwise(path)
    steps = orders.withColumn("path", F.split(path, ",")).select(
        "*", F.posexplode("path").alias("step", "status")
    )
    at = born("o_orderkey") + F.make_dt_interval(hours=F.col("step") * STEP_HOURS)
    known = {
        "id": F.col("o_orderkey"),
        "order_no": F.concat(F.lit("no"), text("o_orderkey")),
        "status": F.col("status"),
        "collect_type": F.col("o_orderpriority"),
        "user_id": F.col("o_custkey"),
        "receiver_name": F.col("o_orderstatus"),
        "sender_name": F.col("o_orderpriority"),
        "cargo_num": F.lit(1),
        "amount": F.col("o_totalprice").cast(MONEY),
        # A local wall clock kept as epoch milliseconds.
        "estimate_arrive_time": F.unix_millis(F.col("o_orderdate").cast("timestamp")),
        "create_time": iso(born("o_orderkey")),
        "update_time": iso(at),
        "is_deleted": F.lit("0"),
    }
    after = {
        f.name: known.get(f.name, F.lit(None).cast(f.dataType))
        for f in StructType.fromDDL(ORDER_INFO).fields
    }
    before = F.struct(F.get("path", F.col("step") - 1).alias("status"))
    return steps.select(
        F.when(F.col("step") == 0, "c").otherwise("u").alias("op"),
        at.alias("ts"),
        F.lit("order_info").alias("table"),
        F.when(F.col("step") > 0, before).alias("before"),
        images(after).alias("after"),
    )


def cargo_log(lines: DataFrame) -> DataFrame:
    """Typed ``order_cargo`` inserts, from 4 s before their order to 8 s after it."""
    at = born("l_orderkey") + F.make_dt_interval(secs=F.col("l_linenumber") * 2 - 6)
    after = {
        "id": F.struct(*PASSAGE),
        "order_id": F.col("l_orderkey"),
        "cargo_type": F.col("l_partkey"),
        "volumn_length": F.col("l_linenumber"),
        "volumn_width": F.col("l_linenumber"),
        "volumn_height": F.col("l_linenumber"),
        "weight": F.col("l_quantity").cast(MONEY),
        "create_time": iso(at),
        "update_time": iso(at),
        "is_deleted": F.lit("0"),
    }
    return lines.select(
        F.lit("c").alias("op"),
        at.alias("ts"),
        F.lit("order_cargo").alias("table"),
        images({"id": F.lit(None).cast("string")}).alias("before"),
        images(after).alias("after"),
    )


def bound_log(lines: DataFrame) -> DataFrame:
    """Typed ``order_org_bound`` envelopes: one passage through an organisation per line.

    Inserted on arrival; flag R sets sorting and departure in one update, A in two, N only
    sorts and then corrects its sorting time, which is no event.
    """
    steps = F.when(F.col("l_returnflag") == "R", 2).otherwise(3)
    passed = lines.select("*", F.explode(F.sequence(F.lit(1), steps)).alias("step"))
    flag, step = F.col("l_returnflag"), F.col("step")
    inbound = F.unix_millis(instant("l_shipdate", F.col("l_orderkey") % 1440))
    sort = inbound + F.col("l_linenumber") * 3_600_000
    outbound = sort + F.col("l_linenumber") * 1_800_000
    corrected = F.when((step == 3) & (flag == "N"), sort + 1000).otherwise(sort)
    leaves = ((flag == "R") & (step == 2)) | ((flag == "A") & (step == 3))

    def image(sort_time: Column, outbound_time: Column) -> Column:
        return images(
            {
                "id": F.struct(*PASSAGE),
                "order_id": F.col("l_orderkey"),
                "org_id": F.col("l_suppkey"),
                "inbound_time": inbound.cast("string"),
                "inbound_emp_id": F.col("l_partkey"),
                "sort_time": sort_time.cast("string"),
                "sorter_emp_id": F.col("l_partkey"),
                "outbound_time": outbound_time.cast("string"),
                "outbound_emp_id": F.col("l_partkey"),
            }
        )

    nothing = F.lit(None).cast("bigint")
    return passed.select(
        F.when(step == 1, "c").otherwise("u").alias("op"),
        # Empty rather than null before an insert: unused fields of it are then not read.
        image(F.when(step == 3, sort), nothing).alias("before"),
        image(F.when(step > 1, corrected), F.when(leaves, outbound)).alias("after"),
    )


def transport_log(lines: DataFrame) -> DataFrame:
    """Typed ``transport_task`` updates: one trip per line; flag N had ended before."""
    end = F.unix_millis(instant("l_shipdate", F.col("l_orderkey") % 1440))
    start = end - F.col("l_quantity").cast("bigint") * 3_600_000
    after = {
        "id": F.struct(*PASSAGE),
        "shift_id": F.lit(None).cast("string"),
        "line_id": F.lit(None).cast("string"),
        "start_org_id": F.col("l_suppkey"),
        "start_org_name": F.concat(F.lit("org "), text("l_suppkey"), F.lit(" "), F.col("l_returnflag")),
        "end_org_id": F.lit(None).cast("string"),
        "end_org_name": F.lit(None).cast("string"),
        "order_num": F.lit(1),
        "driver1_emp_id": F.lit(None).cast("string"),
        "driver1_name": F.col("l_returnflag"),
        "driver2_emp_id": F.lit(None).cast("string"),
        "driver2_name": F.lit(None).cast("string"),
        "truck_id": F.col("l_partkey"),
        "truck_no": text("l_partkey"),
        "actual_start_time": start.cast("string"),
        "actual_end_time": end.cast("string"),
        "actual_distance": F.col("l_quantity").cast(MONEY),
    }
    before = F.struct(
        F.when(F.col("l_returnflag") == "N", (end - 1000).cast("string")).alias("actual_end_time")
    )
    return lines.select(
        F.lit("u").alias("op"), before.alias("before"), images(after).alias("after")
    )


def user_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as updates of their user's row: ``op, before, after`` with status and value.

    The image before a change is the user's previous event. The look-back is split by day,
    so a user with a large share of all events does not end up in one task.
    """
    e = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"),
        user_status().alias("status"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"),
    )
    row = F.struct("status", "value")
    stepped = last_before(
        e, "user_id", ["ts", "event_id"], row, "before", bucket=F.date_trunc("day", "ts")
    )
    return stepped.select(
        F.when(F.col("before").isNull(), "c").otherwise("u").alias("op"),
        "event_id",
        "user_id",
        "event_type",
        "ts",
        "before",
        row.alias("after"),
    )


def user_status() -> Column:
    """Event types as order states; even and odd ids tell two states of a type apart."""
    odd = F.col("event_id") % 2 == 1
    kind = F.col("event_type")
    return (
        F.when(kind == "signup", F.when(odd, "60010").otherwise("60050"))
        .when(kind == "view", F.when(odd, "60020").otherwise("60060"))
        .when(kind == "click", F.when(odd, "60030").otherwise("60070"))
        .when(kind == "purchase", F.when(odd, "60040").otherwise("60080"))
        .otherwise("60999")
    )
