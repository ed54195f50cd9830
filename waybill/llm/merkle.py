"""A manifest of a dataset: hash trees by source, and a proof for every row.

Every row is a leaf. The leaves of a source stand by id, and while a level has more than one
node, every 16 consecutive ones become a node of the next, of which the last may have fewer. The
tops of the sources, by source, are the leaves of a further tree, whose top is the root.

Levels are written as rows linked to their parents: the key of a node, the key of its parent,
its place among the parent's children, and the digests of its own children. A recursive query
climbs from every leaf to the root: each step joins the parents, appends the siblings to the
proof and folds the leaf's digest with them. The leaves of one run climb in one row, since above
their own run their siblings are the same; every leaf has a fold of its own.

Places are counted without a task that sees a whole source: rows are sorted by range, each range
counts its rows by source, and the counts are summed by range.

A field is ``-`` for null, else its UTF-8 byte count, a colon and the value, so null and empty
differ. Rows of one source and id stand by their leaf; equal rows are leaves of their own. Null
ids come first and are never drawn for tampering; a null source is a source of its own and comes
first. Columns other than the five are not read. Without rows there is no root and no result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.llm.common import written

#: Children of a node.
RUN = 16
#: The leaves' fields, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of a range when leaves are put in order.
RANGE_ROWS = 1_000_000
_HEX = 64
#: The tree above the sources, and the columns that a step of the climb reads.
_TOP = -1
_NODE = ("tree", "level", "pos", "kids", "hash", "is_subroot", "is_root", "up_tree", "up_level", "up_pos", "slot")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(**values: Column) -> Column:
    """The digest of a row."""

    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(*(field(values[name]) for name in FIELDS))


def tampered(doc_id: Column) -> Column:
    """Whether the row is drawn for tampering."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _sorted(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows in ranges of ``keys``; ``at`` is range << 33 + place in the range."""
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE_ROWS + 1)
    # rows that are equal in all keys would else be one range, whatever their number
    order = [F.col(k).asc_nulls_first() for k in [*keys, "tie"]]
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    placed = tied.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("tie")
    return written(placed.withColumn("at", F.monotonically_increasing_id()), name)


def _placed(leaves: DataFrame) -> DataFrame:
    """The leaves with their source's number, ``tree``, their place there, ``pos``, and its size ``n``."""
    rows = _sorted(leaves, ["source", "doc_id", "leaf"], "leaves-by-range")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    # a source has at most one row here for each range, and only ranges' numbers are summed in one task
    spans = rows.groupBy("part", "source").agg(F.min("at").alias("low"), F.count("*").alias("rows"))
    by_source = W.partitionBy("source")
    earlier = by_source.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    spans = written(
        spans.withColumns(
            {
                "before": F.coalesce(F.sum("rows").over(earlier), F.lit(0)),
                "n": F.sum("rows").over(by_source),
                "new": F.when(F.row_number().over(by_source.orderBy("part")) == 1, 1).otherwise(0),
            }
        ),
        "spans",
    )
    parts = spans.groupBy("part").agg(F.sum("new").alias("sources"))
    so_far = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("sources").over(so_far), F.lit(0)).alias("sources"))
    within = W.partitionBy("part").orderBy(F.col("source").asc_nulls_first())
    spans = spans.join(parts, "part").withColumn("tree", F.col("sources") + F.sum("new").over(within) - 1)
    spans = spans.select(F.col("part").alias("p"), F.col("source").alias("s"), "low", "before", "n", "tree")
    same = (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))
    return rows.join(spans, same).select(
        "tree", (F.col("before") + F.col("at") - F.col("low")).alias("pos"), "n", "doc_id", "leaf", "start"
    )


def _children(nodes: DataFrame, *more: str) -> DataFrame:
    """Runs of nodes as ``tree, pos, n, kids`` of the next level, and lists of the columns ``more``."""
    run = F.sort_array(F.collect_list(F.struct("pos", "hash", *more)))
    above = nodes.groupBy("tree", F.shiftright("pos", 4).alias("above"), "n").agg(run.alias("run"))
    return above.select(
        "tree",
        F.col("above").alias("pos"),
        F.ceil(F.col("n") / RUN).cast("long").alias("n"),
        F.array_join("run.hash", "").alias("kids"),
        *(F.col(f"run.{c}").alias(c) for c in more),
    )


def _levels(rows: DataFrame, level: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels above the nodes ``tree, pos, n, hash`` of a level, and the tops of all trees."""
    levels, tops = [], []
    while True:
        tops.append(rows.filter("n = 1").select("tree", "hash"))
        wide = rows.filter("n > 1").select("tree", "pos", "n", "hash")
        if wide.isEmpty():
            return levels, reduce(DataFrame.unionByName, tops)
        level += 1
        rows = written(_children(wide).withColumn("hash", digest(F.col("kids"))), f"level-{level}")
        levels.append(rows.withColumn("level", F.lit(level)))


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row."""
    spark = docs.sparkSession
    values = {name: F.col(f"`{name}`") for name in FIELDS}
    lowered = leaf(**{**values, "text": F.translate(values["text"], _UPPER, _UPPER.lower())})
    leaves = docs.select(
        values["doc_id"].cast("long").alias("doc_id"),
        values["source"].alias("source"),
        leaf(**values).alias("leaf"),
        F.when(tampered(values["doc_id"]), lowered).alias("changed"),
    )
    leaves = leaves.withColumn("start", F.coalesce("changed", "leaf")).drop("changed")
    placed = written(_placed(written(leaves, "leaves")), "placed")

    # runs of leaves, the first level of every tree; a lone leaf is its tree's top
    runs = _children(placed.withColumn("hash", F.col("leaf")), "doc_id", "leaf", "start")
    alone = (F.size("leaf") == 1) & (F.col("n") == 1)
    runs = runs.withColumns(
        {
            "hash": F.when(alone, F.col("kids")).otherwise(digest(F.col("kids"))),
            "level": F.when(alone, 0).otherwise(1),
        }
    )
    runs = written(runs, "runs")
    levels, tops = _levels(runs.select("tree", "pos", "n", "hash"), 1)
    subroots = written(tops, "subroots")
    count = subroots.count()
    top = F.lit(_TOP).cast("long")
    sources = subroots.select(top.alias("tree"), F.col("tree").alias("pos"), F.lit(count).alias("n"), "hash")
    upper, _ = _levels(sources, 0)

    own = _linked(runs, count)
    folds = F.when(F.col("level") == 0, F.col("start")).otherwise(
        F.transform("start", lambda f, i: digest(_left(F.col("kids"), i), f, _right(F.col("kids"), i)))
    )
    own = own.withColumn("folds", folds)
    above = [_linked(level, count).select(*_NODE) for level in levels + upper]
    nodes = reduce(DataFrame.unionByName, above) if above else own.filter("false").select(*_NODE)
    climbed = _climb(spark, own.select("kids", "folds", *_NODE[:3], *_NODE[4:]), nodes)
    met = climbed.join(runs.select("tree", "pos", "doc_id", "leaf", "kids"), ["tree", "pos"])
    each = met.select("*", F.posexplode(F.arrays_zip("doc_id", "leaf", "folds")).alias("slot", "of"))
    proof = F.sha2(F.concat(_left(F.col("kids"), F.col("slot")), _right(F.col("kids"), F.col("slot")), "path").cast("binary"), 256)
    return each.select(
        F.col("of.doc_id").alias("doc_id"),
        F.col("of.leaf").alias("leaf"),
        "subroot",
        "root",
        proof.alias("proof_sha256"),
        F.col("of.folds").alias("folded_root"),
        (F.col("of.folds") == F.col("root")).alias("verified"),
    )


def _left(kids: Column, slot: Column) -> Column:
    """Digests of the children before one."""
    return F.substring(kids, F.lit(1), slot * _HEX)


def _right(kids: Column, slot: Column) -> Column:
    """Digests of the children after one."""
    return F.substring(kids, slot * _HEX + _HEX + 1, F.lit(_HEX * RUN))


def _linked(rows: DataFrame, count: int) -> DataFrame:
    """Rows of nodes with the key of their parent and their place among its children."""
    in_top = F.col("tree") == _TOP
    top = F.col("n") == 1
    place = F.when(top & ~in_top, F.col("tree")).otherwise(F.col("pos"))
    return rows.withColumns(
        {
            "is_subroot": top & ~in_top,
            "is_root": top & (in_top | F.lit(count == 1)),
            "up_tree": F.when(top, F.lit(_TOP).cast("long")).otherwise(F.col("tree")),
            "up_level": F.when(top & ~in_top, 1).otherwise(F.col("level") + 1),
            "up_pos": F.shiftright(place, 4),
            "slot": (place % RUN).cast("int"),
        }
    )


_CLIMB = """
WITH RECURSIVE climb AS (
  SELECT tree, pos, folds, '' AS path, CASE WHEN is_subroot THEN hash END AS subroot,
    CASE WHEN is_root THEN hash END AS root, up_tree, up_level, up_pos, slot
  FROM {leaves}
  UNION ALL
  SELECT c.tree, c.pos,
    transform(c.folds, f -> sha2(cast(concat(
      substring(n.kids, 1, 64 * c.slot), f, substring(n.kids, 64 * c.slot + 65)) AS binary), 256)) AS folds,
    concat(c.path, substring(n.kids, 1, 64 * c.slot), substring(n.kids, 64 * c.slot + 65)) AS path,
    coalesce(c.subroot, CASE WHEN n.is_subroot THEN n.hash END) AS subroot,
    CASE WHEN n.is_root THEN n.hash END AS root, n.up_tree, n.up_level, n.up_pos, n.slot
  FROM climb c JOIN {nodes} n ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos
  WHERE c.root IS NULL
)
SELECT tree, pos, folds, path, subroot, root FROM climb WHERE root IS NOT NULL
"""


def _climb(spark: SparkSession, leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """What the leaves of each run bring to the root: folded digests, siblings above the run, both tops."""
    rows = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(rows, None)
    # the bound of a recursion is its number of levels; its rows are those of the dataset
    spark.conf.set(rows, "-1")
    try:
        return written(spark.sql(_CLIMB, leaves=leaves, nodes=nodes), "climbed")
    finally:
        if before is None:
            spark.conf.unset(rows)
        else:
            spark.conf.set(rows, before)
