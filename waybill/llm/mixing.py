"""Mix sources to target weights by Pareto order sampling.

Every source has a target in words, and every document an expected number of copies that
adds up to it. The whole copies of that number are certain. The fraction left over is an
inclusion probability: documents are ranked by their random odds divided by their inclusion
odds, and the source takes them in this order up to the point nearest to its target, so the
size of the sample is fixed and only its members are random.

The random number is a digest of seed, document id and text: reruns, other partitions and
other clusters agree, and rows alike in both stand or fall together. The cut of a source is
found by narrowing: words by source and range of ranks are summed (combined before the
shuffle), then the range that holds the cut is divided again, so neither a hot source nor a
hot range is ever sorted.

Null text has no words and is never counted as taken words; a null source is a source of its
own, last in order; null ids are alike. A table without rows or words gives targets of 0.
Columns of docs with the names of results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waybill.llm.common import written

WEIGHTS = (5, 2, 1)
#: Bits of a rank; the first step that narrows a source's cut looks at the upper ones.
RANK_BITS, UPPER_BITS = 52, 16
RESULT = ["size", "source_size", "target", "copies", "taken"]


def words(text: Column) -> Column:
    """Number of runs of characters other than the six ASCII white ones; 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]"), "")), F.lit(0)).cast("long")


def measure(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: str = "mix"
) -> DataFrame:
    """Adds ``size`` and the random number ``mix_u`` in (0, 1); reads the text once."""
    digest = F.md5(
        F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    )
    high = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return docs.drop(*RESULT, "mix_u").withColumns(
        {
            "size": F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(words(F.col(text))),
            "mix_u": (high + F.lit(0.5)) / F.lit(float(1 << RANK_BITS)),
        }
    )


def targets(
    measured: DataFrame, share: float, weights: tuple[float, ...], most: float, source: str
) -> DataFrame:
    """Words each source gives: ``share`` of all words by weight, at most ``most`` times its own.

    What a source cannot give is shared again by weight. With sources in order of limit over
    weight, those at their limit come first and all others have one rate a weight: the
    largest of the rates that are left after each prefix. There is one row a source.
    """
    sizes = measured.groupBy(F.col(source).alias("source_name")).agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source_name").asc_nulls_last())) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), place % len(weights))
    limit = F.col("source_size") * F.lit(float(most))
    before = W.orderBy("ratio", "place").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    rate = (
        F.sum("source_size").over(everything) * F.lit(float(share))
        - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    return (
        sizes.withColumns({"place": place, "weight": weight, "limit": limit})
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("rate", rate)
        .withColumn("target", F.least("limit", F.col("weight") * F.max("rate").over(everything)))
        .select("source_name", "source_size", "target")
    )


def _copies() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))


def _rank() -> Column:
    """Random odds over inclusion odds, brought to a whole number of RANK_BITS bits."""
    chance = _copies() - F.floor(_copies())
    odds = (F.col("mix_u") / (1 - F.col("mix_u"))) / (chance / (1 - chance))
    return F.when(chance > 0, F.floor(odds / (1 + odds) * F.lit(float(1 << RANK_BITS))).cast("long"))


def _joined(rows: DataFrame, by_source: DataFrame, source: str) -> DataFrame:
    """The rows with ``source_size``, ``target`` and the names of ``by_source`` behind ``mix_``."""
    own = by_source.withColumnsRenamed({"source_name": "mix_source", "cut": "mix_cut"})
    return rows.drop("source_size", "target").join(own, F.col(f"`{source}`").eqNullSafe(F.col("mix_source")))


def plan(
    measured: DataFrame,
    share: float = 1.5,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = 2.0,
    source: str = "source",
) -> DataFrame:
    """One row a source: ``source_name, source_size, target`` and ``cut``, the last rank it takes.

    ``measured`` is read several times: write it first, without the text.
    """
    shares = written(targets(measured, share, weights, most, source), "mix-targets")
    rows = _joined(measured.select(F.col(source), "size", "mix_u"), shares, source).select(
        F.col("mix_source").alias("source_name"), "size", _rank().alias("rank")
    )
    rest = shares.withColumn("rest", F.col("target") - F.floor(_copies()) * F.col("source_size"))
    open_, rows = rest.select("source_name", "rest"), rows.filter("rank is not null and size > 0")
    for low in (RANK_BITS - UPPER_BITS, 0):
        rows = rows.withColumn("range", F.shiftright("rank", low))
        sums = rows.groupBy("source_name", "range").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(W.partitionBy("source_name").orderBy("range"))
        named = open_.select(F.col("source_name").alias("name"), "rest")
        found = (
            sums.withColumn("upto", upto)
            .join(named, F.col("source_name").eqNullSafe(F.col("name")))
            .filter("upto > rest")
            .groupBy("source_name")
            .agg(F.min(F.struct("range", "words", "upto", "rest")).alias("m"))
            .select(
                F.col("source_name").alias("name"),
                F.col("m.range").alias("at"),
                (F.col("m.rest") - F.col("m.upto") + F.col("m.words")).alias("rest"),
                F.col("m.words").alias("words"),
            )
        )
        found = written(found, "mix-cut")
        if low:
            rows = rows.join(
                found.select("name", "at"),
                F.col("source_name").eqNullSafe(F.col("name")) & (F.col("range") == F.col("at")),
                "left_semi",
            )
            open_ = found.select(F.col("name").alias("source_name"), "rest")
    cut = F.col("at") - F.when(F.col("words") <= 2 * F.col("rest"), 0).otherwise(1)
    return shares.join(
        found.select("name", cut.alias("at_most")), F.col("source_name").eqNullSafe(F.col("name")), "left"
    ).select(
        "source_name",
        "source_size",
        "target",
        F.coalesce("at_most", F.lit(1 << RANK_BITS).cast("long")).alias("cut"),
    )


def take(measured: DataFrame, plan: DataFrame, source: str = "source") -> DataFrame:
    """Every row with ``source_size``, ``target``, ``copies`` (0 to the most) and ``taken`` words.

    Columns of these names in the input are replaced; all others stay, whatever their names, but for ``mix_*``.
    """
    copies = F.floor(_copies()) + F.when(_rank() <= F.col("mix_cut"), 1).otherwise(0)
    return (
        _joined(measured, plan, source)
        .withColumn("copies", copies.cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("mix_source", "mix_cut", "mix_u")
    )
