"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.operators.skew import split_join


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in ``order``.

    ``row_number() = 1`` is planned with a group limit before the shuffle: each task sends
    at most one row per key, so a key holding a large share of all rows stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``: current state from versions."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def with_first_flag(df: DataFrame, key: str, order: Sequence[str], out: str) -> DataFrame:
    """All rows kept; 1 on the first row of each key, 0 on the others.

    ``order`` must order the rows of a key totally.
    """
    firsts = df.groupBy(key).agg(F.min(F.struct(*order)).alias("__first"))
    same = F.struct(*[F.col(f"l.{c}") for c in order]).eqNullSafe(F.col("r.__first"))
    return split_join(df, firsts, key).select(
        *[F.col(f"l.{c}") for c in df.columns], F.when(same, 1).otherwise(0).cast("bigint").alias(out)
    )


def first_per_key_stream(
    df: DataFrame, keys: Sequence[str], row_id: str, salts: int = 16
) -> DataFrame:
    """First arriving row of each key while the watermark remembers the key.

    Streaming state has no combine before the shuffle, so a hot key is thinned out over
    ``salts`` state keys first; the second step sees at most ``salts`` rows of it.
    The input carries the watermark; its delay is how long a key is remembered.
    """
    if salts > 1:
        salt = F.pmod(F.xxhash64(row_id), F.lit(salts))
        df = df.withColumn("__salt", salt).dropDuplicatesWithinWatermark([*keys, "__salt"])
        df = df.drop("__salt")
    return df.dropDuplicatesWithinWatermark([*keys])
