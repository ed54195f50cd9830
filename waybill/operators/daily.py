"""Daily totals by key over local calendar days."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.timez import ZONE, day_window, local_date

# A measure that counts rows instead of summing a column.
ROWS = None


def daily_totals(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str | None],
    carried: Sequence[str] = (),
    resolve: Callable[[DataFrame], DataFrame] | None = None,
    raw_keys: Sequence[str] | None = None,
    found: Sequence[str] = (),
) -> DataFrame:
    """``cur_date, keys, found, carried, measures``: each measure totalled per local day and key.

    ``measures`` maps a result name to the column to sum, or to ``ROWS``. ``carried`` columns
    keep the value of the day's first row of the key (earliest ``ts``, then smallest value).
    Null keys form a group of their own. When the keys have to be looked up, ``resolve`` turns
    rows with ``raw_keys`` into rows with ``keys``; ``found`` are columns that it adds beside
    the keys, such as names. They are carried too: a key that is renamed stays one group.

    Batch input is first summed by raw key *and* carried values: those buffers are
    fixed-width, so the pass over the big input is a hash aggregate with a combine before
    the shuffle, and only its small result is looked up and ordered. Streaming state allows
    one aggregate in update mode, so there the rows are looked up first and the first values
    tracked directly.
    """
    sums = [
        (F.count(F.lit(1)) if m is ROWS else F.sum(m)).alias(name) for name, m in measures.items()
    ]
    day = day_window("ts").alias("__day")
    resolve = resolve or (lambda rows: rows)
    raw_keys = keys if raw_keys is None else raw_keys
    kept = [*carried, *found]

    def first(ts: str) -> list[Column]:
        if not kept:
            return []
        return [F.min_by(F.struct(*kept), F.struct(ts, *kept)).alias("__c")]

    if df.isStreaming:
        totals = resolve(df).groupBy(day, *keys).agg(*first("ts"), *sums)
    elif not kept and list(raw_keys) == list(keys):
        totals = df.groupBy(day, *keys).agg(*sums)
    else:
        parts = df.groupBy(day, *raw_keys, *carried).agg(F.min("ts").alias("__ts"), *sums)
        totals = (
            resolve(parts)
            .groupBy("__day", *keys)
            .agg(*first("__ts"), *[F.sum(name).alias(name) for name in measures])
        )
    return totals.select(
        local_date("__day.start").alias("cur_date"),
        *keys,
        *[F.col(f"__c.{c}").alias(c) for c in [*found, *carried]],
        *measures,
    )
