"""Dimension lookups: left joins that never change the number of rows.

No broadcast hints: Spark broadcasts a dimension when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise, where adaptive
execution splits skewed keys (the dimension side has one row per key).
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Changing(Protocol):
    """A dimension that changes while a stream runs, see ``waybill.streaming.lookups``."""

    def meet(self, facts: DataFrame, on: Mapping[str, str], take: Mapping[str, str], prefer: str = "id") -> DataFrame: ...


def one_row_per_key(dim: DataFrame, keys: list[str], take: list[str], prefer: str = "id") -> DataFrame:
    """One row per key. When several match, the one with the smallest ``prefer`` wins."""
    rest = [c for c in dict.fromkeys([prefer, *take]) if c not in keys]
    if not rest:
        return dim.select(*keys).distinct()
    best = F.min(F.struct(*rest)).alias("__best")
    grouped = dim.groupBy(*keys).agg(best)
    return grouped.select(*keys, *[F.col("__best")[c].alias(c) for c in rest])


def lookup_join(
    df: DataFrame,
    dim: DataFrame | Changing | None,
    on: Mapping[str, str],
    take: Mapping[str, str],
    unique: bool = False,
    prefer: str = "id",
) -> DataFrame:
    """Left join ``dim`` on ``{fact column: dim column}``, taking ``{dim column: new name}``.

    ``unique`` says the dim columns are the table's primary key, so nothing has to be
    reduced. A missing or null key leaves nulls. A name already in ``df`` is replaced. A
    dimension that is a stream of changes is met as it is when a row of ``df`` arrives.
    """
    if dim is None:
        raise ValueError(f"no dimension table for {list(on)}: its source is missing from the config")
    if not isinstance(dim, DataFrame):
        return dim.meet(df, on, take, prefer)
    if not unique:
        dim = one_row_per_key(dim, list(on.values()), list(take), prefer)
    right = dim.select(
        *[F.col(d).alias(f"__k{i}") for i, d in enumerate(on.values())],
        *[F.col(d).alias(f"__v{i}") for i, d in enumerate(take)],
    )
    condition = F.lit(True)
    for i, fact in enumerate(on):
        condition = condition & (F.col(fact) == F.col(f"__k{i}"))
    names = list(take.values())
    return df.join(right, condition, "left").select(
        *[F.col(c) for c in df.columns if c not in names],
        *[F.col(f"__v{i}").alias(name) for i, name in enumerate(names)],
    )


def region_climb(df: DataFrame, region: DataFrame, city: str = "city_id") -> DataFrame:
    """City id to city name, province id and province name."""
    named = lookup_join(
        df, region, {city: "id"}, {"name": "city_name", "parent_id": "province_id"}, unique=True
    )
    return lookup_join(named, region, {"province_id": "id"}, {"name": "province_name"}, unique=True)


def org_city(df: DataFrame, org: DataFrame, org_id: str = "org_id") -> DataFrame:
    """Org id to ``found_org_name`` and ``city_id``: the region of its parent, else its own."""
    home = org.select(
        "id", "org_name", F.coalesce("org_parent_id", "id").alias("join_org_id")
    )
    joined = lookup_join(
        df,
        home,
        {org_id: "id"},
        {"org_name": "found_org_name", "join_org_id": "join_org_id"},
        unique=True,
    )
    return lookup_join(
        joined, org, {"join_org_id": "id"}, {"region_id": "city_id"}, unique=True
    ).drop("join_org_id")
