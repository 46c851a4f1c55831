"""Ordered picks per group. All are aggregations with map-side combining, so a hot key shrinks to
one row per map task before the shuffle; none collects a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(
    df: DataFrame,
    keys: str | list[str],
    order: list[Column | str],
    take: list[str] | dict[str, str],
    *,
    latest: bool = False,
) -> DataFrame:
    """One row per key with the columns of its first (or latest) row in a total `order`."""
    keys = [keys] if isinstance(keys, str) else keys
    take = {c: c for c in take} if isinstance(take, list) else take
    row = F.struct(*[F.col(source).alias(out) for out, source in take.items()])
    pick = (F.max_by if latest else F.min_by)(row, F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(pick).select(*keys, "__row.*")


def merge_latest(stored: DataFrame, incoming: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Incremental merge: new and updated rows replace stored rows of the same key.

    The row with the largest `version` wins; at equal versions the incoming row wins.
    """
    columns = stored.columns
    both = stored.withColumn("__new", F.lit(0)).unionByName(
        incoming.select(columns).withColumn("__new", F.lit(1))
    )
    rest = [c for c in columns if c not in keys]
    return first_by(both, keys, [version, "__new"], rest, latest=True).select(columns)
