"""Unions by name and wide-to-long reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack_frames(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing in one frame becomes null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unpivot_columns(
    df: DataFrame, ids: list[str], columns: dict[object, str], name: str, value: str
) -> DataFrame:
    """One row per id and non-null wide column; `columns` maps the label to the wide column."""
    pairs: list[Column] = [
        F.struct(F.lit(label).alias(name), F.col(column).alias(value)) for label, column in columns.items()
    ]
    long = df.select(*ids, F.explode(F.array(*pairs)).alias("__pair")).select(*ids, "__pair.*")
    return long.where(F.col(value).isNotNull())
