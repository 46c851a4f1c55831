"""Writers: column files, delimited exports, dated and replaceable snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def store(df: DataFrame, path: str, *, partition_by: list[str] | None = None) -> None:
    """Replace a column file.

    A partitioned write is rebalanced on its partition columns first: AQE then merges small pieces
    and splits a large one, so neither many tiny files nor one huge task results.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def narrow_copy(df: DataFrame, columns: list[str], path: str) -> None:
    """Store a column subset. Jobs need no such copy (scans prune columns); exports may want one."""
    store(df.select(*columns), path)


def export(df: DataFrame, path: str, *, sep: str = ",", order: list | None = None) -> None:
    """Delimited text with a header. A sorted export is range-partitioned: its part files, read in
    name order, are the total order, and no task holds the whole result."""
    ordered = df.orderBy(*order) if order else df
    ordered.write.mode("overwrite").csv(path, header=True, sep=sep, quote='"', escape='"')


def exists(df_or_spark, path: str) -> bool:
    """True when the path holds anything, on whatever file system it names."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def upsert_snapshot(df: DataFrame, path: str, date_column: str) -> DataFrame:
    """Append dated rows and replace the rows of the dates in `df`; returns the whole snapshot.

    The table is partitioned by the date and only those partitions are overwritten, so older dates
    are neither read nor rewritten, and a rerun of a day replaces that day.
    """
    (
        df.hint("rebalance", date_column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column).parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def dated_snapshot(df: DataFrame, path: str, day: dt.date, column: str = "snapshot_date") -> DataFrame:
    """Keep one result per run day under a date partition."""
    return upsert_snapshot(df.withColumn(column, F.lit(day)), path, column)


def history_or_empty(spark, path: str, schema: str) -> DataFrame:
    """The stored history, or an empty frame of the same schema on the first run."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
