"""Stored tables in key buckets: joins and groups on the key read them without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def bucket_count(spark: SparkSession) -> int:
    """One bucket per shuffle partition, so a bucketed table also meets a shuffled frame without moving itself."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store_buckets(df: DataFrame, path: str, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """Replace the bucketed table `name` with its files under `path`, and read it back.

    The frame is dealt by the hash that buckets use before it is written, so each bucket is one sorted file. Meant for keys that
    are unique or nearly so: a bucket holds all rows of a key.
    """
    spark, buckets = df.sparkSession, buckets or bucket_count(df.sparkSession)
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)


def open_buckets(spark: SparkSession, path: str, name: str, schema: str, key: str, buckets: int) -> DataFrame:
    """Declare stored buckets to a session whose catalogue does not know them, and read them."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
