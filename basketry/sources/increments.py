"""Incremental loads: only touched key ranges are rewritten, only new files are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.grouping import merge_latest
from basketry.session import stage_table
from basketry.sources import writers
from basketry.sources.manifest import Store

BUCKET = "key_bucket"


def id_range(key: str, width: int = 1_000_000) -> Column:
    """Bucket of a running number: ids that were given out together lie together, as do their changes."""
    return F.floor(F.col(key) / F.lit(width)).cast("long")


def merge_into(incoming: DataFrame, path: str, keys: list[str], version: str, bucket: Column) -> list[int]:
    """Merge new and changed rows into a stored table of key buckets; returns the buckets that were rewritten.

    `bucket` is a function of the keys. The table is a folder per bucket. Only buckets with an incoming key are read, merged (largest
    `version` wins, the incoming row among equals) and replaced; files of all others stay. The merged rows are staged first, so
    a lost task never reads what is being replaced, and a run that broke while replacing can be repeated: merging the
    same rows again changes nothing. The list has a row per touched bucket, never per key.
    """
    marked = stage_table(incoming.withColumn(BUCKET, bucket))
    touched = sorted(row[0] for row in marked.select(BUCKET).distinct().collect())
    if not touched:
        return []
    merged = merge_latest(marked.limit(0), marked, keys, version)
    if writers.exists(incoming.sparkSession, path):
        stored = incoming.sparkSession.read.schema(marked.schema).parquet(path).where(F.col(BUCKET).isin(touched))
        merged = merge_latest(stored, marked, keys, version)
    (
        stage_table(merged).hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET).parquet(path)
    )
    return touched


def merged_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stored table without its bucket column."""
    if not writers.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*spark.createDataFrame([], schema).columns)


LEDGER = "path string, length long, modified timestamp, digest string"


def file_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, digest) of text files, from their lines in any order: their number and two sums of hashes."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.xxhash64("value").alias("a"), F.hash("value").alias("b"))
    sums = lines.groupBy("path").agg(
        F.count("*").alias("n"), F.bit_xor("a").alias("x"), F.sum(F.col("a").cast("decimal(20,0)")).alias("s"), F.sum("b").alias("t"))
    return sums.select("path", F.concat_ws(":", "n", "x", "s", "t").alias("digest"))


def load_new_files(
    spark: SparkSession, pattern: str, path: str, schema: str, read: Callable[[list[str]], DataFrame]
) -> tuple[DataFrame, int]:
    """All rows loaded so far under `path`, after the files that match `pattern` and were not loaded before; and their number.

    The ledger keeps path, length, time of change and digest of each file. Files it has are not opened; of the others
    those with a digest it has (copies, moved files) are noted but not loaded again. Rows and ledger become visible together.
    """
    store = Store(spark, path)
    ledger = store.read(LEDGER, "ledger")
    seen = spark.read.format("binaryFile").load(pattern).select("path", "length", F.col("modificationTime").alias("modified"))
    unknown = stage_table(seen.join(ledger.drop("digest"), ["path", "length", "modified"], "left_anti"))
    paths = [row[0] for row in unknown.select("path").collect()]
    if not paths:
        return store.read(schema, "data"), 0
    noted = unknown.join(file_digests(spark, paths), "path", "left").withColumn("digest", F.coalesce("digest", F.lit("0")))
    noted = stage_table(noted.select("path", "length", "modified", "digest"))
    fresh = noted.where("digest <> '0'").join(ledger.select("digest").distinct(), "digest", "left_anti")
    chosen = sorted(row[0] for row in fresh.groupBy("digest").agg(F.min("path")).select(F.col("min(path)")).collect())
    entry = {"ledger": store.write(noted)}
    if chosen:
        entry["data"] = store.write(read(chosen))
    store.publish(entry)
    return store.read(schema, "data"), len(chosen)
