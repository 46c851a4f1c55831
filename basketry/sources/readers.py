"""Readers. Column lists and filters are given up front so that they reach the source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.sources.schemas import EXTRACT_FILTERS, RENAMED, TABLES


def columns_of(spark: SparkSession, table: str) -> list[str]:
    return spark.createDataFrame([], TABLES[table]).columns


def extract(
    spark: SparkSession,
    table: str,
    connection: dict[str, str],
    *,
    where: str | None = None,
    partition_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
) -> DataFrame:
    """Read a relational table over JDBC with its column list and filter pushed into the query.

    `connection` (url, user, password, driver) comes from the caller's configuration. With
    `partition_on` and its bounds the extract runs as parallel range queries.
    """
    options = dict(connection)
    if partition_on:
        low, high = bounds
        options |= {
            "partitionColumn": partition_on, "lowerBound": str(low), "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    loaded = spark.read.format("jdbc").options(dbtable=table, **options).load()
    predicate = where or EXTRACT_FILTERS.get(table)
    loaded = loaded.where(predicate) if predicate else loaded
    return conform(loaded, table)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select, rename and cast the declared columns of a raw table."""
    df = df.withColumnsRenamed(RENAMED.get(table, {}))
    schema = df.sparkSession.createDataFrame([], TABLES[table]).schema
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def landed(spark: SparkSession, folder: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """Read the landed copy of a raw table, all declared columns or a subset."""
    df = spark.read.schema(TABLES[table]).parquet(f"{folder.rstrip('/')}/{table}")
    return df.select(*columns) if columns else df


WINDOWS_1252 = "windows-1252"


def windows_1252(column: str) -> Column:
    """Text that was read as ISO-8859-1, as Windows-1252.

    The two differ in bytes 80-9F only. Spark reads the first but not the second, so the reader takes
    the first and this replaces those characters; the table comes from Python's codec.
    """
    codes = [c for c in range(0x80, 0xA0) if bytes([c]).decode("cp1252", "ignore")]
    read = "".join(chr(c) for c in codes)
    return F.translate(F.col(f"`{column}`"), read, bytes(codes).decode("cp1252"))


def read_text(spark: SparkSession, path: str | list[str], schema: str, encoding: str, **options) -> DataFrame:
    western = encoding.lower() == WINDOWS_1252
    df = spark.read.csv(
        path, schema=schema, encoding="ISO-8859-1" if western else encoding, quote='"', escape='"', **options
    )
    if not western:
        return df
    return df.withColumns({name: windows_1252(name) for name, kind in df.dtypes if kind == "string"})


def delimited(
    spark: SparkSession, path: str | list[str], schema: str, *, sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """Delimited text with a header line; `path` may be a glob that names many files."""
    return read_text(spark, path, schema, encoding, header=True, sep=sep)


def positional(
    spark: SparkSession, path: str | list[str], names: list[str], *, sep: str = ",", encoding: str = WINDOWS_1252
) -> DataFrame:
    """Delimited text without a header; every column is read as text under the given names."""
    schema = ", ".join(f"`{n}` string" for n in names)
    return read_text(spark, path, schema, encoding, header=False, sep=sep)


def sheet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A reference sheet, landed beforehand as comma text or as a column file."""
    if path.endswith(".csv"):
        return delimited(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal table."""
    return spark.createDataFrame(rows, schema)


def run_day(spark: SparkSession, day: dt.date) -> DataFrame:
    """A generated one-row table with the run day."""
    return spark.range(1).select(F.lit(day).alias("run_day"))


def web_dates(df: DataFrame, column: str = "date") -> DataFrame:
    """Web-analytics files write days as `YYYYMMDD`; header or junk lines get a null date."""
    return df.withColumn(column, F.to_date(F.try_to_timestamp(F.col(column), F.lit("yyyyMMdd"))))
