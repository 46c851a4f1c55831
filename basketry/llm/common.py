"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import drop_stage, stage_table

#: Characters that separate words, as the body of a character class.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
SLICE = 256

__all__ = ["SPACE", "WORD", "bind", "crc_mod", "drop_stage", "packed", "slices", "slices_of", "stage_table", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(key: str | Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo `modulus`. A null key counts as the empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, which is evaluated once.

    The optimizer copies a projected expression into every place that uses it, so a column that a
    lambda reads for each element would be computed again for each element. A lambda variable is not copied.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """The rows as one column `doc` beside the given keys, so that no column of theirs can clash in a join. `doc.*` unpacks them."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), *[key.alias(name) for name, key in keys.items()])


def slices_of(batch: pa.RecordBatch, rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most `rows` rows."""
    return (batch.slice(start, rows) for start in range(0, batch.num_rows, rows))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[list[list]]:
    """The columns of at most `rows` rows at a time as Python lists, so that only those are unpacked."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield [part.column(i).to_pylist() for i in range(part.num_columns)]
