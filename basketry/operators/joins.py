"""Joins. No function here hints a broadcast for a side of unknown size: Catalyst broadcasts a side below its size threshold
and otherwise shuffles, and AQE splits the hot partitions of the left side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

KEY = object()


def natural_left(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join with the shared columns written out. `right` holds one row per key."""
    return left.join(right, on, "left")


def full_on(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    return left.join(right, on, "full_outer")


def key_list(on: str | list[str]) -> list[str]:
    return [on] if isinstance(on, str) else on


def semi(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key exists in `keys`.

    The keys are made distinct first: that combines a hot key on the map side, while the right side
    of a semi join is otherwise shuffled row by row and cannot be split.
    """
    return df.join(keys.select(*key_list(on)).distinct(), on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key does not exist in `keys` (distinct for the same reason as in `semi`)."""
    return df.join(keys.select(*key_list(on)).distinct(), on, "left_anti")


#: Hot keys looked for at most, and counters of the sketch, which finds every key with more than about 1/6000 of the rows.
MOST_HOT, COUNTERS = 1024, 8192


def one_key(on: str | list[str]) -> Column:
    """The key as one column: itself, or several columns as one text."""
    keys = key_list(on)
    return F.col(keys[0]) if len(keys) == 1 else F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})


def hot_keys(df: DataFrame, on: str | list[str]) -> list[tuple[object, int]]:
    """(key, splits) of the keys that hold more rows than two even shares of a shuffle's partitions, most rows first.

    One pass over the key column: mergeable frequent-item counters (Misra-Gries) per task, merged to one sketch of fixed size.
    `splits` is the number of even shares that the key's rows make up. Null keys are left out.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = one_key(on)
    row = df.where(key.isNotNull()).agg(F.call_function("approx_top_k", key, F.lit(MOST_HOT), F.lit(COUNTERS)).alias("top"), F.count("*").alias("n")).first()
    return [(top["item"], -(-top["count"] * parts // row["n"])) for top in row["top"] or [] if top["count"] * parts > 2 * row["n"]]


def left_many(left: DataFrame, right: DataFrame, on: str | list[str], like: DataFrame | None = None) -> DataFrame:
    """Left join to a side that holds many rows per key, a third of them under one key perhaps.

    An outer join cannot split a hot key on its right side. So the hot keys are found first; their right rows are dealt by a
    hash of the whole row, and their left rows repeated for each deal. A hot key has right rows, so a repeated left row that finds
    none in its deal is dropped, and no left row without a partner is lost: those have no hot key. All other keys are
    joined as they are. Each side is read once by the join, and the key column once more before it: from `like`, if given, a
    frame whose keys all occur in `right`, such as the table that `right` adds columns to.
    """
    keys = key_list(on)
    columns = [*keys, *[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys]]
    hot = hot_keys(right if like is None else like, on)
    if not hot:
        return left.join(right, keys, "left").select(*columns)
    spark, kind = right.sparkSession, right.select(one_key(on).alias("__hot")).schema["__hot"].dataType
    # Size bound: at most MOST_HOT rows.
    splits = F.broadcast(spark.createDataFrame(hot, StructType([StructField("__hot", kind), StructField("__splits", LongType())])))

    def with_splits(df: DataFrame) -> DataFrame:
        return df.withColumn("__key", one_key(on)).join(splits, F.col("__key") == F.col("__hot"), "left").drop("__key", "__hot")

    repeated = with_splits(left).withColumn("__deal", F.explode(F.sequence(F.lit(0), F.coalesce("__splits", F.lit(1)) - 1)))
    dealt = with_splits(right).select(
        *right.columns, F.pmod(F.xxhash64(*right.columns), F.coalesce("__splits", F.lit(1))).alias("__deal"), F.lit(True).alias("__found")
    )
    joined = repeated.join(dealt, [*keys, "__deal"], "left")
    return joined.where(F.col("__splits").isNull() | F.col("__found")).select(*columns)


def lookup(
    df: DataFrame,
    table: DataFrame,
    key: str,
    take: dict[str, tuple[str, object]],
    *,
    table_key: str | None = None,
    order: list[Column | str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Add columns looked up by one key, never multiplying rows.

    `take` maps the new column to (table column, default). The default applies only when the key is
    absent: a null stored in the table stays null. A default of `KEY` returns the key itself.
    When the table may repeat a key, the first entry in `order` (default: smallest values) wins;
    pass `unique=True` for a table keyed by its primary key to save that aggregation.
    """
    wanted = sorted({source for source, _ in take.values()})
    entry = F.struct(*[F.col(c) for c in wanted])
    keyed = table.where(F.col(table_key or key).isNotNull()).select(
        F.col(table_key or key).alias("__key"), entry.alias("__entry"),
        F.struct(*(order or [entry])).alias("__order"),
    )
    if unique:
        keyed = keyed.drop("__order")
    else:
        keyed = keyed.groupBy("__key").agg(F.min_by("__entry", "__order").alias("__entry"))
    joined = df.join(keyed, F.col(key) == F.col("__key"), "left")
    found = F.col("__key").isNotNull()
    added = {
        out: F.when(found, F.col(f"__entry.{source}")).otherwise(
            F.col(key) if default is KEY else F.lit(default)
        )
        for out, (source, default) in take.items()
    }
    return joined.withColumns(added).drop("__key", "__entry")


def star_lookup(
    df: DataFrame, key: str, entries: DataFrame, wanted: dict[str, tuple[str, str]], default: object = None
) -> DataFrame:
    """Add labels of several id columns from one table (kind, id, label), all in one join.

    `wanted` maps each new column to (kind, id column). Every row becomes one small row per id, beside one that carries
    the row itself under a key of its own; these meet the entries in one join on (kind, id) and are put together again by
    aggregation on `key`, which names the rows uniquely. So `df` is computed once and no lookup shuffles whole rows. `default`
    stands for ids without an entry; a null label of an entry stays null. An entry's (kind, id) is unique.

    The small rows are dealt by `key` before they are aggregated: structs are put together by sorting, and a sort of all rows
    of a map task, of which none combine where the join has scattered them, would be as large as its input times the ids.
    """
    id_type = entries.schema["id"].dataType
    row = F.struct(*df.columns)

    def slot(number: int, kind: str, value: Column, carried: Column) -> Column:
        return F.struct(F.lit(number).alias("slot"), F.lit(kind).alias("kind"), value.cast(id_type).alias("id"), carried.alias("row"))

    nothing = F.when(F.lit(False), row)
    slots = [slot(0, "", F.xxhash64(key), row)] + [
        slot(i, kind, F.col(column), nothing) for i, (kind, column) in enumerate(wanted.values(), 1)
    ]
    # Null ids have no entry; left out, they cannot crowd in one partition.
    long = df.select(F.col(key).alias("key"), F.explode(F.array(*slots)).alias("s")).select("key", "s.*").where("id is not null")
    found = long.join(entries.select("kind", "id", F.struct("label").alias("entry")), ["kind", "id"], "left")
    wide = found.select("key", "slot", "row", "entry").repartition("key").groupBy("key").agg(
        F.max("row").alias("row"), *[F.max(F.when(F.col("slot") == i, F.col("entry"))).alias(f"entry_{i}") for i in range(1, len(slots))]
    )
    labels = {
        out: F.when(F.col(f"entry_{i}").isNotNull(), F.col(f"entry_{i}.label")).otherwise(F.lit(default))
        for i, out in enumerate(wanted, 1)
    }
    return wide.select("row.*", *[label.alias(out) for out, label in labels.items()])


def has_key(df: DataFrame, keys: DataFrame, key: str, out: str, *, table_key: str | None = None) -> DataFrame:
    """Add a 1/0 column that says whether the key exists in `keys`."""
    distinct = keys.select(F.col(table_key or key).alias("__key")).where("__key is not null").distinct()
    joined = df.join(distinct, F.col(key) == F.col("__key"), "left")
    return joined.withColumn(out, F.when(F.col("__key").isNotNull(), 1).otherwise(0)).drop("__key")


def month_table(df: DataFrame) -> DataFrame:
    """Mark a frame with one row per calendar month for broadcasting.

    Size bound: dates span the years 1-9999, so at most 119,988 months exist; a few numbers each
    keep the table under ten megabytes however large the facts are. Joining facts on the month by a
    shuffle would instead put a whole month into one task.
    """
    return F.broadcast(df)
