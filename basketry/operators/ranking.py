"""Row numbers that survive hot groups and whole-table orders."""

from __future__ import annotations

from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, FractionalType, IntegralType, TimestampNTZType, TimestampType

from basketry.session import stage_table


def running_counts(
    df: DataFrame,
    group: str,
    bucket: str,
    order: list[Column | str],
    counters: dict[str, Column],
) -> DataFrame:
    """Running number per group of the rows that meet each condition (null where it is not met).

    The sequence is `bucket` first (a date, say), then `order` within the bucket, together a total order. Segmented prefix
    sums: the table is laid out in ranges of (group, bucket, order), so a group, or a single bucket of it, that holds a third of
    the rows spreads over many ranges. A window numbers the rows of a group within one range only; the counts of
    the group in earlier ranges are added from a table with the first and the last group of each range, the only ones that
    can go on in another. Rows without a group or bucket get null.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = F.col(group).isNotNull() & F.col(bucket).isNotNull()
    hits = {f"__hit_{out}": F.when(counted & cond, 1).otherwise(0) for out, cond in counters.items()}
    # Staged, because the ranges are drawn anew whenever the layout is computed.
    laid = stage_table(
        df.withColumns(hits).repartitionByRange(parts, group, bucket, *order).withColumn("__part", F.spark_partition_id())
    )
    edges = laid.where(counted).groupBy("__part").agg(F.min(group).alias("__low"), F.max(group).alias("__high"))
    at_edge = laid.where(counted).join(F.broadcast(edges), "__part").where(
        (F.col(group) == F.col("__low")) | (F.col(group) == F.col("__high"))
    )
    sums = at_edge.groupBy("__part", group).agg(*[F.sum(hit).alias(hit) for hit in hits])
    earlier = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "__part", F.col(group).alias("__edge"), *[F.coalesce(F.sum(hit).over(earlier), F.lit(0)).alias(f"__before{hit}") for hit in hits]
    )
    within = (
        Window.partitionBy("__part", group).orderBy(bucket, *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbered = laid.withColumns({f"__in{hit}": F.sum(hit).over(within) for hit in hits})
    # Size bound of the broadcasts: one row and two rows per range.
    joined = numbered.alias("__rows").join(
        F.broadcast(offsets.withColumnRenamed("__part", "__of")), (F.col("__part") == F.col("__of")) & (F.col(group) == F.col("__edge")), "left"
    )
    return joined.withColumns({
        out: F.when(F.col(hit) == 1, F.coalesce(f"__before{hit}", F.lit(0)) + F.col(f"__in{hit}"))
        for out, hit in zip(counters, hits)
    }).select(*df.columns, *counters)


def laid_out(df: DataFrame, order: list[Column]) -> tuple[DataFrame, Column, int]:
    """The table in a total `order`, the rank of each of its rows (from 1), and the number of rows.

    The table is range-partitioned on the full order (the tie-breaker keeps equal values splittable),
    sorted per partition and staged with its row positions, so that they stay fixed. One count per
    partition comes back to the driver for the partition offsets; no task sees the whole table.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = stage_table(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("__pos", F.monotonically_increasing_id())
    )
    # monotonically_increasing_id keeps the partition in the upper 31 bits, the row in the lower 33.
    part = F.shiftright("__pos", 33)
    sizes = {r["p"]: r["n"] for r in laid.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    starts, seen = [], 0
    for p in range(max(sizes, default=0) + 1):
        starts.append(seen)
        seen += sizes.get(p, 0)
    offset = F.element_at(F.expr(f"array({', '.join(f'{s}L' for s in starts)})"), part.cast("int") + 1)
    return laid, offset + F.col("__pos").bitwiseAND(F.lit((1 << 33) - 1)) + 1, seen


def rank_rows(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """1, 2, 3 ... over the whole table in a total `order`."""
    laid, rank, _ = laid_out(df, order)
    return laid.withColumn(out, rank).drop("__pos")


#: Bins of a histogram: each pass narrows a border's range to one of them, or to less if its values lie closer.
BINS = 1024
#: Stand for null, beyond every number of 37 digits or every float in use.
NULL_WHOLE, NULL_FLOAT = 10**37, 1e300


def constant(value: int | float) -> Column:
    """A whole number of any size, or a float, as a constant."""
    return F.lit(value) if isinstance(value, float) else F.lit(str(value)).cast("decimal(38,0)")


def ordered_number(df: DataFrame, column: str, descending: bool) -> Column:
    """A number, date or instant as a number in ascending order, exactly; nulls first if ascending, else last.

    Floats stay floats (NaN has no place); all others become whole numbers.
    """
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):
        value = value.cast("double")
        return F.coalesce(-value if descending else value, constant(NULL_FLOAT if descending else -NULL_FLOAT))
    if isinstance(kind, DateType):
        value = F.unix_date(value)
    elif isinstance(kind, (TimestampType, TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    elif isinstance(kind, DecimalType) and kind.scale <= 6:  # more digits would be rounded on the way
        value = value.cast("decimal(38,%d)" % kind.scale) * F.lit(10**kind.scale)
    elif not isinstance(kind, IntegralType):
        raise TypeError(f"{column}: {kind.simpleString()} has no exact numbers")
    value = value.cast("decimal(38,0)")
    return F.coalesce(-value if descending else value, constant(NULL_WHOLE if descending else -NULL_WHOLE))


def cell_of(key: Column, low: int | float, high: int | float) -> Column:
    """The bin of a key within [low, high]. Never decreases with the key, and differs between the two ends."""
    if isinstance(low, float):
        return F.floor((key - constant(low)) / constant((high - low) / BINS or 1.0)).cast("int")
    width = max(1, -(-(high - low + 1) // BINS))
    return F.call_function("div", key - constant(low), constant(width)).cast("int")


def borders(df: DataFrame, targets: list[tuple[list[str], int]], numbers: dict[str, Column], ends: dict[str, tuple]) -> list[list]:
    """Per target (keys, rank): the keys of the row with that rank, as far as they tell rows apart.

    `numbers` has the numbers of all keys, `ends` their least and greatest values. Histograms of all targets at once, narrowed
    to the bin that holds the rank, down to one value; rows that tie there go on to the next key alone. Each pass is an
    aggregation to at most BINS rows per target; nothing is sorted.
    """
    found: list[list] = [[] for _ in targets]
    left = {j: rank for j, (_, rank) in enumerate(targets)}  # the rank within the rows that tie with the target so far
    ranges = {j: ends[keys[0]] for j, (keys, _) in enumerate(targets)}
    while left:
        cells = []
        for j in left:
            keys = targets[j][0]
            key, (low, high) = numbers[keys[len(found[j])]], ranges[j]
            tests = [key.between(constant(low), constant(high)), *[numbers[k] == constant(v) for k, v in zip(keys, found[j])]]
            cell = F.struct(F.lit(j).alias("j"), cell_of(key, low, high).alias("cell"))
            cells.append(F.when(reduce(lambda a, b: a & b, tests), cell))
        pass_keys = {targets[j][0][len(found[j])] for j in left}
        counted = df.select(
            *[numbers[k].alias(f"number_{k}") for k in pass_keys], F.explode(F.array_compact(F.array(*cells))).alias("c")
        ).groupBy("c").agg(F.count("*").alias("n"), *[end(f"number_{k}").alias(f"{name}_{k}") for k in pass_keys for name, end in (("low", F.min), ("high", F.max))])
        for j, group in groupby(sorted(counted.collect(), key=lambda r: (r["c"]["j"], r["c"]["cell"])), key=lambda r: r["c"]["j"]):
            keys, level = targets[j][0], len(found[j])
            for row in group:
                if left[j] <= row["n"]:
                    break
                left[j] -= row["n"]
            kind = float if isinstance(ranges[j][0], float) else int
            ranges[j] = low, high = kind(row[f"low_{keys[level]}"]), kind(row[f"high_{keys[level]}"])
            if low == high:
                found[j].append(low)
                # All rows of the tie are up to the border, or it is the last key: nothing more to tell apart.
                if left[j] == row["n"] or level + 1 == len(keys):
                    del left[j]
                else:
                    ranges[j] = ends[keys[level + 1]]
    return found


def rank_buckets(df: DataFrame, orders: dict[str, list[tuple[str, bool]]], buckets: int) -> DataFrame:
    """Per new column `ceil(rank / (n / buckets))` over the whole table, in the column's order of (column, descending).

    Differs from `ntile` when n is not a multiple of `buckets`. An order is total but for rows that are equal in it. Only the last
    rows of the buckets are looked for (`borders`, for all orders together); then each row is compared with them. No row is
    ranked and no table shuffled. `df` is read once per pass: stage it first.
    """
    named = {f"{column}_{descending:d}": (column, descending) for order in orders.values() for column, descending in order}
    numbers = {name: ordered_number(df, *of) for name, of in named.items()}
    first = df.agg(F.count("*").alias("n"), *[end(v).alias(f"{e}_{k}") for k, v in numbers.items() for e, end in (("low", F.min), ("high", F.max))]).first()
    rows, kinds = first["n"], {k: float if dict(df.dtypes)[c] in ("float", "double") else int for k, (c, _) in named.items()}
    ranks = [rows * k // buckets for k in range(1, buckets)]
    keys = {out: [f"{column}_{descending:d}" for column, descending in order] for out, order in orders.items()}
    targets = [(keys[out], rank) for out in orders for rank in ranks if rank]
    ends = {k: (kinds[k](first[f"low_{k}"]), kinds[k](first[f"high_{k}"])) for k in numbers} if rows else {}
    lasts = iter(borders(df, targets, numbers, ends))
    classes = {}
    for out in orders:
        bucket = F.lit(1)
        for rank in ranks:
            if rank:
                last = next(lasts)
                row = F.struct(*[numbers[k].alias(f"k{i}") for i, k in enumerate(keys[out][: len(last)])])
                bucket = bucket + F.when(row > F.struct(*[constant(v).alias(f"k{i}") for i, v in enumerate(last)]), 1).otherwise(0)
            else:
                bucket = bucket + 1
        classes[out] = bucket.cast("int")
    return df.withColumns(classes)


def number_months(df: DataFrame, order: list[Column | str], out: str) -> DataFrame:
    """1, 2, 3 ... over a table with one row per calendar month (at most 119,988): a global window."""
    return df.withColumn(out, F.row_number().over(Window.orderBy(*order)))
