"""Mixing sources to target weights by pivotal dependent rounding.

Every document gets a fractional number of copies, target / size of its source. The whole part is taken at once. The
fractional parts meet in pairs: words are moved at random from one to the other, without changing the
expectation of either or the sum of both, until one of them is whole. Each block of documents leaves
at most one fractional document; these meet again, level by level, until one is left per source, which goes to
the nearer side. So a source misses its target by at most half a document. The draws are hashes of the document
ids and the blocks follow from ids and counts alone, so reruns and lost executors change nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import WORD, packed, stage_table, table
from basketry.operators.ranking import rank_rows

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Documents that meet in one task, and residuals of blocks that meet in one of the next level.
BLOCK = 8192
FAN = 1024
UNITS = (
    "doc_id long, size long, source_size long, target double, copies long, part double, source_no long, block long, open boolean"
)


def word_count(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_no, source_size, source_rows, target) of (source, size).

    Weights repeat in code point order, null last. Targets share SHARE of all sizes by weight; those beyond
    MOST times their source's size stop there and the rest is shared again. Each round is one aggregate of
    the source table that returns two numbers.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    ranked = rank_rows(sums, [F.col("source").isNull(), F.col("source")], "source_no")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("source_no") - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = stage_table(ranked.withColumn("weight", weight))
    cap = F.col("source_size") * MOST
    goal = SHARE * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    rate = 0.0
    while True:
        full = cap < F.lit(rate) * F.col("weight")
        held, free = ranked.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        after = (goal - (held or 0)) / free if free else rate
        if after <= rate:
            break
        rate = after
    target = F.least(cap.cast("double"), F.lit(rate) * F.col("weight"))
    return ranked.select("source", "source_no", "source_size", "source_rows", target.alias("target"))


def _draw(first: int | None, second: int | None, seed: int) -> float:
    """A number in [0, 1) from two ids."""
    mask = (1 << 64) - 1
    x = seed
    for part in (first or 0, second or 0):
        x = (x ^ (part & mask)) + 0x9E3779B97F4A7C15 & mask
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        x ^= x >> 31
    return (x >> 11) / (1 << 53)


def _pivot(kept: dict, met: dict, seed: int) -> tuple[list[dict], dict | None]:
    """The documents that became whole, and the one that did not."""
    up = min((1 - kept["part"]) * kept["size"], met["part"] * met["size"])
    down = min(kept["part"] * kept["size"], (1 - met["part"]) * met["size"])
    raised, lowered, moved = (kept, met, up) if _draw(kept["doc_id"], met["doc_id"], seed) * (up + down) < down else (met, kept, down)
    fills = (1 - raised["part"]) * raised["size"] <= moved
    empties = lowered["part"] * lowered["size"] <= moved
    raised["part"] = 1.0 if fills else raised["part"] + moved / raised["size"]
    lowered["part"] = 0.0 if empties else lowered["part"] - moved / lowered["size"]
    whole, rest = [], None
    for unit in (raised, lowered):
        if unit["part"] in (0.0, 1.0):
            unit["copies"] += int(unit["part"])
            unit["open"] = False
            whole.append(unit)
        else:
            rest = unit
    return whole, rest


def _round(units: DataFrame, last: bool, seed: int) -> DataFrame:
    """One level of the tree: blocks are read in order, and only one fractional document is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        schema = None

        def close(unit: dict) -> dict:
            if last:
                unit["copies"] += int(unit["part"] >= 0.5)
                unit["open"] = False
            return unit

        for batch in batches:
            schema, done = batch.schema, []
            for unit in batch.to_pylist():
                if held and (held["source_no"], held["block"]) != (unit["source_no"], unit["block"]):
                    done.append(close(held))
                    held = None
                if held is None:
                    held = unit
                else:
                    whole, held = _pivot(held, unit, seed)
                    done += whole
            yield pa.RecordBatch.from_pylist(done, schema)
        if held:
            yield pa.RecordBatch.from_pylist([close(held)], schema)

    # Long documents first: what is left over at the end is short.
    laid = units.repartition("source_no", "block").sortWithinPartitions("source_no", "block", F.desc("size"), "doc_id")
    return laid.mapInArrow(run, UNITS)


def mix(docs: DataFrame, seed: int = 7, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) per row of `docs` (doc_id, text, source).

    Null texts and texts without words have size 0: they keep the whole part of their copies and take no words.
    Rows with the same id are rounded separately. An empty table gives an empty result. Other columns are not read.
    A hot source is spread over its blocks; the source table meets the documents in a join that may be broadcast
    if its stored size is small and is split by the skew handling of the session if not.
    """
    sizes = stage_table(docs.select("doc_id", "source", word_count("text").alias("size")))
    targets = stage_table(source_targets(sizes))
    share = F.coalesce(F.col("target") / F.col("source_size"), F.lit(0.0))
    same = sizes["source"].eqNullSafe(targets["source"])
    part = F.when(F.col("size") > 0, share - F.floor(share)).otherwise(0.0)
    blocks = F.ceil(F.col("source_rows") / block)
    units = sizes.join(targets, same).select(
        F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target",
        F.floor(share).alias("copies"), part.alias("part"), "source_no",
        F.pmod(F.xxhash64("doc_id"), blocks).alias("block"), (part > 0).alias("open"),
    )
    decided = [units.filter(~F.col("open"))]
    open_units = units.filter("open")
    most = math.ceil((targets.agg(F.max("source_rows")).first()[0] or 0) / block)
    while most:
        level = stage_table(_round(open_units, most == 1, seed))
        decided.append(level.filter(~F.col("open")))
        open_units = level.filter("open").withColumn("block", F.floor(F.col("block") / fan))
        most = 0 if most == 1 else math.ceil(most / fan)
    whole = decided[0]
    for level in decided[1:]:
        whole = whole.unionByName(level)
    return whole.select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, each as often as the mix takes it. Rows with one id are taken equally often."""
    copies = mix(docs).groupBy("doc_id").agg(F.max("copies").alias("copies")).filter("copies > 0")
    rows = packed(docs, own_id=docs["doc_id"].cast("long"))
    taken = rows.join(copies, F.col("own_id").eqNullSafe(F.col("doc_id"))).select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return taken.select("doc.*")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mix(table(spark, sf_dir, "documents"))
