"""Near-duplicates by one-permutation MinHash with optimal densification, banded buckets and star-shaped candidate edges.

Texts with the same shingle set form a class, whose representative is its smallest id; all further steps see representatives only.
A signature has BANDS * ROWS bins: the hash range is cut into bins, each takes its smallest shingle hash, and an empty bin
borrows from the first filled bin in a random order of its own. ROWS bins make a band, and equal bands a
bucket. At the threshold a pair shares no bucket with chance (1 - 0.85 ** ROWS) ** BANDS, about 3e-7.

Within a bucket all members are compared with a centre, not with each other. The centre is the member whose buckets are largest in
total: the text that others were made from. A bucket whose members are then in one component is done. Else the members
outside its largest component are compared with all its members: in blocks of BLOCK of them, against which the bucket's
members are streamed, so that no row is made for a pair. A pair that shares a bucket is thereby compared or already connected.
Links are confirmed on the full shingle sets; components come from rounds of star contraction over the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import packed, slices, stage_table, table

SHINGLE = 5
#: Per cent of the union that two sets must share.
LINK = 85
BANDS, ROWS = 32, 6
BINS = BANDS * ROWS
#: Members of a bucket that one task compares with the others.
BLOCK = 256
MIX = np.uint64(0x9E3779B97F4A7C15)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r", " "))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """64-bit hash of a word; remembers words up to a bound."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode())
        if len(self) >= 200_000:
            self.clear()
        if len(word) <= 40:
            self[word] = value
        return value


def shingles(text: str | None, known: Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles; of all words if there are fewer; none without words."""
    words = [w for w in (text or "").translate(LOWER).translate(SPACES).split(" ") if w]
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    rows = len(words) - width + 1
    combined = np.full(rows, width, np.uint64)
    for i in range(width):
        combined = _mixed(combined * MIX + hashes[i:i + rows])
    return np.unique(combined)


@lru_cache(maxsize=1)
def _lenders() -> tuple[np.ndarray, np.ndarray]:
    """Lower ends of the bins, and per bin the rank of every bin in its own random order."""
    draw = np.random.default_rng(2017)
    order = np.argsort(draw.random((BINS, BINS)), axis=1)
    rank = np.empty((BINS, BINS), np.int16)
    np.put_along_axis(rank, order, np.arange(BINS, dtype=np.int16)[None, :], axis=1)
    ends = np.array([(i << 64) // BINS + (1 if (i << 64) % BINS else 0) for i in range(BINS)], np.uint64)
    return ends, rank


def signature(found: np.ndarray) -> np.ndarray:
    """The bins of a sorted, non-empty set."""
    ends, rank = _lenders()
    first = np.searchsorted(found, ends)
    after = np.append(first[1:], len(found))
    filled = np.flatnonzero(first < after)
    bins = found[np.minimum(first, len(found) - 1)]
    empty = np.flatnonzero(first >= after)
    if len(empty):
        bins[empty] = bins[filled[rank[np.ix_(empty, filled)].argmin(axis=1)]]
    return bins


def band_keys(bins: np.ndarray) -> np.ndarray:
    rows = bins.reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        keys = _mixed(keys * MIX + rows[:, i])
    return keys.view(np.int64)


def read_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, digest, bands) per row. Without words: n_shingles 0, no digest, no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for keys, hashes, texts in slices(batches):
            sets = [shingles(text, known) for text in texts]
            digests = [xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None for found in sets]
            bands = [band_keys(signature(found)).tolist() if len(found) else None for found in sets]
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array(hashes, pa.int64()), pa.array(list(map(len, sets)), pa.int64()),
                pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "digest", "bands"])

    picked = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return picked.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, shingles) of the representatives in `wanted` (rep, digest), made again from the whole texts.

    Merged and not broadcast: the wanted ids are not bounded, and rows of one id come one after the other that way, of
    which those with another set than the wanted one and repetitions are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last = Words(), None
        for keys, digests, texts in slices(batches):
            out: tuple[list, list] = ([], [])
            for key, digest, text in zip(keys, digests, texts):
                found = shingles(text, known).tobytes() if (key, digest) != last else b""
                if found and xxhash.xxh3_128_digest(found) == digest:
                    last = key, digest
                    out[0].append(key)
                    out[1].append(found)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], names=["rep", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    picked = texts.join(wanted.hint("merge"), "rep").select("rep", "digest", "text")
    return picked.mapInArrow(run, "rep long, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (centre, member) whose full sets share enough.

    Members' sets are shuffled to the centre, whose own set is read once per run of equal centres.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: tuple[list[int], list[int]] = ([], [])
            for start in range(0, batch.num_rows, 64):
                part, last, own = batch.slice(start, 64), None, None
                for centre, member, a, b in zip(*(part.column(i).to_pylist() for i in range(4))):
                    if centre != last:
                        last, own = centre, np.frombuffer(a, np.uint64)
                    other = np.frombuffer(b, np.uint64)
                    shared = len(np.intersect1d(own, other, assume_unique=True))
                    if 100 * shared >= LINK * (len(own) + len(other) - shared):
                        kept[0].append(centre)
                        kept[1].append(member)
            yield pa.RecordBatch.from_arrays([pa.array(kept[0], pa.int64()), pa.array(kept[1], pa.int64())], names=["centre", "member"])

    members = pairs.join(sets.select(F.col("rep").alias("member"), F.col("shingles").alias("other")), "member")
    both = members.join(sets.select(F.col("rep").alias("centre"), F.col("shingles").alias("own")), "centre")
    # A set may be hundreds of kilobytes, so few rows travel in a batch (see `spark.sql.execution.arrow.maxBytesPerBatch`).
    return both.select("centre", "member", "own", "other").mapInArrow(run, "centre long, member long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links` (a, b): root is the smallest node reachable.

    Large-star and small-star steps over the distinct links, stored after each round so that a lost executor costs one
    round. Each is a grouped minimum, combined before the shuffle, and a join back that can be split at a hub.
    """
    edges = stage_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage_table(large.filter("u <> v").distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage_table(small.unionByName(lowest.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state


def _buckets(reps: DataFrame) -> DataFrame:
    """(bucket, rep, weight) of the buckets with two members or more; weight: the sizes of all buckets of the representative."""
    rows = reps.select("rep", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = stage_table(rows.join(shared, "bucket"))
    weights = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    return stage_table(members.join(weights, "rep").select("bucket", "rep", "weight"))


def _in_blocks(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between members of a bucket that are outside its largest component (`major`) and all its members.

    `open_`: (bucket, rep, root, major, minor), minor being the number of such members. They are dealt into blocks; a task holds a
    block and reads the members of the bucket one after the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ready = None, None
        held: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            links: tuple[list, list] = ([], [])
            for start in range(0, batch.num_rows, 256):
                for bucket, block, guest, rep, root, data in zip(*(batch.slice(start, 256).column(i).to_pylist() for i in range(6))):
                    if (bucket, block) != at:
                        at, ready, held = (bucket, block), None, ([], [], [])
                    own = np.frombuffer(data, np.uint64)
                    if not guest:
                        for column, value in zip(held, (rep, root, own)):
                            column.append(value)
                        continue
                    if ready is None:
                        sizes = np.array(list(map(len, held[2])))
                        ready = np.array(held[0]), np.array(held[1]), sizes, np.concatenate(held[2]), np.repeat(np.arange(len(sizes)), sizes)
                    reps, roots, sizes, every, owner = ready
                    place = np.minimum(np.searchsorted(own, every), len(own) - 1)
                    shared = np.bincount(owner[own[place] == every], minlength=len(sizes))
                    linked = (roots != root) & (100 * shared >= LINK * (sizes + len(own) - shared))
                    for other in reps[linked].tolist():
                        links[0].append(other)
                        links[1].append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(links[0], pa.int64()), pa.array(links[1], pa.int64())], names=["a", "b"])

    blocks = F.ceil(F.col("minor") / BLOCK)
    hosts = open_.filter("root <> major").select("bucket", F.pmod(F.xxhash64("rep"), blocks).alias("block"), F.lit(0).alias("guest"), "rep", "root")
    guests = open_.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), F.lit(1).alias("guest"), "rep", "root")
    # A block that got no host needs no guest; hashing leaves few of them, and they find nothing.
    dealt = guests.join(hosts.select("bucket", "block").distinct(), ["bucket", "block"], "left_semi").unionByName(hosts).join(sets, "rep")
    laid = dealt.select("bucket", "block", "guest", "rep", "root", "shingles").repartition("bucket", "block").sortWithinPartitions("bucket", "block", "guest")
    return laid.mapInArrow(run, "a long, b long").distinct()


def link_classes(docs: DataFrame, reps: DataFrame) -> DataFrame | None:
    """(node, root) of the components of linked representatives (rep, digest, bands); null if no two share a bucket."""
    members = _buckets(reps)
    wanted = members.select("rep").distinct()
    if not wanted.take(1):
        return None
    sets = stage_table(_full_sets(docs, wanted.join(reps.select("rep", "digest"), "rep")))
    centres = members.groupBy("bucket").agg(
        F.max(F.struct("weight", (-F.col("rep")).alias("rep"))).alias("best")).select("bucket", (-F.col("best.rep")).alias("centre"))
    pairs = members.join(centres, "bucket").filter("rep <> centre").groupBy(
        F.greatest("centre", "rep").alias("x"), F.least("centre", "rep").alias("y")).agg(F.min("centre").alias("centre"))
    pairs = stage_table(pairs.select("centre", (F.col("x") + F.col("y") - F.col("centre")).alias("member")))
    links = stage_table(_confirmed(pairs, sets).select(F.col("centre").alias("a"), F.col("member").alias("b")))
    roots = stage_table(components(links))
    marked = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("root", "rep").alias("root"))
    parts = marked.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    several = parts.groupBy("bucket").agg(
        F.max_by("root", F.struct("n", "root")).alias("major"), (F.sum("n") - F.max("n")).alias("minor")).filter("minor > 0")
    open_ = stage_table(marked.join(several, "bucket"))
    more = stage_table(_in_blocks(open_, sets))
    if not more.take(1):
        return roots
    return stage_table(components(links.unionByName(more)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) per row of `docs` (doc_id, text).

    Null texts and texts without words are linked with nothing, not even with each other. Rows with one id share a
    component if their texts do; if such an id is the smallest of several texts, these count as linked. Ids are compared as numbers, and a null id is its own component, kept. Other columns are not read.
    """
    read = stage_table(read_documents(docs))
    reps = stage_table(read.filter("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))
    roots = link_classes(docs, reps)
    classes = reps.select("digest", "rep")
    if roots is not None:
        classes = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("root", "rep").alias("root"))
    else:
        classes = classes.withColumnRenamed("rep", "root")
    found = read.select("doc_id", "text_hash", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return found.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, of which one document of each component stays; of equal rows one stays."""
    kept = near_duplicates(docs).filter("kept").select("doc_id", "text_hash")
    rows = packed(docs, own_id=docs["doc_id"].cast("long"), own_hash=F.xxhash64(docs["text"]))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & F.col("own_hash").eqNullSafe(F.col("text_hash"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["own_id", "own_hash"]).select("doc.*")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")
