"""Language-model scoring by a hierarchical Pitman-Yor process.

A word is drawn in the restaurant of its context: the whole word before it (END before the first one), so there are as many restaurants as words.
All of them share one parent, the restaurant of words without context, whose base measure is even over the training words
and one more, which stands for any unknown word. Customers of a context restaurant are the training tokens; each table
of it sends one customer to the parent. The numbers of tables are sampled by Gibbs: a sweep redraws the tables of every pair of context and word
given the totals of its restaurant and the parent's probability of the word, then the parent's tables of every word; the totals follow after each sweep.
A draw is a function of context, word and sweep, so any number of partitions and any repeated task gives the same tables.
A pair of one customer has one table at any time, so only the other pairs are drawn. The predictive probability of a word is the mean of
those of the last draws, each with the tables and totals of its own sweep.

Data flow: arrays, not rows, are moved. Texts become chunks of word numbers with a dictionary each. Owners of hashes number the words (two
words found to share a hash have all words hashed by another seed) and hold the totals of theirs, a bucket the pairs of its contexts; a context of very many pairs is dealt over
several buckets. A bucket sends an owner the sums of its pairs, as one block for both, and gets back the totals of the words that it has, in the order agreed at
the start, so no block carries names. A chunk asks the buckets for each of its pairs once. Sums of blocks come to the driver, one row
per task; nothing per word, context or pair does, but for the contexts that are dealt. Nothing is approximated or left out.
"""

from __future__ import annotations

import itertools
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cache
from math import exp, lgamma, log, pi, sin

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import crc_mod, drop_stage, slices_of, stage_table, table

#: Ends every text and is the context of its first word.
END = "\n"
#: A context of more pairs than this, counted in each chunk, is dealt over several buckets. Chunks name those of a 4096th of their pairs or more.
HOT, SHARE = 1 << 17, 4096
#: Tokens (and bytes of words) at which a chunk is closed; tokens that a bucket is made for; buckets to an owner.
CHUNK, CHUNK_BYTES, BUCKET, PER_OWNER = 2_000_000, 128 << 20, 2_500_000, 2
#: Turns in which chunks are scored; each has its share of them on the way at once, and the pairs anew.
TURNS = 2
#: Discount and strength of the context restaurants and of their parent.
DISCOUNT, STRENGTH = 0.8, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 1.0
#: Sweeps that settle the tables; draws after them that are averaged.
SWEEPS = 3
KEPT = 3
#: Tables of up to this many customers are drawn from their exact conditional; those of more by rejection.
EXACT = 1024
#: Rows of about as many customers are drawn together, in matrices of at most CELLS numbers.
CLASSES = (2, 3, 4, 8, 16, 32, 64, 128, 256, 512, EXACT)
CELLS = 1 << 16
#: Below this share of customers ** discount, tables are few; the number of terms that their probabilities need then.
FEW, TERMS = 0.05, 30
#: Numbers of tables proposed at once for a row of more than EXACT customers.
PROPOSED = 256
#: Such rows whose first customers are seated together.
TOGETHER = 16
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz     ")


def tokens(text: str | None) -> tuple[list[str], list[str]]:
    """Words and END, and the context of each: the plain form of what `_words` does to many texts at once."""
    words = [word for word in (text or "").translate(LOWER).split(" ") if word]
    return [*words, END], [END, *words]


# ---------------------------------------------------------------- words and blocks

def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and how many each has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    of = pc.list_parent_indices(lists).filter(full).to_numpy(zero_copy_only=False)
    return words.filter(full), np.bincount(of, minlength=len(texts))


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and bytes of texts."""
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64, len(words) + 1, 8 * words.offset)
    return np.diff(ends), np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]


def _texts_of(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


P1, P2, P3, P4, P5 = (np.uint64(n) for n in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def hashes(sizes: np.ndarray, data: np.ndarray, seeds: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """xxhash64 of texts, as Spark has it, each with a seed of its own; of the texts `rows`, or of all."""
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    rows = np.arange(len(sizes)) if rows is None else rows
    lengths, out = sizes[rows], np.empty(len(rows), np.uint64)
    order = np.argsort(lengths, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if not len(group):
            continue
        size = int(lengths[group[0]])
        for part in np.array_split(group, -(-len(group) * max(size, 1) // (CELLS << 2)) or 1):
            out[part] = _hashes_of_one_size(data, starts[rows[part]], size, seeds[part])
    return out


def _hashes_of_one_size(data: np.ndarray, starts: np.ndarray, size: int, seeds: np.ndarray) -> np.ndarray:
    cells = data[starts[:, None] + np.arange(size)]

    def lane(at: int, kind: str = "<u8") -> np.ndarray:
        return np.ascontiguousarray(cells[:, at:at + np.dtype(kind).itemsize]).view(kind)[:, 0].astype(np.uint64)

    at = 0
    with np.errstate(over="ignore"):
        if size >= 32:
            v = [seeds + P1 + P2, seeds + P2, seeds.copy(), seeds - P1]
            while at <= size - 32:
                v = [_turned(x + lane(at + 8 * i) * P2, 31) * P1 for i, x in enumerate(v)]
                at += 32
            h = _turned(v[0], 1) + _turned(v[1], 7) + _turned(v[2], 12) + _turned(v[3], 18)
            for x in v:
                h = (h ^ (_turned(x * P2, 31) * P1)) * P1 + P4
        else:
            h = seeds + P5
        h = h + np.uint64(size)
        while at <= size - 8:
            h = _turned(h ^ (_turned(lane(at) * P2, 31) * P1), 27) * P1 + P4
            at += 8
        if at <= size - 4:
            h = _turned(h ^ (lane(at, "<u4") * P1), 23) * P2 + P3
            at += 4
        for i in range(at, size):
            h = _turned(h ^ (cells[:, i].astype(np.uint64) * P5), 11) * P1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


@cache
def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, signed integers as narrow as they allow."""
    out = []
    for array in arrays:
        if narrow := array.dtype.kind == "i":
            ends = (array.min(), array.max()) if len(array) else (0, 0)
            array = array.astype(np.result_type(np.int8, *[np.min_scalar_type(end) for end in ends]) if max(ends) < 1 << 31 else np.int64)
        # Bytes of one weight stand together, as the higher ones differ less.
        raw = np.ascontiguousarray(array).view(np.uint8).reshape(-1, array.dtype.itemsize).T.copy()
        data = _codec().compress(raw, asbytes=True) if raw.nbytes else b""
        out += [struct.pack("<c?qq", array.dtype.char.encode(), narrow, raw.nbytes, len(data)), data]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    """The arrays of `pack`, signed integers as 64 bits."""
    out, at, head = [], 0, struct.calcsize("<c?qq")
    while at < len(data):
        kind, narrow, size, length = struct.unpack_from("<c?qq", data, at)
        at += head
        form = np.dtype(kind.decode())
        raw = np.frombuffer(_codec().decompress(data[at:at + length], size) if size else b"", np.uint8)
        array = raw.reshape(form.itemsize, -1).T.copy().view(form).reshape(-1)
        out.append(array.astype(np.int64) if narrow else array)
        at += length
    return out


ROW = "to long, kind string, src long, data binary"
Block = tuple[int, str, int, bytes]


def _rows(blocks: Iterator[Block]) -> Iterator[pa.RecordBatch]:
    for to, kind, src, data in blocks:
        yield pa.RecordBatch.from_arrays([pa.array([to], pa.int64()), pa.array([kind]), pa.array([src], pa.int64()), pa.array([data], pa.binary())], names=["to", "kind", "src", "data"])


def _grouped(groups: int, parts: list[DataFrame], run: Callable[[int, dict[str, list]], Iterator], out: str = ROW, rows: Callable = _rows, tasks: int | None = None) -> DataFrame:
    """`run` over each group: its number and, by kind, the unpacked blocks sent to it, each with its sender, in the senders' order."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = defaultdict(list)
        for batch in batches:
            for to, kind, src, data in zip(*(batch.column(c).to_pylist() for c in ("to", "kind", "src", "data"))):
                held[to].append((kind, src, data))
        for to in sorted(held):
            given: dict[str, list] = defaultdict(list)
            for kind, src, data in sorted(held.pop(to), key=lambda row: row[:2]):
                given[kind].append((src, *unpack(data)))
            yield from rows(run(to, given))

    return both.select("to", "kind", "src", "data").repartitionById(tasks or groups, F.col("to").cast("int")).mapInArrow(task, out)


def _few(groups: int) -> int:
    """Tasks for groups of little data."""
    return min(groups, max(8, groups // 4))


def _kept(blocks: DataFrame) -> DataFrame:
    return stage_table(blocks, "kind")


def _drop(blocks: DataFrame, *kinds: str) -> None:
    """Delete staged blocks of some kinds that nothing reads any more."""
    spark = blocks.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in blocks.inputFiles()}:
        if folder.rsplit("/kind=", 1)[-1] in kinds:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _of(blocks: DataFrame, *kinds: str) -> DataFrame:
    return blocks.filter(F.col("kind").isin(*kinds)).select("to", "kind", "src", "data")


def _sums(blocks: DataFrame, size: int) -> list[int]:
    """Sums of the totals that tasks sent to the driver."""
    rows = [unpack(row.data)[0] for row in _of(blocks, "total").select("data").collect()]
    return [int(sum(int(row[i]) for row in rows)) for i in range(size)]


def _slices(of: np.ndarray, groups: int) -> Iterator[tuple[int, np.ndarray]]:
    """(group, its places) of those that have any; places keep their order."""
    order = np.argsort(of, kind="stable")
    ends = np.cumsum(np.bincount(of, minlength=groups))
    for group, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
        if end > start:
            yield group, order[start:end]


def _joined(blocks: list, place: int) -> np.ndarray:
    return np.concatenate([block[place] for block in blocks]) if blocks else np.empty(0, np.int64)


def _placed(blocks: list, place: int, order: np.ndarray) -> np.ndarray:
    """What the owners sent, put back from their order."""
    joined = _joined(blocks, place)
    out = np.empty_like(joined)
    out[order] = joined
    return out


# ---------------------------------------------------------------- chunks

@dataclass(frozen=True)
class Chunks:
    """Texts as numbers: (chunk, data), the number of tokens, and the seed of the words' hashes."""

    rows: DataFrame
    ids: np.ndarray
    tokens: int
    seed: int


def chunk_table(docs: DataFrame, seed: int = 42) -> Chunks:
    """Chunks of (doc_id, text, learn), with the hashes and texts of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held = TaskContext.get().partitionId(), itertools.count(), []

        def close() -> pa.RecordBatch:
            encoded = pa.concat_arrays([words for words, *_ in held]).dictionary_encode()
            sizes, data = _bytes_of(pa.concat_arrays([encoded.dictionary.cast(pa.large_string()), pa.array([END], pa.large_string())]))
            named = hashes(sizes, data, np.full(len(sizes), seed, np.uint64))
            order = np.argsort(named, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            lengths, learn, ids, known = (np.concatenate([row[i] for row in held]) for i in range(1, 5))
            sequence = np.full(len(encoded) + len(lengths), place[-1])
            sequence[np.arange(len(encoded)) + np.repeat(np.arange(len(lengths)), lengths)] = place[encoded.indices.to_numpy(zero_copy_only=False)]
            sizes, data = _bytes_of(_texts_of(sizes, data).take(pa.array(order)))
            out = [[task << 32 | next(number)], [len(sequence)], [pack(ids, known, lengths + 1, learn, sequence, named[order], sizes, data)]]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["chunk", "tokens", "data"])

        size, volume = 0, 0
        for batch in batches:
            for part in slices_of(batch):
                words, lengths = _words(part.column("text"))
                ids = part.column("doc_id")
                held.append((words, lengths, part.column("learn").fill_null(False).to_numpy(zero_copy_only=False),
                             ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False)))
                size, volume = size + len(words) + len(lengths), volume + words.nbytes
                if size >= CHUNK or volume >= CHUNK_BYTES:
                    yield close()
                    size = volume = 0
        if held:
            yield close()

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("learn").cast("boolean"))
    rows = stage_table(picked.mapInArrow(run, "chunk long, tokens long, data binary"))
    sizes = rows.select("chunk", "tokens").collect()
    return Chunks(rows, np.sort(np.array([row.chunk for row in sizes], np.int64)), sum(row.tokens for row in sizes), seed)


def _codes(sequence: np.ndarray, words: int) -> np.ndarray:
    """context * words + word of each token of a chunk. The last token is an END, the context of the first."""
    return np.concatenate((sequence[-1:], sequence[:-1])) * words + sequence


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Places of the first of each run of equal numbers."""
    return np.flatnonzero(np.concatenate((np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1])))


def _distinct(codes: np.ndarray) -> np.ndarray:
    codes = np.sort(codes)
    return codes[_firsts(codes)]


@dataclass(frozen=True)
class Places:
    """Where words and pairs are held. An owner's words have the numbers owner, owner + owners, ... in the order of their hashes."""

    buckets: int
    owners: int
    #: Contexts that are dealt, in order, and over how many buckets.
    dealt: np.ndarray
    splits: np.ndarray

    def owner(self, words: np.ndarray) -> np.ndarray:
        return (words % np.uint64(self.owners)).astype(np.int64)

    def by_owner(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words, those of one owner together, and the ends of all owners' but the last."""
        owners = self.owner(words)
        return np.argsort(owners, kind="stable"), np.cumsum(np.bincount(owners, minlength=self.owners))[:-1]

    def bucket(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        def mixed(words: np.ndarray) -> np.ndarray:
            with np.errstate(over="ignore"):
                return words * P1 >> np.uint64(32)

        at = mixed(contexts) % np.uint64(self.buckets)
        if len(self.dealt):
            found = np.minimum(np.searchsorted(self.dealt, contexts), len(self.dealt) - 1)
            hot = self.dealt[found] == contexts
            at[hot] = (at[hot] + mixed(words[hot]) % self.splits[found[hot]]) % np.uint64(self.buckets)
        return at.astype(np.int64)


    def rank(self, words: np.ndarray) -> np.ndarray:
        """Places of words among their owner's."""
        return (words // np.uint64(self.owners)).astype(np.int64)

    def numbers(self, owner: int, ranks: np.ndarray) -> np.ndarray:
        return ranks.astype(np.uint64) * np.uint64(self.owners) + np.uint64(owner)


def _places(tokens_: int) -> Places:
    buckets = max(-(-tokens_ // BUCKET), 1)
    return Places(buckets, max(buckets // PER_OWNER, 1), np.empty(0, np.uint64), np.empty(0, np.uint64))


def _dealt(places: Places, chunks: Chunks) -> Places:
    """With the contexts that have more than HOT pairs."""
    each = chunks.rows.select(F.explode(F.arrays_zip("names", "degrees")).alias("one")).groupBy(F.col("one.names").alias("name")).agg(F.sum("one.degrees").alias("n"))
    hot = sorted((row.name, -(-row.n // HOT)) for row in each.filter(F.col("n") > HOT).collect())
    return replace(places, dealt=np.array([h for h, _ in hot], np.uint64), splits=np.array([n for _, n in hot], np.uint64))


#: Number of a word that `fit` has not read.
UNKNOWN = np.uint64(2**63 - 1)


def _numbered(chunks: Chunks, places: Places, told: DataFrame) -> Chunks:
    """The chunks with numbers and training tokens of their words instead of hashes and texts, and the contexts of many pairs.

    `told` has the owners' blocks `ids`. The old rows are removed.
    """

    def run(chunk: int, given: dict[str, list]) -> Iterator[pa.RecordBatch]:
        (_, ids, known, lengths, learn, sequence, named), = given["chunk"]
        told = {owner: block for owner, *block in given["ids"]}
        numbers, counts = np.full(len(named), UNKNOWN), np.full(len(named), -1)
        for owner, rows in _slices(places.owner(named), places.owners):
            if owner in told:
                numbers[rows], counts[rows] = told[owner]
        order = np.argsort(numbers, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sequence, numbers = place[sequence], numbers[order]
        pairs = _distinct(_codes(sequence, len(order)))
        degrees = np.bincount(pairs // len(order), minlength=len(order))
        most = np.flatnonzero(degrees > len(pairs) // SHARE)
        out = [[chunk], [numbers[most].astype(np.int64).tolist()], [degrees[most].tolist()], [pack(ids, known, lengths, learn, sequence, numbers, counts[order])]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()))],
                                         names=["chunk", "names", "degrees", "data"])

    own = _sent(chunks, lambda chunk, given: iter([(chunk, "chunk", 0, pack(*given[:6]))]))
    rows = stage_table(_grouped(max(len(chunks.ids), 1), [own, _of(told, "ids")], run, "chunk long, names array<long>, degrees array<long>, data binary", iter))
    drop_stage(chunks.rows)
    return replace(chunks, rows=rows, ids=np.arange(len(chunks.ids)))


def _sent(chunks: Chunks, run: Callable[[int, list[np.ndarray]], Iterator[Block]]) -> DataFrame:
    """The blocks that `run` makes of each chunk."""
    ids = chunks.ids

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _rows(run(int(np.searchsorted(ids, batch.column(0)[i].as_py())), unpack(batch.column(1)[i].as_py())))

    return chunks.rows.select("chunk", "data").mapInArrow(task, ROW)


def _pair_blocks(places: Places, named: np.ndarray, pairs: np.ndarray) -> Iterator[tuple[int, np.ndarray, tuple]]:
    """(bucket, places in `pairs`, contexts, pairs of each, words)."""
    contexts, words = named[pairs // len(named)], named[pairs % len(named)]
    for bucket, rows in _slices(places.bucket(contexts, words), places.buckets):
        mine = contexts[rows]
        first = _firsts(mine)
        yield bucket, rows, (mine[first], np.diff(np.append(first, len(mine))), words[rows])


# ---------------------------------------------------------------- draws

@cache
def stirling(discount: float) -> np.ndarray:
    """log of the generalised Stirling numbers of up to EXACT customers and tables."""
    s = np.full((EXACT + 1, EXACT + 1), -np.inf)
    s[1, 1] = 0
    for n in range(1, EXACT):
        tables = np.arange(1, n + 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(tables <= n, s[n, 1:n + 2] + np.log(np.maximum(n - discount * tables, 1e-300)), -np.inf)
        s[n + 1, 1:n + 2] = np.logaddexp(s[n, :n + 1], stay)
    return s


def uniforms(keys: np.ndarray, seed: int, first: int, count: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on nothing but a row's key, the seed and their place: row by row, from `first` on."""
    with np.errstate(over="ignore"):
        place = np.uint64(seed) * np.uint64(1 << 20) + np.arange(first, first + count, dtype=np.uint64)
        x = keys.astype(np.uint64)[:, None] + (place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)) * 2.0**-53 + 2.0**-54


def _expected_tables(customers: int, discount: float, strength: float) -> float:
    """Of a restaurant without base measure."""
    s, d = strength, discount
    return exp(lgamma(s + 1) - lgamma(s + d) + lgamma(customers + s + d) - lgamma(customers + s)) / d - s / d


def _draw_few(customers: int, mean: float, discount: float, rng: np.random.Generator) -> int:
    """A draw where the tables are far fewer than customers ** discount: near to one more than a Poisson number.

    The conditional of t is mean ** t / t! times the coefficient of x ** customers in (1 - (1 - x) ** discount) ** t, whose binomial series
    falls fast then.
    """
    spread = 12 * mean**0.5 + 30
    t = np.arange(max(1, int(mean - spread)), int(mean + spread) + 1, dtype=float)
    term, size, coefficient = np.ones(len(t)), 0.0, np.zeros(len(t))
    for j in range(1, TERMS):
        last, size = size, lgamma(customers - discount * j) - lgamma(customers - discount) + lgamma(1 + discount * j) - lgamma(1 + discount)
        term *= (t - j + 1) / j * exp(size - last)
        coefficient += (-1) ** (j + 1) * term * sin(pi * discount * j) / sin(pi * discount)
    logs = t * log(mean) - np.array([lgamma(n + 1) for n in t]) + np.log(np.maximum(coefficient, 1e-300))
    sums = np.exp(logs - logs.max()).cumsum()
    return int(t[np.searchsorted(sums, rng.random() * sums[-1], side="right")])


def _fitted(customers: int, opening: float, discount: float) -> float | None:
    """The strength of the restaurant that proposes for `_draw_many`; None where tables are few."""
    d, low, high = discount, -discount * (1 - 1e-9), opening + discount
    if opening / d < FEW * customers**d:
        return None
    for _ in range(60):
        s = (low + high) / 2
        low, high = (s, high) if _expected_tables(customers, d, s) < (opening - s) / d + 1 else (low, s)
    return s


def _first_seated(customers: int, strengths: list[float], discount: float, rngs: list[np.random.Generator]) -> np.ndarray:
    """PROPOSED numbers of tables for each of several restaurants, whose customers are seated one by one, but together."""
    s, t = np.array(strengths)[:, None], np.ones((len(rngs), PROPOSED))
    chances = np.empty((customers - 1, *t.shape))
    for i, rng in enumerate(rngs):
        chances[:, i] = rng.random((customers - 1, PROPOSED))
    for n in range(1, customers):
        t += chances[n - 1] < (s + discount * t) / (n + s)
    return t.astype(np.int64)


def _draw_many(customers: int, opening: float, discount: float, rng: np.random.Generator, seated: np.ndarray | None = None) -> int:
    """A draw from the conditional for more than EXACT customers: from its probabilities if there are far fewer tables, else by rejection.

    Given its number of customers, a restaurant of any strength s has t tables with a probability of the conditional's, times
    (s + d) ... (s + (t - 1) d) / opening ** t. So t is proposed by seating customers there, with the s for which that factor is least where
    most proposals are, and accepted by its reciprocal. Customers after EXACT are seated in strides of a 64th, at the rate in the middle of the stride.
    `seated` has the first proposals' tables after EXACT customers, if they were seated with those of other rows.
    """
    d, s = discount, _fitted(customers, opening, discount)
    if s is None:
        return _draw_few(customers, opening / d, d, rng)

    def weight(t: int) -> float:
        return t * log(opening / d) - lgamma(s / d + t)

    best = weight(max(1, int((opening - s) / d) + 1))
    while True:
        n = min(customers, EXACT)
        t, seated = _first_seated(n, [s], d, [rng])[0] if seated is None else seated, None
        while n < customers:
            stride = min(n // 64, customers - n)
            rate = np.minimum((s + d * t) / (n + (stride - 1) / 2 + s), 1)
            t = t + (rng.binomial(stride, rate) if stride > 1 else rng.random(PROPOSED) < rate)
            n += stride
        chances = rng.random(PROPOSED)
        for proposed, chance in zip(t.tolist(), chances.tolist()):
            if chance < exp(min(0.0, weight(proposed) - best)):
                return proposed


def draw_tables(customers: np.ndarray, opening: np.ndarray, discount: float, keys: np.ndarray, seed: int) -> np.ndarray:
    """Numbers of tables of a word: `customers` of it, and the weight `opening` of a new table at any time.

    Draws belong to the row's key, so they are the same in any batch, order and partition.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    many = np.flatnonzero(customers > 1)
    if not len(many):
        return tables
    c, a, k = customers[many], opening[many], keys[many]
    seated, t = np.minimum(c, EXACT), np.ones(len(c), np.int64)
    lowest = 1
    for widest in CLASSES:
        rows = np.flatnonzero((seated > lowest) & (seated <= widest))
        for part in np.array_split(rows, -(-len(rows) * widest // CELLS) or 1):
            weights = stirling(discount)[seated[part], 1:widest + 1] + np.arange(1, widest + 1) * np.log(a[part])[:, None]
            t[part] = (weights - np.log(-np.log(uniforms(k[part], seed, 0, widest)))).argmax(axis=1) + 1
        lowest = widest
    # Rows of more, of which there are few.
    rows = np.flatnonzero(seated < c).tolist()
    for part in (rows[i:i + TOGETHER] for i in range(0, len(rows), TOGETHER)):
        rngs = {i: np.random.Generator(np.random.Philox(key=np.array([int(k[i]) & (1 << 64) - 1, seed], np.uint64))) for i in part}
        fitted = {i: s for i in part if (s := _fitted(int(c[i]), float(a[i]), discount)) is not None}
        proposed = dict(zip(fitted, _first_seated(EXACT, [*fitted.values()], discount, [rngs[i] for i in fitted]))) if fitted else {}
        for i in part:
            t[i] = _draw_many(int(c[i]), float(a[i]), discount, rngs[i], proposed.get(i))
    tables[many] = t
    return tables


# ---------------------------------------------------------------- the seating

def _root_opening(root_tables: float, words: int) -> float:
    return (ROOT_STRENGTH + ROOT_DISCOUNT * root_tables) / (words + 1)


def _parent(customers: np.ndarray, tables: np.ndarray, opening: float, root_customers: int) -> np.ndarray:
    """Probabilities of words without context."""
    return (customers - ROOT_DISCOUNT * tables + opening) / (ROOT_STRENGTH + root_customers)


@dataclass(frozen=True)
class Totals:
    """The seating, as blocks of words (`nodes`) and of pairs (`cells`), and the openings and customers of the parent in each draw that is kept."""

    spark: SparkSession
    places: Places
    seed: int
    nodes: DataFrame
    cells: DataFrame
    roots: list[tuple[float, int]]

    @property
    def contexts(self) -> DataFrame:
        """(context, room, spare): sum of all weights of a restaurant, and for each draw that is kept those of the parent."""
        return self._named().filter("tokens_after > 0 or is_context").select("word", "room", "spare").withColumnRenamed("word", "context")

    @property
    def words(self) -> DataFrame:
        """(word, count, root): training tokens, and for each draw that is kept the probability without context."""
        return self._named().select("word", "count", "root")

    @property
    def pairs(self) -> DataFrame:
        """(context, word, count, fixed): training tokens, and customers less discounted tables, the mean of the draws."""
        places = self.places

        def run(to: int, given: dict[str, list]) -> Iterator[pa.RecordBatch]:
            contexts, words, of, at, counts, fixed, _ = _cells(places, given, [])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (contexts[of].astype(np.int64), words[at].astype(np.int64), counts, fixed)], names=["c", "w", "count", "fixed"])

        found = _grouped(self.places.buckets, [_of(self.cells, "cells", "tables")], run, "c long, w long, count long, fixed double", iter)
        names = self._named().select("number", "word")
        contexts = names.select(F.col("number").alias("c"), F.col("word").alias("context"))
        return found.join(contexts, "c").join(names.withColumnRenamed("number", "w"), "w").select("context", "word", "count", "fixed")

    def _named(self) -> DataFrame:
        places, roots = self.places, self.roots

        def run(to: int, given: dict[str, list]) -> Iterator[pa.RecordBatch]:
            (_, _, _, sizes, data), = given["words"]
            (_, tokens_, after, follows), = given["base"]
            tables = [node[1] for node in given["node"]]
            parents = [_parent(customers, sat, *root) for (_, _, customers, sat), root in zip(given["node"], roots)]
            lists = [pa.array(np.stack(rows, axis=1).tolist(), pa.list_(pa.float64())) for rows in ([STRENGTH + DISCOUNT * t for t in tables], parents)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places.numbers(to, np.arange(len(sizes))).astype(np.int64)), _texts_of(sizes, data).cast(pa.string()), pa.array(tokens_), pa.array(after), pa.array(follows > 0),
                 pa.array(STRENGTH + after), *lists], names=["number", "word", "count", "tokens_after", "is_context", "room", "spare", "root"])

        return _grouped(self.places.owners, [_of(self.nodes, "words", "base", "node")], run,
                        "number long, word string, count long, tokens_after long, is_context boolean, room double, spare array<double>, root array<double>", iter)


def _vocabulary(chunks: Chunks, places: Places) -> DataFrame:
    """Blocks `words` of the owners: hashes in order, training tokens, texts; `ids` to the chunks, numbers and training tokens; and totals: tokens, words,
    words whose hash another word has."""

    def send(chunk: int, given: list[np.ndarray]) -> Iterator[Block]:
        _, _, lengths, learn, sequence, named, sizes, data = given
        counts = np.bincount(sequence[np.repeat(learn, lengths)], minlength=len(named))
        texts = _texts_of(sizes, data)
        for owner, rows in _slices(places.owner(named), places.owners):
            yield owner, "words", chunk, pack(named[rows], counts[rows], *_bytes_of(texts.take(pa.array(rows))))

    def run(owner: int, given: dict[str, list]) -> Iterator[Block]:
        blocks = given["words"]
        named, counts = _joined(blocks, 1), _joined(blocks, 2)
        texts = _texts_of(_joined(blocks, 3), _joined(blocks, 4))
        order = np.argsort(named, kind="stable")
        named = named[order]
        first = _firsts(named)
        of = np.repeat(first, np.diff(np.append(first, len(named))))
        other = len(named) - int(pc.sum(pc.equal(texts.take(pa.array(order)), texts.take(pa.array(order[of])))).as_py())
        counts = np.add.reduceat(counts[order], first)
        ranks = np.empty(len(order), np.int64)
        ranks[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        for (chunk, *_), rank in zip(blocks, np.split(ranks, np.cumsum([len(block[1]) for block in blocks])[:-1])):
            yield chunk, "ids", owner, pack(places.numbers(owner, rank), counts[rank])
        yield owner, "words", 0, pack(named[first], counts, *_bytes_of(texts.take(pa.array(order[first]))))
        yield owner, "total", owner, pack(np.array([counts.sum(), (counts > 0).sum(), other]))

    return _kept(_grouped(places.owners, [_sent(chunks, send)], run))


def _count(chunks: Chunks, places: Places) -> DataFrame:
    """Blocks `cells` of the buckets: contexts and words, pairs of each context, the words and training tokens of these. `drawn` has those of more than
    one customer alone. To the owners go `first`, with tokens, pairs and pairs of one customer, and `subs`, the contexts and words of the drawn pairs."""

    def send(chunk: int, given: list[np.ndarray]) -> Iterator[Block]:
        _, _, lengths, learn, sequence, named, _ = given
        marked = np.sort(_codes(sequence, len(named)) * 2 + np.repeat(learn, lengths))
        first = _firsts(marked >> 1)
        pairs, counts = marked[first] >> 1, np.add.reduceat(marked & 1, first)
        for bucket, rows, (contexts, degrees, words) in _pair_blocks(places, named, pairs):
            yield bucket, "pairs", chunk, pack(contexts, degrees, words, counts[rows])

    def run(bucket: int, given: dict[str, list]) -> Iterator[Block]:
        blocks = given["pairs"]
        contexts, followers = np.unique(_joined(blocks, 1)), _joined(blocks, 3)
        words = _distinct(followers)
        codes = np.concatenate([np.repeat(np.searchsorted(contexts, block[1]), block[2]) for block in blocks]) * len(words) + np.searchsorted(words, followers)
        order = np.argsort(codes)
        codes = codes[order]
        first = _firsts(codes)
        counts = np.add.reduceat(_joined(blocks, 4)[order], first)
        of, word = np.divmod(codes[first], len(words))
        yield bucket, "cells", 0, pack(contexts, words, np.bincount(of, minlength=len(contexts)), word, counts)
        yield from to_owners("first", bucket, contexts, words, [
            np.bincount(of, counts, len(contexts)).astype(np.int64), *[np.bincount(of[rows], minlength=len(contexts)) for rows in (counts > 0, counts == 1, counts >= 0)]],
            [np.bincount(word[rows], minlength=len(words)) for rows in (counts > 0, counts == 1)])
        drawn = counts > 1
        if not drawn.any():
            return
        kept_c, of = np.unique(of[drawn], return_inverse=True)
        kept_w, word = np.unique(word[drawn], return_inverse=True)
        contexts, words = contexts[kept_c], words[kept_w]
        yield bucket, "drawn", 0, pack(contexts, words, np.bincount(of, minlength=len(contexts)), word, counts[drawn])
        yield from to_owners("subs", bucket, contexts, words, [], [])

    def to_owners(kind: str, bucket: int, contexts: np.ndarray, words: np.ndarray, of_context: list, of_word: list) -> Iterator[Block]:
        sent = []
        for found, more in ((contexts, of_context), (words, of_word)):
            order, ends = places.by_owner(found)
            sent += [np.split(array[order], ends) for array in (found, *more)]
        for owner, block in enumerate(zip(*sent)):
            if len(block[0]) or len(block[1 + len(of_context)]):
                yield owner, kind, bucket, pack(*block)

    return _kept(_grouped(places.buckets, [_sent(chunks, send)], run))


def _owned(places: Places, vocabulary: DataFrame, counted: DataFrame) -> DataFrame:
    """Blocks of the owners: `base` (training tokens, tokens after it, pairs as a context), `state` (hashes, pairs of one customer by context and by word), `subs`
    (places of the bucket's contexts and words). To the buckets go `reply`, as in each sweep, and `names`, the texts of its words and the hashes of its contexts."""

    def run(owner: int, given: dict[str, list]) -> Iterator[Block]:
        (_, named, tokens_, sizes, data), = given["words"]
        after, types_c, single_c, follows, types_w, single_w = (np.zeros(len(named), np.int64) for _ in range(6))
        for _, contexts, *of_context, words, types, single in given["first"]:
            at = places.rank(contexts)
            for total, part in zip((after, types_c, single_c, follows), of_context):
                total[at] += part
            at = places.rank(words)
            types_w[at] += types
            single_w[at] += single
        yield owner, "base", 0, pack(tokens_, after, follows)
        yield owner, "state", 0, pack(named, single_c, single_w)
        yield owner, "total", owner, pack(np.array([types_w.sum()]))
        texts = _texts_of(sizes, data)
        for bucket, contexts, words in given["subs"]:
            c, w = places.rank(contexts), places.rank(words)
            yield owner, "subs", bucket, pack(c, w)
            yield bucket, "reply", owner, pack(types_c[c], types_w[w], np.minimum(types_w[w], 1))
            yield bucket, "names", owner, pack(*_bytes_of(texts.take(pa.array(w))), named[c])

    return _kept(_grouped(places.owners, [_of(vocabulary, "words"), _of(counted, "first", "subs")], run))


def _keyed(places: Places, counted: DataFrame, owned: DataFrame) -> DataFrame:
    """Blocks `drawn` of the buckets: contexts' and words' places by owner, with the owners' ends, pairs of each context, each pair's word, customers and key."""

    def run(bucket: int, given: dict[str, list]) -> Iterator[Block]:
        (_, contexts, words, degrees, word, counts), = given["drawn"]
        sizes, data = _joined(given["names"], 1), _joined(given["names"], 2)
        agreed = [*places.by_owner(contexts), *places.by_owner(words)]
        keys = hashes(sizes, data, np.repeat(_placed(given["names"], 3, agreed[0]), degrees), np.argsort(agreed[2])[word])
        yield bucket, "drawn", 0, pack(*agreed, degrees, word, counts, keys)

    return _kept(_grouped(places.buckets, [_of(counted, "drawn"), _of(owned, "names")], run))


def _seat(places: Places, keyed: DataFrame, replies: DataFrame, sweep: int, opening: float, root_customers: int, keep: bool) -> DataFrame:
    """A draw of the tables of all pairs: to the owners the `sums` by context and by word, and if kept the `tables`."""

    def run(bucket: int, given: dict[str, list]) -> Iterator[Block]:
        (_, order_c, ends_c, order_w, ends_w, degrees, word, customers, keys), = given["drawn"]
        seated, sent, sat = (_placed(given["reply"], i, order) for i, order in ((1, order_c), (2, order_w), (3, order_w)))
        of = np.repeat(np.arange(len(degrees)), degrees)
        weights = (STRENGTH + DISCOUNT * seated)[of] * _parent(sent, sat, opening, root_customers)[word]
        tables = draw_tables(customers, weights, DISCOUNT, keys, 2 * sweep)
        by = [np.split(np.bincount(key, tables, len(order)).astype(np.int64)[order], ends) for key, order, ends in ((of, order_c, ends_c), (word, order_w, ends_w))]
        for owner, (c, w) in enumerate(zip(*by)):
            if len(c) or len(w):
                yield owner, "sums", bucket, pack(c, w)
        if keep:
            yield bucket, "tables", sweep, pack(tables)

    return _kept(_grouped(places.buckets, [_of(keyed, "drawn"), _of(replies, "reply")], run, tasks=_few(places.buckets)))


def _send(places: Places, owned: DataFrame, sums: DataFrame, sweep: int, opening: float, keep: bool) -> DataFrame:
    """The totals after it and a draw of the parent's tables: `reply` to the buckets, totals to the driver, and if kept the `node`."""

    def run(owner: int, given: dict[str, list]) -> Iterator[Block]:
        (_, named, single_c, single_w), = given["state"]
        seated, sent = single_c.copy(), single_w.copy()
        for (_, c, w), (_, of_context, of_word) in zip(given["subs"], given["sums"]):
            seated[c] += of_context
            sent[w] += of_word
        tables = draw_tables(sent, np.full(len(sent), opening), ROOT_DISCOUNT, named, 2 * sweep + 1)
        yield owner, "total", owner, pack(np.array([sent.sum(), tables.sum()]))
        for bucket, c, w in given["subs"]:
            yield bucket, "reply", owner, pack(seated[c], sent[w], tables[w])
        if keep:
            yield owner, "node", sweep, pack(seated, sent, tables)

    return _kept(_grouped(places.owners, [_of(owned, "state", "subs"), _of(sums, "sums")], run, tasks=_few(places.owners)))


def _answered(places: Places, owned: DataFrame, counted: DataFrame, nodes: DataFrame) -> DataFrame:
    """Blocks `reply` of the buckets: tokens after each of their contexts, and in each kept draw its tables, and customers and tables of each of their words."""

    def run(owner: int, given: dict[str, list]) -> Iterator[Block]:
        (_, _, after, _), = given["base"]
        draws = given["node"]
        for bucket, contexts, *_, words, _, _ in given["first"]:
            c, w = places.rank(contexts), places.rank(words)
            yield bucket, "reply", owner, pack(after[c], *[draw[1][c] for draw in draws], *[draw[i][w] for draw in draws for i in (2, 3)])

    return _kept(_grouped(places.owners, [_of(owned, "base"), _of(counted, "first"), nodes], run))


def _cells(places: Places, given: dict[str, list], roots: list[tuple[float, int]]) -> tuple:
    """Contexts, words, and of each pair its context, word, training tokens, fixed part and, given the parent, log10 of its predictive probability."""
    (_, contexts, words, degrees, word, counts), = given["cells"]
    of = np.repeat(np.arange(len(contexts)), degrees)
    fixed = counts * (1 - DISCOUNT)
    drawn = counts > 1
    if drawn.any():
        fixed[drawn] = counts[drawn] - DISCOUNT * sum(tables for _, tables in given["tables"]) / KEPT
    if not roots:
        return contexts, words, of, word, counts, fixed, None
    (order_c, _), (order_w, _) = places.by_owner(contexts), places.by_owner(words)
    room = STRENGTH + _placed(given["reply"], 1, order_c)
    parent = 0.0
    for i, root in enumerate(roots):
        spare = STRENGTH + DISCOUNT * _placed(given["reply"], 2 + i, order_c)
        p = _parent(*(_placed(given["reply"], 2 + KEPT + 2 * i + j, order_w) for j in (0, 1)), *root)
        parent = parent + spare[of] * p[word]
    return contexts, words, of, word, counts, fixed, np.log10((fixed + parent / KEPT) / room[of])


def fit(docs: DataFrame, sweeps: int = SWEEPS) -> tuple[Totals, int, int]:
    """The seating, and the numbers of training tokens and words.

    `docs` has text and learn (boolean).
    """
    chunks = chunk_table(docs.select(F.lit(None).cast("long").alias("doc_id"), "text", "learn"))
    found = _fit(chunks, docs.select(F.lit(None).cast("long").alias("doc_id"), "text", "learn"), sweeps)
    drop_stage(found[0].rows)
    return found[1:]


def _fit(chunks: Chunks, docs: DataFrame, sweeps: int = SWEEPS) -> tuple[Chunks, Totals, int, int]:
    """`fit` for the chunks of `docs`. They are made anew, and returned, if two words share a hash."""
    while True:
        places = _places(chunks.tokens)
        vocabulary = _vocabulary(chunks, places)
        train_tokens, train_words, shared = _sums(vocabulary, 3)
        if not shared:
            break
        drop_stage(vocabulary)
        drop_stage(chunks.rows)
        chunks = chunk_table(docs, chunks.seed + 1)
    chunks = _numbered(chunks, places, vocabulary)
    _drop(vocabulary, "ids")
    places = _dealt(places, chunks)
    counted = _count(chunks, places)
    owned = _owned(places, vocabulary, counted)
    keyed = _keyed(places, counted, owned)
    _drop(counted, "drawn", "subs")
    _drop(owned, "names")
    (root_customers,), root_tables = _sums(owned, 1), train_words
    replies, nodes, tables, roots = owned, [], [], []
    for sweep in range(sweeps + KEPT):
        keep, opening = sweep >= sweeps, _root_opening(root_tables, train_words)
        sums = _seat(places, keyed, replies, sweep, opening, root_customers, keep)
        _drop(replies, "reply")
        replies = _send(places, owned, sums, sweep, opening, keep)
        root_customers, root_tables = _sums(replies, 2)
        _drop(sums, "sums")
        if keep:
            nodes.append(_of(replies, "node"))
            tables.append(_of(sums, "tables"))
            roots.append((_root_opening(root_tables, train_words), root_customers))
    drop_stage(keyed)
    both = lambda parts: list(itertools.accumulate(parts, DataFrame.unionByName))[-1]
    _drop(replies, "reply")
    _drop(owned, "state", "subs")
    answers = _answered(places, owned, counted, both(nodes))
    _drop(counted, "first")
    totals = Totals(docs.sparkSession, places, chunks.seed, both([_of(vocabulary, "words"), _of(owned, "base"), *nodes]),
                    both([_of(counted, "cells"), _of(answers, "reply"), *tables]), roots)
    return chunks, totals, train_tokens, train_words


def score(docs: DataFrame, totals: Totals, train_tokens: int, train_words: int) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) per row of (doc_id, text), all of which `fit` has read: log10 probabilities of the text.

    Null texts have END only.
    """
    chunks, places = chunk_table(docs.select("doc_id", "text", F.lit(False).alias("learn")), totals.seed), totals.places

    def ask(chunk: int, given: list[np.ndarray]) -> Iterator[Block]:
        for owner, rows in _slices(places.owner(given[5]), places.owners):
            yield owner, "ask", chunk, pack(given[5][rows])

    def answer(owner: int, given: dict[str, list]) -> Iterator[Block]:
        if given["words"]:
            (_, named, counts, _, _), = given["words"]
            for chunk, asked in given["ask"]:
                at, known = _looked_up(named, asked)
                yield chunk, "ids", owner, pack(np.where(known, places.numbers(owner, at), UNKNOWN), np.where(known, counts[at], -1))

    told = _kept(_grouped(places.owners, [_of(totals.nodes, "words"), _sent(chunks, ask)], answer))
    return _score(_numbered(chunks, places, told), totals, train_tokens, train_words).select(*SCORES)


def _looked_up(found: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys among those found, in order, and whether they are there."""
    at = np.minimum(np.searchsorted(found, keys), max(len(found) - 1, 0))
    return at, found[at] == keys if len(found) else np.zeros(len(keys), bool)


SCORES = ["doc_id", "n_tokens", "n_known", "base_score", "score"]


def _score(chunks: Chunks, totals: Totals, train_tokens: int, train_words: int) -> DataFrame:
    """`score` of the texts of chunks, and whether they were learned."""
    places, roots, scale = totals.places, totals.roots, train_tokens + 0.1 * (train_words + 1)

    def ask(chunk: int, given: list[np.ndarray]) -> Iterator[Block]:
        sequence, named = given[4], given[5]
        for bucket, _, block in _pair_blocks(places, named, _distinct(_codes(sequence, len(named)))):
            yield bucket, "ask", chunk, pack(*block)

    def answer(bucket: int, given: dict[str, list]) -> Iterator[Block]:
        if not given["cells"]:
            return
        contexts, words, of, word, _, _, chances = _cells(places, given, roots)
        codes = of * len(words) + word
        for chunk, asked, degrees, followers in given["ask"]:
            c, known_c = _looked_up(contexts, asked)
            w, known_w = _looked_up(words, followers)
            at, known = _looked_up(codes, np.repeat(c, degrees) * len(words) + w)
            yield chunk, "chances", bucket, pack(np.where(known & known_w & np.repeat(known_c, degrees), chances[at], 0.0))

    def finish(chunk: int, given: dict[str, list]) -> Iterator[pa.RecordBatch]:
        (_, ids, known, lengths, learn, sequence, named, counts), = given["chunk"]
        pairs, of = np.unique(_codes(sequence, len(named)), return_inverse=True)
        chances, told = np.zeros(len(pairs)), {bucket: block for bucket, block in given["chances"]}
        for bucket, rows, _ in _pair_blocks(places, named, pairs):
            if bucket in told:
                chances[rows] = told[bucket]
        starts = np.cumsum(lengths) - lengths
        base = np.where(counts < 0, 0.0, np.log10((np.maximum(counts, 0) + 0.1) / scale))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=~known), pa.array(lengths), *[pa.array(np.add.reduceat(each, starts)) for each in (
                (counts > 0).astype(np.int64)[sequence], base[sequence], chances[of])], pa.array(learn)], names=[*SCORES, "learn"])

    found = []
    for turn in range(TURNS):
        some = replace(chunks, rows=chunks.rows.filter(F.col("chunk") % TURNS == turn))
        chances = _kept(_grouped(places.buckets, [totals.cells, _sent(some, ask)], answer))
        own = _sent(some, lambda chunk, given: iter([(chunk, "chunk", 0, pack(*given))]))
        found.append(stage_table(_grouped(max(len(chunks.ids), 1), [own, _of(chances, "chances")], finish,
                                          "doc_id long, n_tokens long, n_known long, base_score double, score double, learn boolean", iter)))
        _drop(chances, "chances")
    drop_stage(chunks.rows)
    return list(itertools.accumulate(found, DataFrame.unionByName))[-1]


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; a tenth of the rows is held out of the training."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_mod("doc_id", 10) != 0).alias("learn"))
    chunks, *fitted = _fit(chunk_table(docs), docs)
    return _score(chunks, *fitted).select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known",
        F.lit(fitted[1]).cast("long").alias("train_tokens"), "base_score", "score")
