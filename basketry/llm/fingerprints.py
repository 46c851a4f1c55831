"""Document fingerprints by invertible Bloom lookup sketches.

A text is cut into paragraphs: at line ends and at all sentence ends, and those longer than RUN characters again before words of some lengths
(whatever their script), so that a border depends on its own line or sentence only. The distinct 64-bit digests of the paragraphs are put into a sketch: SEGMENTS segments of cells, one cell of each per digest. A cell holds a count, the digests and 32-bit checksums, the latter two
combined by exclusive or, so sketches of two versions can be subtracted: what both have cancels. Peeling then
takes a cell with one digest left, removes that digest everywhere, and so on, until the sketch is empty and
the differing digests of both sides are known. If it gets stuck, the attempt is repeated larger: first with the digests
dealt into buckets of their own small sketch, as many as the larger text needs (ranges of one sorted list of both sides'
digests), then in the buckets that still fail for what is left, with cells by other bits and at last more of them.
A bucket that fails even then is compared directly.

Built-in functions only. Everything about a document is computed in its own row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import SPACE, bind, table

SEGMENTS = 3
#: Cells of a segment at the first attempt and at the larger ones.
CELLS = 8
LARGER = (8, 8, 32)
#: Bits of a digest for a segment, of which each larger attempt takes others: digests that met in all their cells once are parted then.
BITS = 14
#: Digests of one side that a bucket of the larger attempts is meant for.
PER_BUCKET = 8
#: Rounds of peeling; a difference that fits its sketch takes a few.
PEELS = 10
#: Sentence ends that a space follows, and those of scripts without spaces, after which a line end is put.
ENDS = ".!?…؟۔։।॥"
FULL_ENDS = "。！？"
#: Characters of a paragraph after which words of the lengths 2, 5, 8 and so on begin another: about a third of the words.
RUN = 100
#: The first character of a cut decides, so that all others are passed quickly.
SENTENCES = rf"[{SPACE}](?:(?<=\n)|(?<=[{ENDS}][{SPACE}])[{SPACE}]*)"
RUNS = rf"[{SPACE}]+(?=(?:[^{SPACE}]{{3}})*+[^{SPACE}]{{2}}(?![^{SPACE}]))(?<=(?s:.){{{RUN}}}[{SPACE}])"
FOUND = "array<struct<n:int,k:bigint>>"
#: `n` of the entries that part buckets. They stand before any digest of the same value.
BORDER = -2



def held(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, which is evaluated once. `bind` does the same, but its transform copies the result with all that is in it."""
    return F.aggregate(F.array(), value, lambda kept, _: kept, body)


def paragraphs(text: Column) -> Column:
    """The text cut at line and sentence ends, and what is longer than RUN at some words. May hold empty ones."""
    for end in FULL_ENDS:
        text = F.replace(text, F.lit(end), F.lit(end + "\n"))
    return F.flatten(F.transform(F.split(text, SENTENCES, -1), lambda p: F.when(F.length(p) > RUN, F.split(p, RUNS, -1)).otherwise(F.array(p))))


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs that are not empty."""
    return F.array_distinct(F.transform(F.filter(paragraphs(text), lambda p: p != ""), lambda p: F.xxhash64(p)))


def _tagged(found: Column, n: int) -> Column:
    """Digests with their side and checksum."""
    return F.transform(found, lambda k: F.struct(k.alias("k"), F.lit(n).alias("n"), F.hash(k).alias("h")))


def _placed(tagged: Column, cells: Column, skipped: Column) -> Column:
    """With the cell within each segment, from low bits after the skipped ones; buckets go by the highest. `cells` is a power of two."""
    places = lambda k: [F.call_function("shiftrightunsigned", k, skipped + BITS * s).bitwiseAND(cells - 1).cast("int").alias(f"p{s}") for s in range(SEGMENTS)]
    return F.transform(tagged, lambda t: F.struct(t["k"].alias("k"), t["n"].alias("n"), t["h"].alias("h"), *places(t["k"])))


def _sum(cell: Column, placed: Column, segment: int, place: Column, sign: int) -> Column:
    """The cell with the entries of its place added or taken out."""
    return F.aggregate(F.filter(placed, lambda t: t[f"p{segment}"] == place), cell, lambda c, t: F.struct(
        (c["n"] + t["n"] if sign > 0 else c["n"] - t["n"]).alias("n"), c["k"].bitwiseXOR(t["k"]).alias("k"), c["h"].bitwiseXOR(t["h"]).alias("h")))


def _cells(tagged: Column, cells: Column, skipped: Column) -> Column:
    """The sketch of tagged digests, segment after segment."""
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).alias("h"))
    places = F.sequence(F.lit(0), (cells - 1).cast("int"))
    segment = lambda placed, s: F.transform(places, lambda place: _sum(empty, placed, s, place, 1))
    return held(_placed(tagged, cells, skipped), lambda placed: F.concat(*[segment(placed, s) for s in range(SEGMENTS)]))


def sketch(found: Column, cells: Column) -> Column:
    """The cells of a set of digests, segment after segment."""
    return _cells(_tagged(found, 1), cells, F.lit(0))


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.struct(
        (a["n"] - b["n"]).alias("n"), a["k"].bitwiseXOR(b["k"]).alias("k"), a["h"].bitwiseXOR(b["h"]).alias("h")))


def peel(difference: Column, cells: Column, skipped: Column) -> Column:
    """struct(found: array of (n, k), done): n is 1 for digests of the left side only, -1 for the right side only."""

    empty = lambda cells_left: ~F.exists(cells_left, lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["h"] != 0))

    def step(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["h"] == F.hash(c["k"])))
        taken = _placed(F.array_distinct(F.transform(pure, lambda c: F.struct(c["k"].alias("k"), c["n"].alias("n"), c["h"].alias("h")))), cells, skipped)

        def without(taken: Column) -> Column:
            # Cells that no digest taken stands in stay as they are.
            bit = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), place)
            touched = lambda s: F.aggregate(taken, F.lit(0).cast("long"), lambda bits, t: bits.bitwiseOR(bit(t[f"p{s}"])))
            rest = lambda s: held(touched(s), lambda bits: F.transform(
                F.slice(state["cells"], (cells * s + 1).cast("int"), cells.cast("int")),
                lambda c, i: F.when(bits.bitwiseAND(bit(i)) != 0, _sum(c, taken, s, i, -1)).otherwise(c)))
            went = lambda cells_left, n, k, going, done: F.struct(
                cells_left.alias("cells"), n.alias("n"), k.alias("k"), F.lit(going).alias("going"), done.alias("done"))
            # An aggregate copies its state in each round, so what has ended keeps no cells.
            return F.when(F.size(taken) > 0, went(
                F.concat(*map(rest, range(SEGMENTS))), F.concat(state["n"], taken["n"]), F.concat(state["k"], taken["k"]), True, F.lit(False))
            ).otherwise(went(F.slice(state["cells"], 1, 0), state["n"], state["k"], False, empty(state["cells"])))

        return F.when(state["going"], held(taken, without)).otherwise(state)

    start = F.struct(
        difference.alias("cells"), F.array().cast("array<int>").alias("n"), F.array().cast("array<bigint>").alias("k"), F.lit(True).alias("going"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(PEELS)), start, step, lambda state: F.struct(
        F.zip_with(state["n"], state["k"], lambda n, k: F.struct(n.alias("n"), k.alias("k"))).alias("found"),
        F.when(state["going"], empty(state["cells"])).otherwise(state["done"]).alias("done")))


def _direct(tagged: Column) -> Column:
    """Digests of one side only, by comparison."""
    keys = lambda n: F.transform(F.filter(tagged, lambda t: t["n"] == n), lambda t: t["k"])
    side = lambda a, b, n: F.transform(F.array_except(a, b), lambda k: F.struct(F.lit(n).alias("n"), k.alias("k")))
    return F.concat(side(keys(1), keys(-1), 1), side(keys(-1), keys(1), -1))


def _bucket_difference(tagged: Column) -> Column:
    """Attempts with cells by other bits, each for what the ones before left. The sketch of digests tagged by side is the difference of the sides' sketches."""
    start = F.struct(F.array().cast(FOUND).alias("found"), tagged.alias("rest"), F.lit(False).alias("done"))
    skips = [sum(size.bit_length() - 1 for size in LARGER[:i]) for i in range(len(LARGER))]
    sizes = F.array(*[F.struct(F.lit(size).cast("long").alias("cells"), F.lit(skip).alias("skipped")) for size, skip in zip(LARGER, skips)])

    def attempt(tried: Column, size: Column) -> Column:
        def outcome(peeled: Column) -> Column:
            got = F.transform(peeled["found"], lambda p: p["k"])
            # A stuck attempt may have taken a sum for a digest, by equal checksums.
            sure = F.filter(peeled["found"], lambda p: F.exists(tried["rest"], lambda t: t["k"] == p["k"]))
            return F.when(peeled["done"], F.struct(F.concat(tried["found"], peeled["found"]).alias("found"), F.slice(tried["rest"], 1, 0).alias("rest"), F.lit(True).alias("done"))).otherwise(
                F.struct(F.concat(tried["found"], sure).alias("found"), F.filter(tried["rest"], lambda t: ~F.array_contains(got, t["k"])).alias("rest"), F.lit(False).alias("done")))

        return F.when(tried["done"], tried).otherwise(held(peel(_cells(tried["rest"], size["cells"], size["skipped"]), size["cells"], size["skipped"]), outcome))

    return F.aggregate(sizes, start, attempt, lambda tried: F.when(tried["done"], tried["found"]).otherwise(F.concat(tried["found"], _direct(tried["rest"]))))


def first_sketch(found: Column) -> Column:
    return sketch(found, F.lit(CELLS).cast("long"))


def _larger(left: Column, right: Column, bits: Column) -> Column:
    """The difference bucket by bucket: one sort of both sides' digests and of the 2**bits lower ends of the buckets lays them out."""
    lowest = F.expr("cast(-9223372036854775808 as bigint)")
    parts = F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), bits) - 1)
    borders = F.transform(parts, lambda p: F.struct(
        F.call_function("shiftleft", p.cast("long"), F.lit(64) - bits).bitwiseXOR(lowest).alias("k"), F.lit(BORDER).alias("n"), F.lit(0).alias("h")))

    def solved(laid: Column) -> Column:
        at = F.filter(F.transform(laid, lambda t, i: F.when(t["n"] == BORDER, i)), lambda i: i.isNotNull())

        def bucket(at: Column, i: Column) -> Column:
            first = F.get(at, i)
            return F.slice(laid, first + 2, F.coalesce(F.get(at, i + 1), F.size(laid)) - first - 1)

        return held(at, lambda at: F.flatten(F.transform(parts, lambda i: held(bucket(at, i), _bucket_difference))))

    return held(F.sort_array(F.concat(_tagged(left, 1), _tagged(right, -1), borders)), solved)


def difference(left: Column, right: Column, first: Column) -> Column:
    """array of (n, k): the digests that only one of two sets has. `first` is the difference of their first sketches."""
    most = F.greatest(F.size(left), F.size(right), F.lit(PER_BUCKET))
    bits = F.least(F.ceil(F.log2(most / F.lit(float(PER_BUCKET)))), F.lit(20)).cast("int")
    # More digests than cells cannot be told apart, so a difference in size beyond that needs no first attempt.
    tried = F.when(F.abs(F.size(left) - F.size(right)) <= SEGMENTS * CELLS, peel(first, F.lit(CELLS).cast("long"), F.lit(0)))
    return held(tried, lambda t: F.when(F.coalesce(t["done"], F.lit(False)), t["found"]).otherwise(held(bits, lambda b: _larger(left, right, b))))


def likeness(left: Column, right: Column, differing: Column) -> Column:
    """Shared digests over all digests; 1 if neither side has one."""
    both = F.size(left) + F.size(right)
    return held(F.size(differing), lambda n: F.when(both == 0, 1.0).otherwise((both - n) / (both + n)))


def written(text: Column, found: Column, cells: Column) -> Column:
    """The fingerprint: hash of the text, number of digests, and count, digests and checksums of each cell, in hexadecimal."""
    one = lambda c: F.concat(F.lpad(F.hex(c["n"].bitwiseAND(F.lit(0xFFFF))), 4, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["h"].cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.concat(F.lpad(F.hex(F.xxhash64(text)), 16, "0"), F.lit("-"), F.hex(F.size(found)), F.lit("-"), F.array_join(F.transform(cells, one), ""))


def compare_rows(df: DataFrame, left: str, right: str, out: str = "found") -> DataFrame:
    """Adds `only_left`, `only_right` (differing paragraph digests) and `near` of two text columns."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    sets = F.struct(digests(text(left)).alias("l"), digests(text(right)).alias("r"))
    only = lambda found, n: F.transform(F.filter(found, lambda p: p["n"] == n), lambda p: p["k"])
    result = held(sets, lambda s: held(
        difference(s["l"], s["r"], subtract(first_sketch(s["l"]), first_sketch(s["r"]))),
        lambda found: F.struct(only(found, 1).alias("only_left"), only(found, -1).alias("only_right"), likeness(s["l"], s["r"], found).alias("near"))))
    return df.withColumn(out, result).select(*df.columns, f"{out}.*")


def with_next(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """(doc_id, text, next_text, found, next_found): the text of the next document by id, after the last one the first, and the digests of both.
    Null texts count as empty.

    Ids are cut into ranges by approximate quantiles, of which at most `blocks` come to the driver; rows of a
    range meet in one sorted window. The first row of each range is added to the range before it (to the last for the
    first), so that no row needs another range. A null id comes first; rows with the same id follow each other by text.
    """
    spark = docs.sparkSession
    blocks = blocks or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = -(1 << 63)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("place"))
    cuts = [i / blocks for i in range(1, blocks)]
    bounds = sorted(set(rows.agg(F.percentile_approx("place", cuts, 100 * blocks)).first()[0] or []))
    listed = F.expr(f"array({', '.join(f'{b}L' if b != lowest else 'cast(-9223372036854775808 as bigint)' for b in bounds)})").cast("array<bigint>")
    # Binary search for the number of bounds below the id.
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1)), F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high")),
        lambda s, _: bind(F.floor((s["low"] + s["high"]) / 2).cast("int"), lambda mid: F.when(s["low"] >= s["high"], s).otherwise(
            F.when(F.get(listed, mid) < F.col("place"), F.struct((mid + 1).alias("low"), s["high"].alias("high")))
            .otherwise(F.struct(s["low"].alias("low"), mid.alias("high"))))),
        lambda s: s["low"])
    rows = rows.withColumn("block", found if bounds else F.lit(0))
    firsts = sorted((r["block"], r["place"]) for r in rows.groupBy("block").agg(F.min("place").alias("place")).collect())
    moved = spark.createDataFrame(
        [(place, firsts[i - 1][0]) for i, (_, place) in enumerate(firsts)], "place long, block int")
    # One row per range, so it may be broadcast.
    guests = rows.drop("block").join(F.broadcast(moved), "place").groupBy("place", "block").agg(F.min("text").alias("text"))
    found = digests(F.col("text")).alias("found")
    laid = rows.select("doc_id", "text", found, "place", "block", F.lit(0).alias("guest")).unionByName(
        guests.select(F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text", found, "place", "block", F.lit(1).alias("guest")))
    # A given number of partitions, which is not lowered by size: the work per byte is high.
    laid = laid.repartition(blocks, "block")
    following = F.lead(F.struct("text", "found")).over(Window.partitionBy("block").orderBy("guest", "place", "text"))
    return laid.withColumn("next", following).filter("guest = 0").select(
        "doc_id", "text", F.col("next.text").alias("next_text"), "found", F.col("next.found").alias("next_found"))


def fingerprints(pairs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text, next_text, found, next_found): fingerprints of the text and of its edited version, and their likeness."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    texts = F.struct(F.col("text").alias("own"), edited.alias("edited"), F.col("found").alias("own_found"), F.col("next_found").alias("next_found"))

    def side(found: Column) -> Column:
        return F.struct(found.alias("d"), first_sketch(found).alias("s"))

    def compare(t: Column) -> Column:
        def nears(sides: Column) -> Column:
            """Likeness of the first side to each of the others."""
            own = sides[0]
            return F.transform(F.slice(sides, 2, 2), lambda o: likeness(
                own["d"], o["d"], difference(own["d"], o["d"], subtract(own["s"], o["s"]))))

        return held(F.transform(F.array(t["own_found"], digests(t["edited"]), t["next_found"]), side), lambda sides: held(nears(sides), lambda near: F.struct(
            F.length(t["own"]).cast("long").alias("n_chars"), F.sha2(t["edited"].cast("binary"), 256).alias("edited_sha256"),
            written(t["own"], sides[0]["d"], sides[0]["s"]).alias("fingerprint"),
            written(t["edited"], sides[1]["d"], sides[1]["s"]).alias("edited_fingerprint"),
            near[0].alias("near_edited"), near[1].alias("near_next"))))

    return pairs.select("doc_id", held(texts, compare).alias("f")).select("doc_id", "f.*")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints(with_next(table(spark, sf_dir, "documents")))
