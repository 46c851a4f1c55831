"""Personal data: fixed formats, and a bootstrap that learns lexical patterns around them.

The formats (e-mail, IP address, card, phone) give the seed entities. A pattern is the words around an entity:
the two before it, or the one before and the one after. Patterns and instances form a bipartite graph over all documents. In
turns, a pattern's confidence for a kind is the share of its instances that are of the kind, weighted by their
scores, and an unseen instance's score is the chance that at least one of its patterns is right. Accepted instances support further patterns,
until nothing new is found. All occurrences of accepted instances (tokens with a digit or an @) are then spans of that kind too,
whatever stands around them; the spans of the formats always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import packed, slices, stage_table, table

KINDS = ("email", "ip", "card", "phone")
#: Least number of rounds; they go on until nothing new is accepted.
ROUNDS = 3
#: A pattern counts if this many different seeds and accepted instances stand in it.
SUPPORT = 3
CONFIDENT = 0.6
ACCEPTED = 0.6
#: Characters that are looked at first for the words around an entity; more are if a word goes on beyond. Longer words
#: stand in a pattern as their digest.
AROUND = 120

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that starts inside a run of digits would also start before it, so only starts of runs are tried.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"\S+")
MARK = re.compile(r"[0-9@]")
EDGES = ".,;:!?\"'()[]{}<>#*$%&|=`"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the longest run of local characters before it and a domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed formats, by start and kind."""
    found = []
    if "@" in text:
        found += [("email", *span) for span in emails(text)]
    if MARK.search(text):
        for match in IP.finditer(text):
            if all(int(part) <= 255 if len(part) < 9 else not part.strip("0") or int(part[-9:]) <= 255 and not part[:-9].strip("0") for part in match[0].split(".")):
                found.append(("ip", *match.span()))
        for match in CARD.finditer(text):
            digits = match[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *match.span()))
        if "+" in text:
            for match in PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, match[0])) <= 15:
                    found.append(("phone", *match.span()))
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def _plain(word: str) -> str:
    word = re.sub(r"[0-9]+", "0", word.lower())
    if len(word) <= AROUND:
        return word
    letter = "w" if any(map(str.isalpha, word)) else ""
    return f"{letter}~{int.from_bytes(hashlib.blake2b(word.encode(), digest_size=12).digest())}"


def words_around(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    """The last two words before an entity and the first after it, each read to its border."""
    size, low = AROUND, max(0, start - AROUND)
    while low and len(text[low:start].split()) <= 2:  # the first of them may go on to the left
        size *= 4
        low = max(0, start - size)
    before, size = text[low:start].split()[-2:], AROUND
    while end + size < len(text) and len(text[end:end + size].split()) <= 1:
        size *= 4
    return before, text[end:end + size].split()[:1]


def patterns(text: str, start: int, end: int) -> tuple[str | None, str | None]:
    """The two patterns of an entity; null if no letter stands in the words of one."""
    before, after = ([_plain(w) for w in words] for words in words_around(text, start, end))
    left = ["^"] * (2 - len(before)) + before
    right = after[0] if after else "$"
    two = f"{left[0]} {left[1]} _"
    both = f"{left[1]} _ {right}"
    return tuple(p if any(map(str.isalpha, p)) else None for p in (two, both))


def occurrences(text: str, base: list[tuple[str, int, int]]) -> list[tuple]:
    """(start, end, seed kind or null, instance, pattern, pattern) of the seeds and of all other marked tokens."""
    found = [(start, end, kind, text[start:end].lower(), *patterns(text, start, end)) for kind, start, end in base]
    spans, at = sorted((start, end) for _, start, end in base), 0
    reach = 0  # end of the base spans that start before the token's end
    for token in TOKEN.finditer(text):
        core = token[0]
        if not MARK.search(core):
            continue
        start = token.start() + len(core) - len(core.lstrip(EDGES))
        end = start + len(core.strip(EDGES))
        while at < len(spans) and spans[at][0] < end:
            reach = max(reach, spans[at][1])
            at += 1
        if end - start >= 4 and reach <= start and MARK.search(text, start, end):
            found.append((start, end, None, text[start:end].lower(), *patterns(text, start, end)))
    return found


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
FOUND = pa.struct([
    ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.string()), ("instance", pa.string()), ("two", pa.string()), ("both", pa.string()),
])


def read_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, found) per row: spans of the formats, and occurrences for the bootstrap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, hashes, texts in slices(batches):
            base = [base_spans(text or "") for text in texts]
            found = [occurrences(text or "", spans) if spans or MARK.search(text or "") else [] for text, spans in zip(texts, base)]
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array(hashes, pa.int64()),
                pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row] for row in base], pa.list_(SPAN)),
                pa.array([[dict(zip(FOUND.names, o)) for o in row] for row in found], pa.list_(FOUND)),
            ], names=["doc_id", "text_hash", "base", "found"])

    picked = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(
        run, "doc_id long, text_hash long, base array<struct<kind:string,start:long,`end`:long>>, "
        "found array<struct<start:long,`end`:long,seed:string,instance:string,two:string,both:string>>"
    )


def confident_instances(read: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Accepted (pattern, kind) and (instance, kind, score) of unseen instances.

    A pattern is supported for a kind by the distinct seeds of it and the unseen instances accepted for it in the round before. Rounds
    go on, for `rounds` at least, until one accepts no pattern or instance that was not accepted before: all later ones add some, so they end.
    All counts are grouped sums over the distinct edges of the graph, so a pattern or an instance with a third of the
    edges is combined before it is shuffled; the joins back to the edges can be split.
    """
    seen = read.select(F.explode("found").alias("o")).select("o.seed", "o.instance", F.explode(F.array("o.two", "o.both")).alias("pattern"))
    edges = stage_table(seen.filter(F.col("pattern").isNotNull()).distinct())
    best_c, best_s = F.greatest(*[F.col(f"c_{k}") for k in KINDS]), F.greatest(*[F.col(f"s_{k}") for k in KINDS])

    def winner(prefix: str, best: Column) -> Column:
        return F.coalesce(*[F.when(F.col(f"{prefix}_{k}") == best, k) for k in KINDS])

    miss = {k: F.sum(F.log(1 - F.col(f"c_{k}"))) for k in KINDS}  # confidence is below 1
    held: DataFrame | None = None  # (what, kind) accepted in any round so far
    scores: DataFrame | None = None
    done = 0
    while True:
        if scores is None:
            of = {k: (F.coalesce(F.col("seed") == k, F.lit(False)), F.when(F.col("seed") == k, 1.0).otherwise(0.0)) for k in KINDS}
            linked = edges
        else:
            unseen = F.col("seed").isNull()
            of = {k: (
                F.coalesce((F.col("seed") == k) | unseen & (F.col("kind") == k), F.lit(False)),
                F.when(F.col("seed") == k, 1.0).otherwise(F.coalesce(F.when(unseen, F.col(f"s_{k}")), F.lit(0.0)))) for k in KINDS}
            linked = edges.join(scores.withColumn("kind", F.when(best_s >= ACCEPTED, winner("s", best_s))), "instance", "left")
        rated = linked.select("pattern", *[of[k][0].cast("int").alias(f"n_{k}") for k in KINDS], *[of[k][1].alias(k) for k in KINDS])
        confidence = stage_table(rated.groupBy("pattern").agg(
            *[(F.when(F.sum(f"n_{k}") >= SUPPORT, F.sum(k)).otherwise(0.0) / (F.count("*") + 1)).alias(f"c_{k}") for k in KINDS]
        ).filter(best_c > 0))
        scores = stage_table(edges.filter(F.col("seed").isNull()).join(confidence, "pattern").groupBy("instance").agg(
            *[(1 - F.exp(miss[k])).alias(f"s_{k}") for k in KINDS]))
        patterns_kept = confidence.filter(best_c >= CONFIDENT).select("pattern", winner("c", best_c).alias("kind"))
        instances = scores.filter(best_s >= ACCEPTED).select("instance", winner("s", best_s).alias("kind"), best_s.alias("score"))
        done += 1
        accepted = patterns_kept.select(F.concat(F.lit("p"), "pattern").alias("what"), "kind").unionByName(
            instances.select(F.concat(F.lit("i"), "instance").alias("what"), "kind"))
        fresh = stage_table(accepted if held is None else accepted.join(held, ["what", "kind"], "left_anti"))
        if done >= rounds and fresh.isEmpty():
            return patterns_kept, instances
        held = fresh if held is None else held.unionByName(fresh)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, spans) per row; `spans` are the base spans and those of the method, by start and kind.

    Null texts count as empty. Rows with one id are told apart by the hash of their text. Offsets are code points, ends exclusive.
    """
    read = stage_table(read_documents(docs))
    _, instances = confident_instances(read)
    unseen = read.select("doc_id", "text_hash", F.explode("found").alias("o")).filter("o.seed is null")
    placed = unseen.select("doc_id", "text_hash", "o.start", "o.end", "o.instance")
    extra = placed.join(instances.select("instance", "kind"), "instance").groupBy(
        F.col("doc_id").alias("x_id"), F.col("text_hash").alias("x_hash")).agg(F.collect_set(F.struct("kind", "start", "end")).alias("extra"))
    same = F.col("doc_id").eqNullSafe(F.col("x_id")) & F.col("text_hash").eqNullSafe(F.col("x_hash"))
    place = F.create_map(*[F.lit(v) for pair in zip(KINDS, range(len(KINDS))) for v in pair])
    joined = F.concat(F.col("base"), F.coalesce(F.col("extra"), F.array().cast("array<struct<kind:string,start:bigint,`end`:bigint>>")))
    keyed = F.array_sort(F.transform(joined, lambda s: F.struct(s["start"], place[s["kind"]].alias("place"), s["end"], s["kind"])))
    spans = F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return read.join(extra, same, "left").select("doc_id", "text_hash", "base", spans.alias("spans"))


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every span replaced by its kind in brackets, and n_chars counted anew. Overlapping spans become one."""

    def clean(text: str | None, spans: list) -> str | None:
        if not spans or text is None:
            return text
        out, done = [], 0
        for span in spans:
            if span["start"] >= done:
                out += [text[done:span["start"]], f"[{span['kind'].upper()}]"]
            done = max(done, span["end"])
        return "".join(out) + text[done:]

    found = find(docs).filter(F.size("spans") > 0).groupBy("doc_id", "text_hash").agg(F.first("spans").alias("spans"))
    rows = packed(docs, own_id=docs["doc_id"].cast("long"), own_hash=F.xxhash64(docs["text"]))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & F.col("own_hash").eqNullSafe(F.col("text_hash"))
    joined, names = rows.join(found, same, "left").select("doc", "spans"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                arrays = part.column("doc").flatten()
                at = names.index("text")
                arrays[at] = pa.array([clean(t, s) for t, s in zip(arrays[at].to_pylist(), part.column("spans").to_pylist())], pa.string())
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    cleaned = joined.mapInArrow(run, docs.schema)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and list of the spans of every document."""
    found = find(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    digest = F.sha2(span_list(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, span_list(F.col("spans")).alias("spans"))
