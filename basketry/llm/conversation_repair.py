"""Conversation structure repair: the cheapest edits that give `system? (user assistant)+` or nothing, as an audit string.

An audit is the initials of the edits in order: K keep, R give the role that is due, D delete, I insert an empty turn that is
due. It determines the result, as R and I have one possible role in each place. The cheapest audit to each point and state
is the parent's plus a letter, so audits share prefixes: each is a node that knows its parent, its ancestors at distances 1, 2,
4, ... and a rolling hash. Of equally cheap audits the ASCII-least one stays. Two of them are compared by searching their
longest common prefix over the ancestors' hashes; equal hashes of different nodes are verified letter by letter.

Two audits of one cell are never prefixes of each other if they cost the same (the longer one would have paid for its
inserts), so the least one stays the least whatever follows. For the same reason pieces of a conversation can be solved alone, from each
state to each state, and be joined later. So a conversation with a third of all rows is spread over tasks by order,
its rows reduced to a few bytes each; only the audit string and the stream of repaired texts into the hash run over it as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import SPACE, stage_table, table

DROPPED, EMPTIED, UNSTOPPED, REPEATED, MISCAST = range(5)
DAMAGES = 20

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3

#: States: nothing yet, a system turn, a user turn, an assistant turn. Results end in the first or the last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
DUE = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENTERED = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLE = {USER: "user", ASSISTANT: "assistant"}

#: Rows solved as one piece. A longer run of rows is cut, which changes no result.
PIECE = 8192
BASE, PRIME = 1_000_003, (1 << 61) - 1


class Audit:
    """A string that shares its prefixes: a letter after a parent."""

    __slots__ = ("letter", "length", "hash", "up")

    def __init__(self, parent: Audit | None = None, letter: str = ""):
        self.letter = letter
        if parent is None:
            self.length, self.hash, self.up = 0, 0, ()
            return
        self.length = parent.length + 1
        self.hash = (parent.hash * BASE + ord(letter)) % PRIME
        up, at, step = [parent], parent, 0
        while step < len(at.up):
            at = at.up[step]
            up.append(at)
            step += 1
        self.up = tuple(up)

    def prefix(self, length: int) -> Audit:
        at, away = self, self.length - length
        while away:
            step = away.bit_length() - 1
            at = at.up[step]
            away -= 1 << step
        return at

    def text(self) -> str:
        letters, at = [], self
        while at.length:
            letters.append(at.letter)
            at = at.up[0]
        return "".join(reversed(letters))


def same(a: Audit, b: Audit) -> bool:
    """Equal strings of equal length. The hash says no for sure; a yes is verified up to the first shared node."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def before(a: Audit, b: Audit) -> bool:
    """a is ASCII-less than b; a proper prefix comes before its extensions."""
    short = min(a.length, b.length)
    x, y = a.prefix(short), b.prefix(short)
    if same(x, y):
        return a.length < b.length
    # Climb while the strings above still differ: then only the last letter of x and y does.
    for step in reversed(range(len(x.up))):
        if step < len(x.up) and not same(x.up[step], y.up[step]):
            x, y = x.up[step], y.up[step]
    return x.letter < y.letter


class Piece:
    """The cheapest audit from each state before a run of rows to each state after it."""

    def __init__(self):
        self.cells: list[list[tuple[int, Audit] | None]] = []
        for start in range(STATES):
            row: list[tuple[int, Audit] | None] = [None] * STATES
            row[start] = (0, Audit())
            self.cells.append(row)
        self.rows = 0
        for row in self.cells:
            self._inserts(row)

    @staticmethod
    def _offer(row: list, state: int, cost: int, parent: Audit, letter: str) -> bool:
        known = row[state]
        if known is not None and known[0] < cost:
            return False
        made = Audit(parent, letter)
        if known is not None and known[0] == cost and not before(made, known[1]):
            return False
        row[state] = (cost, made)
        return True

    def _inserts(self, row: list) -> None:
        """An inserted turn may follow any state, and another one that."""
        waiting = [state for state in range(STATES) if row[state]]
        while waiting:
            state = waiting.pop()
            cost, audit = row[state]
            if self._offer(row, DUE[state], cost + INSERT_COST, audit, INSERT) and DUE[state] not in waiting:
                waiting.append(DUE[state])

    def add(self, initial: str, truncated: bool, must_go: bool) -> None:
        self.rows += 1
        kept = TRUNCATED_COST if truncated else 0
        enters = ENTERED.get(initial, {})
        for at, row in enumerate(self.cells):
            new: list[tuple[int, Audit] | None] = [None] * STATES
            for state, cell in enumerate(row):
                if cell is None:
                    continue
                cost, audit = cell
                self._offer(new, state, cost + DELETE_COST, audit, DELETE)
                if not must_go:
                    if state in enters:
                        self._offer(new, enters[state], cost + kept, audit, KEEP)
                    self._offer(new, DUE[state], cost + REROLE_COST + kept, audit, REROLE)
            self._inserts(new)
            self.cells[at] = new

    def table(self) -> tuple[list[int | None], list[str | None]]:
        """Costs and audits, state by state."""
        cells = [cell for row in self.cells for cell in row]
        return [cell and cell[0] for cell in cells], [cell and cell[1].text() for cell in cells]


def join_pieces(pieces: Iterator[tuple[list, list]]) -> tuple[int, str]:
    """Cost and audit of a whole conversation from its pieces in order."""
    best: list[tuple[int, str] | None] = [(0, ""), None, None, None]
    for costs, audits in pieces:
        new: list[tuple[int, str] | None] = [None] * STATES
        for start, cell in enumerate(best):
            for end in range(STATES):
                cost = costs[start * STATES + end]
                if cell is None or cost is None or (new[end] and new[end][0] < cell[0] + cost):
                    continue
                offer = (cell[0] + cost, cell[1] + audits[start * STATES + end])
                new[end] = offer if new[end] is None else min(new[end], offer)
        best = new
    return min(cell for cell in (best[EMPTY], best[ASSISTANT]) if cell)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows after damage by the checksum of their name. Dropped rows have 0 copies."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    damage = F.crc32(name.cast("binary")) % DAMAGES
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(damage == MISCAST, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(damage == EMPTIED, F.lit("")).when(damage == UNSTOPPED, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(damage == DROPPED, 0).when(damage == REPEATED, 2).otherwise(1).alias("copies"),
    )


def _mark() -> Column:
    """Digest of role and text. Orders the rows of one turn."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))


def symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, mark, initial, blank, truncated, copies, repeated): rows without their texts, equal ones counted.

    `repeated`: role and text stand in an earlier turn. The earliest turn of a mark is an aggregation joined back, so that
    neither a conversation nor a text that it repeats is a group in one task.
    """
    kept = F.regexp_extract("text", rf"(?s)([^{SPACE}])[{SPACE}]*\z", 1)
    counted = stage_table(
        rows.select(
            "conv_id", "turn", _mark().alias("mark"), F.substring("role", 1, 1).alias("initial"), (kept == "").alias("blank"),
            ((kept != "") & ~kept.isin(".", "!", "?")).alias("truncated"), "copies",
        ).groupBy("conv_id", "turn", "mark", "initial", "blank", "truncated").agg(F.sum("copies").alias("copies"))
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")  # null turns first
    first = counted.where("copies > 0").groupBy(F.col("conv_id").alias("of"), F.col("mark").alias("first_mark")).agg(F.min(place).alias("first"))
    same_row = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("first_mark"))
    return counted.join(first, same_row, "left").select(*counted.columns, F.coalesce(place > F.col("first"), F.lit(False)).alias("repeated"))


#: Total order of the rows; ascending puts nulls first.
ORDER = ["conv_id", "turn", "mark"]
PIECE_SCHEMA = "conv_id long, part int, place int, costs array<int>, audits array<string>, first string, last string, illegal long"
LEGAL = {"su", "ua", "au"}


def solved_pieces(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """The table of each run of up to `piece` rows of a conversation within a range of the total order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place = TaskContext.get().partitionId(), 0
        current, solving, edge, illegal = None, None, None, 0

        def made() -> pa.RecordBatch:
            costs, audits = solving.table()
            values = [current, part, place, costs, audits, edge[0], edge[1], illegal]
            return pa.RecordBatch.from_pylist([dict(zip(NAMES, values))], schema=KINDS)

        for batch in batches:
            for row in batch.to_pylist():
                for copy in range(row["copies"]):
                    if solving is not None and (row["conv_id"] != current or solving.rows >= piece):
                        yield made()
                        place, solving = place + 1, None
                    if solving is None:
                        current, solving, edge, illegal = row["conv_id"], Piece(), [row["initial"], row["initial"]], 0
                    else:
                        illegal += edge[1] + row["initial"] not in LEGAL
                        edge[1] = row["initial"]
                    solving.add(row["initial"], row["truncated"], row["blank"] or row["repeated"] or copy > 0)
        if solving is not None:
            yield made()

    columns = ["conv_id", "initial", "blank", "truncated", "repeated", "copies"]
    laid = rows.where("copies > 0").repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return laid.select(*columns).mapInArrow(run, PIECE_SCHEMA)


KINDS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("place", pa.int32()), ("costs", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
    ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()),
])
NAMES = KINDS.names


def joined_pieces(pieces: DataFrame) -> DataFrame:
    """(conv_id, illegal, cost, audit) per conversation with a row. One piece after the other, so that one is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        rows = (row for batch in batches for start in range(batch.num_rows) for row in batch.slice(start, 1).to_pylist())
        for conversation, group in groupby(rows, key=lambda row: row["conv_id"]):
            illegal, last = 0, None

            def tables() -> Iterator[tuple[list, list]]:
                nonlocal illegal, last
                for row in group:
                    illegal += row["illegal"] + (last is not None and last + row["first"] not in LEGAL)
                    last = row["last"]
                    yield row["costs"], row["audits"]

            cost, audit = join_pieces(tables())
            columns = [pa.array([v], kind) for v, kind in zip((conversation, illegal, cost, audit), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "illegal", "cost", "audit"])

    laid = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return laid.mapInArrow(run, "conv_id long, illegal long, cost long, audit string")


def counts(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated) per conversation, one of whose rows may have been dropped."""
    present = F.col("copies") > 0
    fresh = F.when(F.col("blank") | F.col("repeated"), 0).otherwise(1)  # the first of equal rows, the others are duplicates

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(present, value)), F.lit(0)).cast("long").alias(name)

    # Turns first, so that a conversation's turns are distinct before they are counted, without a list of them.
    by_turn = rows.groupBy("conv_id", "turn").agg(
        F.max(present).alias("present"), total(F.when(F.col("blank"), F.col("copies")).otherwise(0), "blank"),
        total(F.when(F.col("blank"), 0).otherwise(F.col("copies") - fresh), "duplicate"),
        total(F.when(F.col("truncated"), fresh).otherwise(0), "truncated"),
    )
    turn = F.when(F.col("present"), F.col("turn"))
    return by_turn.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0)).alias("gaps"),
        *[F.sum(name).cast("long").alias(name) for name in ("blank", "duplicate", "truncated")],
    )


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """`audits` (conv_id, audit, ...) with `repaired_sha256`, the digest of the edited conversation's `role:text` lines.

    Each audit precedes the rows of its conversation in one sorted stream into a hash state; texts are never held.
    """
    facts = F.struct(*[c for c in audits.columns if c != "conv_id"])
    marked = rows.where("copies > 0").withColumn("mark", _mark())
    # The zero place of a head is free: rows have place 1.
    heads = audits.select("conv_id", F.lit(0).alias("place"), F.to_json(facts).alias("facts"))
    texts = marked.select("conv_id", F.lit(1).alias("place"), "turn", "mark", "role", "text", "copies")
    stream = heads.unionByName(texts, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        open_facts, audit, at, state, digest, lines, current = None, "", 0, EMPTY, None, 0, None

        def say(role: str, text: str) -> None:
            nonlocal lines
            digest.update((("\n" if lines else "") + f"{role}:{text}").encode())
            lines += 1

        def insert() -> None:
            nonlocal at, state
            while audit[at:at + 1] == INSERT:
                state = DUE[state]
                say(ROLE[state], "")
                at += 1

        def close() -> pa.RecordBatch:
            insert()
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([open_facts]), pa.array([digest.hexdigest()])], names=["conv_id", "facts", "repaired_sha256"])

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for row in batch.slice(start, 64).to_pylist():
                    if row["place"] == 0:
                        if open_facts is not None:
                            yield close()
                        current, open_facts = row["conv_id"], row["facts"]
                        audit, at, state, digest, lines = json.loads(open_facts)["audit"], 0, EMPTY, hashlib.sha256(), 0
                        continue
                    for _ in range(row["copies"]):
                        insert()
                        edit = audit[at]
                        at += 1
                        if edit == KEEP:
                            state = ENTERED[row["role"][0]][state]
                            say(row["role"], row["text"])
                        elif edit == REROLE:
                            state = DUE[state]
                            say(ROLE[state], row["text"])
        if open_facts is not None:
            yield close()

    laid = stream.repartition("conv_id").sortWithinPartitions("conv_id", "place", "turn", "mark")
    hashed = laid.select("conv_id", "place", "facts", "role", "text", "copies").mapInArrow(run, "conv_id long, facts string, repaired_sha256 string")
    read = F.from_json("facts", audits.select(facts.alias("facts")).schema["facts"].dataType)
    return hashed.select("conv_id", read.alias("facts"), "repaired_sha256").select("conv_id", "facts.*", "repaired_sha256")


def repair(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation of the table.

    Null role and text are one space, so such a row is blank or of no known role. Rows without a conv_id are one conversation.
    Null turns come first; rows of one turn come in order of a digest of role and text, and equal ones side by side. An
    empty table gives an empty one; columns besides the four are not read. Texts are shuffled once, for the hash.
    """
    rows = damaged(conversations)
    known = stage_table(symbols(rows))
    solved = joined_pieces(solved_pieces(known, piece)).withColumnsRenamed({"conv_id": "of"})
    facts = counts(known).join(solved, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", F.coalesce("illegal", F.lit(0)).cast("long").alias("illegal"),
        F.coalesce("cost", F.lit(0)).cast("long").alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
    )
    return repaired(rows, facts)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged, with their faults, the cheapest repair and the digest of its result."""
    return repair(table(spark, sf_dir, "conversations"))
