"""Byte-level BPE by a lazily determinised transducer, and decoding by an incremental UTF-8 machine.

Encoding. For a prefix of a piece, let its last token be the last one of the prefix's own encoding. That
token is the only vocabulary entry that ends there and that the merges leave apart from the last token of
the prefix before it. So the encodings of all prefixes form a tree. A later token can only start at a live
position: one from which the bytes read so far begin a longer token. The state of the machine is the longest such
run of bytes; an arc consumes a byte and tells which tokens may end there, and a remembered test of token pairs
picks the one. States and arcs are made when first met and dropped when there are too many, which changes no
result. Tokens up to the last common ancestor of the live positions are final and are emitted: the lookahead is
bounded by the longest token on all but contrived input.

Decoding keeps at most three pending bytes between tokens. Invalid sequences become U+FFFD.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import slices, table

MAX_STATES = 100_000
MAX_PIECES = 150_000
MAX_PAIRS = 500_000
#: Longer pieces are encoded without being remembered.
LONGEST_KEPT = 64
START = -1
#: Settled tokens of a long piece are emitted every so many bytes.
LOOKBACK = 512


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64 and number per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Lowest rank first, leftmost among equals. Only used on token pairs while arcs are made."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        _, at = min(found)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[part] for part in parts]


class State:
    """The longest run of bytes before this point that begins a longer token."""

    __slots__ = ("tail", "arcs")

    def __init__(self, tail: bytes):
        self.tail, self.arcs = tail, {}


class Transducer:
    """Encodes one piece (one match of the splitting pattern) at a time."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.begins = {token[:n] for token in ranks for n in range(1, len(token))}
        self.sound: dict[int, bool] = {}
        #: Per token: the tokens before it, and if both stay apart.
        self.apart: dict[int, dict[int, bool]] = {}
        self.pairs = 0
        self.root = State(b"")
        self.states = {b"": self.root}

    def _is_sound(self, token: int) -> bool:
        if token not in self.sound:
            self.sound[token] = merge(self.tokens[token], self.ranks) == [token]
        return self.sound[token]

    def _stays_apart(self, left: int, right: int) -> bool:
        if self.pairs >= MAX_PAIRS:
            self.pairs = 0
            for known in self.apart.values():
                known.clear()
        self.pairs += 1
        apart = left == START or merge(self.tokens[left] + self.tokens[right], self.ranks) == [left, right]
        self.apart[right][left] = apart
        return apart

    def _arc(self, state: State, byte: int) -> tuple[State, tuple, int]:
        """The next state, and the tokens that may end with this byte, longest first; the last one by itself."""
        read = state.tail + bytes((byte,))
        suffixes = [read[at:] for at in range(len(read))]
        ending = [
            (len(suffix) - 1, token, self.apart.setdefault(token, {})) for suffix in suffixes
            if (token := self.ranks.get(suffix)) is not None and self._is_sound(token)
        ]
        if not ending:
            raise ValueError("the vocabulary lacks a byte")
        tail = next((suffix for suffix in suffixes if suffix in self.begins), b"")
        after = self.states.get(tail)
        if after is None:
            if len(self.states) >= self.max_states:
                self.states.clear()
                self.root.arcs.clear()
                self.states[b""] = self.root
            after = self.states[tail] = State(tail)
        arc = state.arcs[byte] = (after, tuple(ending[:-1]), ending[-1][1])
        return arc

    def _settled(self, ended: list[int], state: State) -> int:
        """The position up to which no later byte can change a token: the last one on the paths of all live positions."""
        common = None
        for back in range(len(state.tail) + 1):
            if back and state.tail[-back:] not in self.begins:
                continue
            at, path = len(ended) - 1 - back, {0}
            while at > 0:
                path.add(at)
                at -= self.length[ended[at]]
            common = path if common is None else common & path
        return max(common)

    def _back(self, ended: list[int], at: int) -> list[int]:
        out = []
        while at > 0:
            out.append(ended[at])
            at -= self.length[ended[at]]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> tuple[int, ...]:
        # ended[n]: the last token of the first n bytes since the last settled position.
        state, ended, at, out = self.root, [START], 0, []
        for byte in piece:
            state, ending, token = state.arcs.get(byte) or self._arc(state, byte)
            for before, longer, apart in ending:
                left = ended[at - before]
                known = apart.get(left)
                if known is None:
                    known = self._stays_apart(left, longer)
                if known:
                    token = longer
                    break
            ended.append(token)
            at += 1
            if at % LOOKBACK == 0:
                cut = self._settled(ended, state)
                out += self._back(ended, cut)
                del ended[:cut]
                at -= cut
        return (*out, *self._back(ended, at))


class Kept(dict):
    """What is made of each piece; known pieces are looked up, new ones are made.

    When full, the table becomes the older one, from which pieces that are still in use come back.
    """

    def __init__(self):
        super().__init__()
        self.older = {}

    def make(self, piece: str):
        raise NotImplementedError

    def __missing__(self, piece: str):
        made = self.older.get(piece)
        if made is None:
            made = self.make(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= MAX_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = made
        return made


class Pieces(Kept):
    """Ids per piece, by the transducer."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def make(self, piece: str) -> tuple[int, ...]:
        return self.transducer.encode(piece.encode())


class PackedPieces(Pieces):
    """Ids per piece as 32-bit numbers in bytes, so that the ids of a text are one join."""

    def make(self, piece: str) -> bytes:
        return np.array(super().make(piece), np.int32).tobytes()


class DecodedPieces(Kept):
    """Text of each piece's ids where the machine, started without pending bytes, ends without; else None."""

    def __init__(self, packed: PackedPieces, machine: Utf8Machine):
        super().__init__()
        self.packed, self.machine = packed, machine

    def make(self, piece: str) -> str | None:
        text, pending = self.machine.read(np.frombuffer(self.packed[piece], np.int32).tolist())
        return None if pending else text


class Utf8Machine:
    """Text of a token stream. `step(pending, token)` gives the text that became complete and the new pending bytes."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.arcs: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}

    @staticmethod
    def feed(pending: bytes, data: bytes) -> tuple[str, bytes]:
        out = []
        for byte in data:
            if pending:
                lead = pending[0]
                low, high = 0x80, 0xBF
                if len(pending) == 1:
                    low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, low)
                    high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, high)
                if low <= byte <= high:
                    pending += bytes((byte,))
                    if len(pending) == (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
                        out.append(pending.decode())
                        pending = b""
                    continue
                out.append("�")
                pending = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                pending = bytes((byte,))
            else:
                out.append("�")
        return "".join(out), pending

    def decode(self, ids: list[int]) -> str:
        text, pending = self.read(ids)
        return text + "�" if pending else text

    def read(self, ids: list[int]) -> tuple[str, bytes]:
        """The text that is complete after the ids, and the bytes that are not."""
        pending, out = b"", []
        arcs = self.arcs[b""]
        for token in ids:
            step = arcs.get(token)
            if step is None:
                step = arcs[token] = self.feed(pending, self.tokens[token])
            text, after = step
            out.append(text)
            if after != pending:
                pending = after
                if pending not in self.arcs:
                    if len(self.arcs) > 4096:
                        self.arcs = {b"": self.arcs[b""]}
                    self.arcs[pending] = {}
                arcs = self.arcs[pending]
        return "".join(out), pending


@lru_cache(maxsize=2)
def _encoder(packed: tuple[tuple[bytes, int], ...], pattern: str):
    return regex.compile(pattern).findall, PackedPieces(Transducer(dict(packed)))


@lru_cache(maxsize=2)
def _decoder(packed: tuple[tuple[bytes, int], ...]) -> Utf8Machine:
    return Utf8Machine({rank: token for token, rank in packed})


@lru_cache(maxsize=2)
def _reader(packed: tuple[tuple[bytes, int], ...], pattern: str) -> DecodedPieces:
    return DecodedPieces(_encoder(packed, pattern)[1], _decoder(packed))


def _id_lists(rows: list[bytes]) -> pa.Array:
    """Lists of ids from their bytes."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)) // 4, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) per row. Null and empty texts give an empty array. Other columns are not read.

    The vocabulary (bounded: its file) is broadcast once; a row needs nothing but its own text, so nothing is shuffled.
    """
    shared = df.sparkSession.sparkContext.broadcast(tuple(ranks.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, pieces = _encoder(shared.value, pattern)
        for keys, texts in slices(batches):
            rows = [b"".join(map(pieces.__getitem__, split(value or ""))) for value in texts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), _id_lists(rows)], names=["key", "ids"])

    picked = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return picked.mapInArrow(run, "key long, ids array<int>").withColumnRenamed("key", key)


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, text) per row: `encode` and then `decode` in one pass, where a piece is decoded from its ids once.

    The text comes from the ids alone. A piece that ends within a character sends its text's ids through the machine as a whole.
    """
    shared = df.sparkSession.sparkContext.broadcast(tuple(ranks.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (split, pieces), decoded, machine = _encoder(shared.value, pattern), _reader(shared.value, pattern), _decoder(shared.value)
        for keys, texts in slices(batches):
            rows, read = [], []
            for value in texts:
                found = split(value or "")
                ids = b"".join(map(pieces.__getitem__, found))
                parts = list(map(decoded.__getitem__, found))
                rows.append(ids)
                read.append(machine.decode(np.frombuffer(ids, np.int32).tolist()) if None in parts else "".join(parts))
            columns = [pa.array(keys, pa.int64()), _id_lists(rows), pa.array(read, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "ids", "text"])

    picked = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return picked.mapInArrow(run, "key long, ids array<int>, text string").withColumnRenamed("key", key)


def decode(df: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, text) per row; a null array gives an empty text. An id outside the vocabulary is an error."""
    shared = df.sparkSession.sparkContext.broadcast(tuple(ranks.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _decoder(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [machine.decode(row or ()) for row in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["key", "ids", "text"])

    picked = df.select(F.col(key).cast("long").alias("key"), F.col(ids).alias("ids"))
    return picked.mapInArrow(run, "key long, ids array<int>, text string").withColumnRenamed("key", key)


def vocabulary() -> tuple[dict[bytes, int], str]:
    """The rank file and splitting pattern of the registered query."""
    import public_tokenizers

    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text per document."""
    ranks, pattern = vocabulary()
    return round_trip(table(spark, sf_dir, "documents"), ranks, pattern).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
