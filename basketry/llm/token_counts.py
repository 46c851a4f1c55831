"""Token counts of a word-wise byte-pair vocabulary, without making the tokens.

A text is cut at the special strings of the vocabulary (one token each), normalised, lower-cased and split into words. The
bytes of a word are its first symbols, the last one marked as the end. Neighbouring symbols stand in a linked list, their
pairs in a heap by rank: the pair of the lowest rank, the leftmost of equal ones, becomes one symbol until no known
pair is left. Every merge takes one symbol away, so the count is the number of bytes minus the number of merges.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import table

#: Words that a worker remembers, in two generations, and the longest of them.
MAX_WORDS = 150_000
LONGEST_KEPT = 64
LIMIT = 2048


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary file: printable Latin-1 itself, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


class Merges:
    """Symbols are numbers: 0-255 a byte, 256-511 a byte that ends its word, then one per merged token."""

    def __init__(self, merges: list[list[str]], end: str):
        self.symbols = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.symbols |= {letter + end: 256 + byte for letter, byte in list(self.symbols.items())}
        #: (left, right) as one number: rank and the merged symbol.
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            made = self.symbols.setdefault(left + right, len(self.symbols))
            self.pairs[self.symbols[left] << 32 | self.symbols[right]] = rank, made

    def count(self, word: bytes) -> int:
        """Tokens of one word, which has a byte at least."""
        pairs = self.pairs
        symbols = [*word[:-1], 256 + word[-1]]
        left = symbols[0]
        heap = []
        for at, right in enumerate(symbols[1:]):
            if (known := pairs.get(left << 32 | right)) is not None:
                heap.append((known[0], at))
            left = right
        heapify(heap)
        size = tokens = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        while heap:
            rank, at = heappop(heap)
            right = after[at]
            # A pair that a merge has since changed is not the one that was put into the heap.
            if symbols[at] < 0 or right >= size:
                continue
            known = pairs.get(symbols[at] << 32 | symbols[right])
            if known is None or known[0] != rank:
                continue
            made = symbols[at] = known[1]
            symbols[right] = -1
            beyond = after[at] = after[right]
            tokens -= 1
            if beyond < size:
                before[beyond] = at
                if (known := pairs.get(made << 32 | symbols[beyond])) is not None:
                    heappush(heap, (known[0], at))
            if (earlier := before[at]) >= 0 and (known := pairs.get(symbols[earlier] << 32 | made)) is not None:
                heappush(heap, (known[0], earlier))
        return tokens


class Words(dict):
    """Count per word. When full, the table becomes the older one, from which words still in use come back."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges, self.older = merges, {}

    def __missing__(self, word: str) -> int:
        count = self.older.get(word) or self.merges.count(word.encode())
        if len(word) <= LONGEST_KEPT:
            if len(self) >= MAX_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = count
        return count


@lru_cache(maxsize=1)
def unsettled() -> re.Pattern:
    """Code points that are unassigned or combine with others in Python's character tables, and all beyond U+FFFF.

    The library's tables are newer for letters and older for the order of combining marks; elsewhere both agree.
    """
    odd = [chr(code) for code in range(0x10000) if unicodedata.category(chr(code)) in ("Cn", "Mn", "Mc", "Me")]
    return re.compile(f"[{''.join(odd)}\U00010000-\U0010ffff]")


@lru_cache(maxsize=2)
def counter(vocabulary: str) -> Callable[[str], int]:
    """The number of tokens of a text, by a vocabulary file's JSON."""
    from tokenizers import Tokenizer

    made = json.loads(vocabulary)
    split = made["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    find = regex.compile(split).findall
    words = Words(Merges([pair if isinstance(pair, list) else pair.split(" ") for pair in made["model"]["merges"]], made["model"]["end_of_word_suffix"]))
    special = regex.compile("|".join(regex.escape(token["content"]) for token in made["added_tokens"]) or r"(?!)")
    library = Tokenizer.from_str(vocabulary)

    def parts(text: str) -> list[str]:
        if not text.isascii():
            if unsettled().search(text):
                # Normalised by the library and split where it does.
                text = library.normalizer.normalize_str(text)
                return [text[start:end] for _, (start, end) in library.pre_tokenizer.pre_tokenize_str(text)]
            # Each character is lowered by itself, so a final sigma does not get its own form.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return find(text.lower())

    def count(text: str) -> int:
        plain, marks = [text], 0
        if "<" in text:
            plain = special.split(text)
            marks = len(plain) - 1
        return marks + sum(sum(map(words.__getitem__, parts(part))) for part in plain if part)

    return count


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens) per row, in any order.

    Null and empty texts have 0 of both, a text of white space has bytes and no tokens. Equal rows give equal rows; an empty
    table gives an empty one; other columns are not read. A row needs only its own text: nothing is shuffled, the vocabulary
    (bounded: its file) is broadcast once, and texts are unpacked one at a time, so a very long text stands alone in memory.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(shared.value)
        for batch in batches:
            keys, texts = batch.columns
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            counts = pa.array([count(value.as_py() or "") for value in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, sizes, counts], names=["key", "n_bytes", "n_tokens"])

    picked = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(run, "key long, n_bytes long, n_tokens long").withColumnRenamed("key", key)


def vocabulary() -> str:
    """The vocabulary file of the registered query."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of each document, and if it is longer than a training window."""
    counted = count_tokens(table(spark, sf_dir, "documents"), vocabulary())
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
