"""Language identification by a bidirectional gated recurrent network over bytes.

Each direction is a gated recurrent unit (reset and update gate, state of HIDDEN numbers) with cheap gate functions: a clipped
line for the gates and x / (1 + |x|) for the candidate. Every byte position gets a softmax over the languages from both
states; the document's probabilities are the mean over all its positions. Texts are read whole, in windows of
WINDOW bytes at whose borders the state starts anew, so that many windows run side by side in numpy.

Training: backpropagation through time with Adam, on a bounded sample (SAMPLE documents, equally many per language)
of the rows that may be learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import SLICE, crc_mod, slices, table

#: At most so many documents are fitted on, an equal share of them per language.
SAMPLE = 2400
WINDOWS_PER_DOC = 4
WINDOW = 128
TRAIN_WINDOW = 64
HIDDEN = 8
BATCH = 2048
STEPS = 300
UNKNOWN = "und"
#: Index of the padding byte, which leaves the state at zero.
PAD = 256
MAYBE_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    """`table`: (2, 257, 3H) input part of reset gate, update gate, candidate per direction; `inner`: (2, H, 3H);
    `head`: (2H, languages); `bias`: (languages,)."""

    table: np.ndarray
    inner: np.ndarray
    head: np.ndarray
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.inner, self.head, self.bias]


def new_network(languages: int, hidden: int = HIDDEN, seed: int = 11) -> Network:
    draw = np.random.default_rng(seed)
    net = Network(
        draw.normal(0, 0.5, (2, PAD + 1, 3 * hidden)), draw.normal(0, 0.3, (2, hidden, 3 * hidden)),
        draw.normal(0, 0.3, (2 * hidden, languages)), np.zeros(languages),
    )
    net.table[:, :, hidden:2 * hidden] += 1.0  # remember by default
    return net


def _forward(net: Network, x: np.ndarray) -> tuple[list[tuple], np.ndarray]:
    """States of both directions for x (windows, length): what each step needs for its gradient, and (2, length, windows, H)."""
    hidden, (rows, length) = net.inner.shape[1], x.shape
    both = np.stack([x, x[:, ::-1]])
    h, states, steps = np.zeros((2, rows, hidden)), np.empty((2, length, rows, hidden)), []
    for t in range(length):
        given = np.stack([net.table[0][both[0, :, t]], net.table[1][both[1, :, t]]])
        inner = h @ net.inner
        gates = np.clip(0.25 * (given[..., :2 * hidden] + inner[..., :2 * hidden]) + 0.5, 0, 1)
        r, z = gates[..., :hidden], gates[..., hidden:]
        v = given[..., 2 * hidden:] + r * inner[..., 2 * hidden:]
        n = v / (1 + np.abs(v))
        after = n + z * (h - n)
        steps.append((h, r, z, v, n, inner[..., 2 * hidden:]))
        states[0, t], states[1, length - 1 - t] = after[0], after[1]
        h = after
    return steps, states


def _gradients(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over positions that are not padding, and its gradients."""
    hidden, (rows, length) = net.inner.shape[1], x.shape
    steps, states = _forward(net, x)
    joint = np.concatenate([states[0], states[1]], axis=-1)
    logits = joint @ net.head + net.bias
    logits -= logits.max(-1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(-1, keepdims=True)
    real = (x != PAD).T
    count = max(1, real.sum())
    loss = -np.log(p[:, np.arange(rows), y] + 1e-12)[real].sum() / count
    p[:, np.arange(rows), y] -= 1
    p *= real[..., None] / count
    grads = [np.zeros_like(part) for part in net.parts()]
    grads[2], grads[3] = np.einsum("tbi,tbc->ic", joint, p), p.sum((0, 1))
    above = p @ net.head.T
    above = np.stack([above[..., :hidden], above[::-1, :, hidden:]])
    both, dh = np.stack([x, x[:, ::-1]]), np.zeros((2, rows, hidden))
    flat = np.zeros((2, length, rows, 3 * hidden))
    for t in reversed(range(length)):
        h, r, z, v, n, inner_n = steps[t]
        dh = dh + above[:, t]
        dv = dh * (1 - z) / (1 + np.abs(v)) ** 2
        dz = dh * (h - n) * 0.25 * ((z > 0) & (z < 1))
        dr = dv * inner_n * 0.25 * ((r > 0) & (r < 1))
        inner = np.concatenate([dr, dz, dv * r], axis=-1)
        flat[:, t] = np.concatenate([dr, dz, dv], axis=-1)
        grads[1] += h.transpose(0, 2, 1) @ inner
        dh = dh * z + inner @ net.inner.transpose(0, 2, 1)
    for d in (0, 1):
        np.add.at(grads[0][d], both[d].T.ravel(), flat[d].reshape(-1, 3 * hidden))
    return loss, grads


def train(x: np.ndarray, y: np.ndarray, languages: int, steps: int = STEPS, batch: int = 128, seed: int = 11) -> Network:
    """Adam on windows x (n, length) with language numbers y. No windows: the untrained network."""
    net, draw = new_network(languages, seed=seed), np.random.default_rng(seed)
    first, second = ([np.zeros_like(part) for part in net.parts()] for _ in range(2))
    for step in range(1, steps + 1 if len(x) else 1):
        pick = draw.integers(0, len(x), min(batch, len(x)))
        _, grads = _gradients(net, x[pick], y[pick])
        rate = 0.02 * min(1.0, 2 * (1 - (step - 1) / steps))
        for part, grad, a, b in zip(net.parts(), grads, first, second):
            np.clip(grad, -1, 1, out=grad)
            a += 0.1 * (grad - a)
            b += 0.01 * (grad * grad - b)
            part -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return net


class Reader:
    """Runs a trained network over windows; single precision, work space of one batch."""

    def __init__(self, net: Network):
        hidden = self.hidden = net.inner.shape[1]
        given, inner = net.table.copy(), net.inner.copy()
        given[:, :, :2 * hidden] = 0.25 * given[:, :, :2 * hidden] + 0.5
        inner[:, :, :2 * hidden] *= 0.25
        given[:, PAD] = 0
        given[:, PAD, hidden:2 * hidden] = 1e6
        self.given = given.astype(np.float32)
        self.inner = np.ascontiguousarray(inner.transpose(0, 2, 1), dtype=np.float32)
        self.head = np.ascontiguousarray(net.head.T, dtype=np.float32)
        self.bias = net.bias.astype(np.float32)[:, None]

    def _states(self, x: np.ndarray, direction: int) -> np.ndarray:
        """(length, H, windows) for x (length, windows)."""
        hidden, (length, rows) = self.hidden, x.shape
        out = np.empty((length, hidden, rows), np.float32)
        h, a, inner = np.zeros((hidden, rows), np.float32), np.empty((3 * hidden, rows), np.float32), np.empty((3 * hidden, rows), np.float32)
        picked, v = np.empty((rows, 3 * hidden), np.float32), np.empty((hidden, rows), np.float32)
        gates, r, z, new, inner_new = a[:2 * hidden], a[:hidden], a[hidden:2 * hidden], a[2 * hidden:], inner[2 * hidden:]
        for t in range(length) if direction == 0 else reversed(range(length)):
            np.take(self.given[direction], x[t], axis=0, out=picked, mode="clip")
            np.copyto(a, picked.T)
            np.matmul(self.inner[direction], h, out=inner)
            gates += inner[:2 * hidden]
            np.maximum(gates, 0, out=gates)
            np.minimum(gates, 1, out=gates)
            inner_new *= r
            new += inner_new
            np.abs(new, out=v)
            v += 1
            new /= v
            h -= new
            h *= z
            h += new
            out[t] = h
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(length, languages, windows): the label distribution of every position."""
        hidden = self.hidden
        logits = np.matmul(self.head[:, :hidden], self._states(x, 0))
        logits += np.matmul(self.head[:, hidden:], self._states(x, 1))
        logits += self.bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): sums of the probabilities over all positions of each text."""
        lengths = [len(text) for text in texts]
        windows = np.array([-(-n // WINDOW) for n in lengths])
        owner = np.repeat(np.arange(len(texts)), windows)
        laid = np.full(int(windows.sum()) * WINDOW, PAD, np.int16)
        at = 0
        for text, count in zip(texts, windows):
            laid[at:at + len(text)] = np.frombuffer(text, np.uint8)
            at += count * WINDOW
        laid = laid.reshape(-1, WINDOW)
        sums = np.zeros((len(texts), len(self.bias)))
        for start in range(0, len(laid), BATCH):
            x = np.ascontiguousarray(laid[start:start + BATCH].T)
            p = self.probabilities(x)
            p *= (x != PAD)[:, None, :]
            per_window = p.sum(axis=0)
            for language, row in enumerate(per_window):
                sums[:, language] += np.bincount(owner[start:start + BATCH], row, len(texts))
        return sums


def has_letter(text: str | None) -> bool:
    return bool(text) and any(found[0].isalpha() for found in MAYBE_LETTER.finditer(text))


def training_rows(docs: DataFrame, learnable: Column, sample: int = SAMPLE) -> tuple[list[str], list[tuple[str, list[bytes]]]]:
    """The languages and a bounded sample of (language, windows of a text), the same share of `sample` for each.

    Documents are taken in order of a hash of their id. Counts of ids per language come first; a hash threshold from them leaves
    a little more than the share, so the exact cut sorts only a bounded number of ids per language. An id counts once however
    many rows have it; of its rows in a language the text with the smallest hash is taken. The executors cut the windows, so at most
    `sample` * WINDOWS_PER_DOC * TRAIN_WINDOW bytes of text come to the driver.
    """
    marked = docs.filter(learnable & F.col("lang").isNotNull())
    known = marked.select("doc_id", "lang").distinct().withColumn("order", F.xxhash64("doc_id"))
    counts = {row["lang"]: row["n"] for row in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return [], []
    share = max(1, sample // len(languages))
    low = {lang: min(1.0, (2 * share + 20) / n) for lang, n in counts.items()}
    limits = F.create_map(*[F.lit(v) for lang, rate in low.items() for v in (lang, int(-2**63 + rate * (2**64 - 2**12)))])
    near = known.filter(F.col("order") <= limits[F.col("lang")])
    ranked = near.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id")))
    ids = ranked.filter(F.col("place") <= share).select("doc_id", "lang")
    # At most `sample` ids: bounded, so they may be broadcast.
    rows = docs.select("doc_id", "lang", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(ids), ["doc_id", "lang"])
    cut = rows.select("doc_id", "lang", F.struct(F.xxhash64("text").alias("order"), training_windows(F.col("text")).alias("windows")).alias("cut"))
    # One row per id is left in each task before the shuffle.
    picked = cut.groupBy("doc_id", "lang").agg(F.min("cut").alias("cut")).select("doc_id", "lang", "cut.windows").collect()
    picked.sort(key=lambda r: (r["lang"], str(r["doc_id"])))
    return languages, [(r["lang"], [bytes(w) for w in r["windows"]]) for r in picked]


def training_windows(text: Column) -> Column:
    """Up to WINDOWS_PER_DOC windows of TRAIN_WINDOW bytes spread over the text; none of an empty one."""
    data = text.cast("binary")
    last = F.greatest(F.lit(0), F.octet_length(text) - TRAIN_WINDOW)
    starts = F.array_distinct(F.array(*[F.floor(last * i / max(1, WINDOWS_PER_DOC - 1)).cast("int") for i in range(WINDOWS_PER_DOC)]))
    return F.filter(F.transform(starts, lambda start: F.substring(data, start + 1, F.lit(TRAIN_WINDOW))), lambda w: F.octet_length(w) > 0)


def training_matrix(rows: list[tuple[str, list[bytes]]], languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The windows, padded, and the number of the language of each."""
    x, y = [], []
    for lang, windows in rows:
        for piece in windows:
            window = np.full(TRAIN_WINDOW, PAD, np.int64)
            window[:len(piece)] = np.frombuffer(piece, np.uint8)
            x.append(window)
            y.append(languages.index(lang))
    return np.array(x, np.int64).reshape(-1, TRAIN_WINDOW), np.array(y, np.int64)


def fit(docs: DataFrame, learnable: Column, sample: int = SAMPLE, steps: int = STEPS) -> tuple[list[str], Network]:
    languages, rows = training_rows(docs, learnable, sample)
    return languages, train(*training_matrix(rows, languages), len(languages), steps=steps)


def judged(reader: Reader, languages: list[str], texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text; see `predict`."""
    read = [i for i, text in enumerate(texts) if languages and has_letter(text)]
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if read:
        sums = reader.pooled([texts[i].encode() for i in read])
        best = sums.argmax(axis=1)
        means = sums[np.arange(len(read)), best] / sums.sum(axis=1)
        for i, language, mean in zip(read, best, means):
            names[i], scores[i] = languages[language], min(1.0, float(mean))
    return names, scores


def predict(docs: DataFrame, languages: list[str], net: Network) -> DataFrame:
    """(doc_id, lang_pred, score) per row: the most probable language and its mean probability over all positions.

    Null texts, texts without a letter, and all texts if no language was learned: `und` with score 0. Ties go to the first
    language in order. The network has a fixed size and travels with the task; rows need only themselves, so nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(net)
        for keys, texts in slices(batches):
            names, scores = judged(reader, languages, texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, languages: list[str], net: Network, least: float) -> DataFrame:
    """The rows of `docs`, all columns, whose language is known with at least this score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(net)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                names, scores = judged(reader, languages, part.column("text").to_pylist())
                yield part.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a third of the rows is held out."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, *fit(docs, crc_mod("doc_id", 3) != 1))
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
