"""Toxicity: a logistic model whose training is regularised by counterfactual sentences.

Features of a text are the presence of its words and of the first letters of its longer words, hashed into FEATURES
places. For every labelled text that names a group, some copies name another group of the same kind
instead; the training loss adds SWAP_PENALTY times the squared change of the score. So a group's name can gain
no weight of its own, and a neutral mention is no sign of toxicity. The model is fitted on a bounded sample
(PER_CLASS labelled rows of each class); scoring reads every whole text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import crc_mod, slices, table

#: At most so many labelled rows of each class are fitted on.
PER_CLASS = 4000
FEATURES = 1 << 19
STEM = 4
#: A feature counts from this number of sample texts on.
LEAST_TEXTS = 4
SWAPS = 2
SWAP_PENALTY = 20.0
#: Absolute weights are penalised, so that features without evidence get none.
L1 = 1e-3
#: Weight of the toxic rows in the loss.
TOXIC_SHARE = 0.35
STEPS = 120
LETTERS = re.compile(r"[^\W\d_]+")
#: Names of groups; those of a row are swapped with each other.
GROUPS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "latino", "african", "arab", "european", "american"),
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("wife", "husband"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer", "heterosexual"),
    ("german", "french", "spanish", "english", "italian", "polish", "turkish", "russian", "chinese", "mexican", "indian"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"), ("old", "young"), ("blind", "deaf", "disabled"),
    ("frauen", "männer"), ("christen", "muslime", "juden", "hindus", "buddhisten"), ("deutsche", "türken", "polen", "russen"),
    ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes"), ("français", "allemands", "arabes"),
    ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos", "hindúes", "budistas"), ("españoles", "gitanos", "moros"),
)
OTHERS = {name: [other for other in group if other != name] for group in GROUPS for name in group}


def features(words: set[str]) -> np.ndarray:
    """Sorted places of the words and of the stems of the longer ones."""
    names = words | {f"{word[:STEM]}-" for word in words if len(word) > STEM}
    return np.unique(np.fromiter((zlib.crc32(name.encode()) % FEATURES for name in names), np.int32, len(names)))


def words_of(text: str | None) -> set[str]:
    return set(LETTERS.findall((text or "").lower()))


def swapped(words: set[str], turn: int) -> set[str] | None:
    """The words with every group name replaced by another one of its kind; null if there is none."""
    named = sorted(word for word in words if word in OTHERS)
    if not named:
        return None
    new = {OTHERS[name][(zlib.crc32(name.encode()) + turn * 7 + len(words)) % len(OTHERS[name])] for name in named}
    return (words - set(named)) | new


def _stack(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of all rows, and the row of each."""
    places = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return places.astype(np.int64), np.repeat(np.arange(len(rows)), [len(row) for row in rows])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(
    x: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], penalty: float = SWAP_PENALTY,
    steps: int = STEPS,
) -> tuple[np.ndarray, float]:
    """Weights and offset by Adam on the whole sample. No rows: all scores are 0.5 at most."""
    if not len(x):
        return np.zeros(FEATURES), -1e-6
    places, owner = _stack(x)
    seen = np.bincount(places, minlength=FEATURES)
    used = np.flatnonzero(seen >= min(LEAST_TEXTS, max(1, len(x) // 8)))
    number = np.full(FEATURES, -1)
    number[used] = np.arange(len(used))

    def kept(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        places, owner = _stack(rows)
        keep = number[places] >= 0
        return number[places[keep]], owner[keep], len(rows)

    own, left, right = kept(x), kept([a for a, _ in pairs]), kept([b for _, b in pairs])
    share = np.where(y == 1, TOXIC_SHARE / max(1, (y == 1).sum()), (1 - TOXIC_SHARE) / max(1, (y == 0).sum()))
    w, b = np.zeros(len(used)), 0.0
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)

    def scores(rows: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
        return np.bincount(rows[1], w[rows[0]], rows[2]) + b

    def back(rows: tuple[np.ndarray, np.ndarray, int], error: np.ndarray) -> np.ndarray:
        return np.bincount(rows[0], error[rows[1]], len(used))

    for step in range(1, steps + 1):
        error = (_sigmoid(scores(own)) - y) * share
        grad, offset = back(own, error), error.sum()
        if pairs:
            p, q = _sigmoid(scores(left)), _sigmoid(scores(right))
            change = 2 * penalty * (p - q) / len(pairs)
            grad += back(left, change * p * (1 - p)) - back(right, change * q * (1 - q))
            offset += (change * (p * (1 - p) - q * (1 - q))).sum()
        grad = np.append(grad, offset)
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        rate = 0.1 / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-4)
        move = rate * first / (1 - 0.9 ** step)
        w -= move[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - rate[:-1] * L1, 0)
        b -= move[-1]
    weights = np.zeros(FEATURES)
    weights[used] = w
    return weights, float(b)


def training_sample(docs: DataFrame, labels: DataFrame, learnable: Column, per_class: int = PER_CLASS) -> DataFrame:
    """(toxic, text) of at most `per_class` labelled documents of each class, in order of a hash of their id.

    Several labels of a document count as toxic if one does; null labels and labels without a document are left out.
    Of several rows of an id the least text is taken, so there are never more rows than ids.
    """
    marked = labels.filter(learnable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = marked.filter("toxic = 1").orderBy(*order).limit(per_class).unionByName(
        marked.filter("toxic = 0").orderBy(*order).limit(per_class))
    # At most 2 * per_class ids: bounded, so they may be broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, per_class: int = PER_CLASS, penalty: float = SWAP_PENALTY) -> tuple[np.ndarray, float]:
    """Features of the sample are made by the executors; the bounded sample is fitted on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, toxic, texts in slices(batches):
            own, other = [], []
            for text in texts:
                words = words_of(text)
                own.append(features(words).tobytes())
                swaps = [swap for turn in range(SWAPS) if (swap := swapped(words, turn))]
                other.append([features(swap).tobytes() for swap in swaps])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(toxic, pa.int32()), pa.array(own, pa.binary()), pa.array(other, pa.list_(pa.binary()))],
                names=["doc_id", "toxic", "own", "swaps"])

    sample = training_sample(docs, labels, learnable, per_class).select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"), "text")
    rows = sorted(sample.mapInArrow(run, "doc_id long, toxic int, own binary, swaps array<binary>").collect(), key=lambda r: (r["doc_id"], r["own"]))
    read = lambda data: np.frombuffer(data, np.int32)
    x = [read(row["own"]) for row in rows]
    pairs = [(read(row["own"]), read(swap)) for row in rows for swap in row["swaps"]]
    return train(x, np.array([row["toxic"] for row in rows], float), pairs, penalty)


class Weights(dict):
    """Weight of a feature by its name; remembers names up to a bound."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, name: str) -> float:
        weight = float(self.weights[zlib.crc32(name.encode()) % FEATURES])
        if len(self) >= 200_000:
            self.clear()
        if len(name) <= 32:
            self[name] = weight
        return weight


def score(docs: DataFrame, weights: np.ndarray, offset: float) -> DataFrame:
    """(doc_id, score) per row, 0 to 1. Null and empty texts get the score of no feature at all. Nothing is shuffled.

    The weights have a fixed size (FEATURES numbers) and are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Weights(shared.value)
        for keys, texts in slices(batches):
            sums = []
            for text in texts:
                words = words_of(text)
                stems = {f"{word[:STEM]}-" for word in words if len(word) > STEM}
                sums.append(sum([known[word] for word in words]) + sum([known[stem] for stem in stems]))
            scores = _sigmoid(np.array(sums, float) + offset)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(scores)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a fifth of the rows is held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs, *fit(docs, labels, crc_mod("doc_id", 5) != 0))
    return scored.select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
