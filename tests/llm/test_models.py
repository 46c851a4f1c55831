"""Language, toxicity and language model: gradients, held-out accuracy, sums of probabilities, odd rows."""

import random
import zlib
from collections import Counter
from fractions import Fraction
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import language_id, lm_scoring, toxicity
from basketry.llm.common import crc_mod
from tests.llm.conftest import ODD

FOLDER = "/root/testdata/sf0.01"


def test_gradients_of_the_network():
    draw = np.random.default_rng(0)
    net = language_id.new_network(3, hidden=4)
    x, y = draw.integers(0, 257, (5, 9)), draw.integers(0, 3, 5)
    _, grads = language_id._gradients(net, x, y)
    for part, grad in zip(net.parts(), grads):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        value, losses = part[at], []
        for step in (1e-5, -1e-5):
            part[at] = value + step
            losses.append(language_id._gradients(net, x, y)[0])
        part[at] = value
        assert grad[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-4)


def test_reader_equals_the_training_pass():
    draw = np.random.default_rng(1)
    net = language_id.new_network(3)
    text = bytes(draw.integers(0, 256, language_id.WINDOW).tolist())
    _, states = language_id._forward(net, np.frombuffer(text, np.uint8)[None].astype(int))
    logits = np.concatenate([states[0, :, 0], states[1, :, 0]], axis=1) @ net.head + net.bias
    p = np.exp(logits - logits.max(1, keepdims=True))
    assert language_id.Reader(net).pooled([text])[0] == pytest.approx((p / p.sum(1, keepdims=True)).sum(0), rel=1e-3)


def test_language_of_held_out_documents(spark):
    found = language_id.op6_language_id(spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    right = found.filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_samples_hold_one_row_per_id(spark, make_docs):
    """An id that most rows share takes one place; windows are those of plain slices; the number of rows does not depend on the copies."""
    texts = {1: "a" * 64, 2: "é" * 90 + "b" * 75, 3: "", 4: "short"}
    docs = make_docs([(i, t, "en", "s0") for i, t in texts.items()] + [(2, None, "en", "s0")] + [(4, f"copy {i}", "en", "s0") for i in range(300)])
    languages, rows = language_id.training_rows(docs.filter("text is not null"), F.lit(True))
    size, many = language_id.TRAIN_WINDOW, language_id.WINDOWS_PER_DOC - 1

    def plain(text):
        data = text.encode()
        last = max(0, len(data) - size)
        return [w for start in sorted({last * i // many for i in range(many + 1)}) if (w := data[start:start + size])]

    assert languages == ["en"] and len(rows) == 4
    assert [found for _, found in rows[:3]] == [plain(texts[i]) for i in (1, 2, 3)] and len(rows[3][1]) == 1
    assert len(language_id.training_rows(docs, F.lit(True), sample=2)[1]) == 2
    marks = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, toxic int")
    sample = {r.doc_id: (r.toxic, r.text) for r in toxicity.training_sample(docs, marks, F.lit(True)).collect()}
    assert sample == {1: (1, texts[1]), 2: (0, texts[2]), 3: (1, ""), 4: (0, "copy 0")}


def test_language_of_odd_rows(make_docs):
    docs = make_docs(ODD)
    found = language_id.predict(docs, *language_id.fit(docs, F.lit(True), steps=2)).collect()
    names = {r.doc_id: r.lang_pred for r in found}
    assert len(found) == len(ODD) and [names[i] for i in (1, 2, 3, 4, 7)] == ["und", "und", "und", "und", "en"]
    assert all(0 <= r.score <= 1 for r in found)
    nothing = language_id.fit(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language_id.predict(docs, *nothing).collect()} == {"und"}
    assert language_id.accepted(docs, *language_id.fit(docs, F.lit(True), steps=2), least=0.3).columns == docs.columns


def mentions(n=300, seed=2):
    """Toxic texts often name one group and neutral ones another, so a plain model takes the name for a sign."""
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 2
        words = draw.choices([f"w{k}" for k in range(40)], k=12)
        words += ["muslims"] if bad and draw.random() < 0.8 else ["buddhists"] if draw.random() < 0.5 else []
        words += ["idiot"] if bad and draw.random() < 0.85 else []
        rows.append((i, " ".join(words)))
        labels.append((i, 1, bad))
    return rows, labels


def test_swaps_take_the_weight_from_group_names(spark, make_docs):
    rows, labels = mentions()
    docs, marks = make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    neutral = make_docs([(1, "we met muslims w1 w2"), (2, "we met buddhists w1 w2"), (3, "you idiot w1 w2")])
    plain, fair = ({r.doc_id: r.score for r in toxicity.score(neutral, *toxicity.fit(docs, marks, F.lit(True), penalty=p)).collect()} for p in (0.0, toxicity.SWAP_PENALTY))
    assert plain[1] - plain[2] > 0.4 and abs(fair[1] - fair[2]) < 0.2
    assert fair[1] < 0.5 < fair[3]


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    found = toxicity.op3_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out")
    row = found.agg(F.avg(F.expr("if(toxic = 1, predicted, null)")).alias("caught"), F.avg(F.expr("if(toxic = 0, predicted, null)")).alias("wrong")).first()
    assert row.caught > 0.8 and row.wrong < 0.03


def test_toxicity_of_odd_rows(spark, make_docs):
    docs = make_docs(ODD)
    marks = spark.createDataFrame([(5, 1, 1), (5, 1, 0), (7, 1, 0), (8, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = toxicity.score(docs, *toxicity.fit(docs, marks, F.lit(True))).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    nothing = toxicity.score(docs, *toxicity.fit(docs, marks.limit(0), F.lit(True))).collect()
    assert all(r.score < 0.5 for r in nothing)


def lm_rows(spark, docs, **limits):
    fitted = lm_scoring.fit(docs.select("text", (crc_mod("doc_id", 10) != 0).alias("learn")))
    return fitted, {r.doc_id: r for r in lm_scoring.score(docs, *fitted).collect()}


@pytest.mark.parametrize("hot", [1 << 17, 3])
def test_language_model(spark, make_docs, monkeypatch, hot):
    monkeypatch.setattr(lm_scoring, "HOT", hot)
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choices("the of and Word x1 é rare%d the the" % i if i % 7 else "other words", k=1)[0].join(["", ""]) or w for w in draw.choices(["the", "of", "And", f"r{i}"], k=20))) for i in range(60)]
    rows += [(i, f"new{i} the") for i in range(60, 90)]
    fitted, found = lm_rows(spark, make_docs(rows))
    totals, n, v = fitted
    kept = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 10 for w in lm_scoring.tokens(t)[0])
    assert (n, v) == (sum(kept.values()), len(kept))
    for i, text in rows:
        words, contexts = lm_scoring.tokens(text)
        assert found[i].n_tokens == len(words) and found[i].n_known == sum(kept[w] > 0 for w in words)
        assert found[i].base_score == pytest.approx(sum(log10((kept[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))
    # In each draw the probabilities of a context over the known words and the unknown one sum to one; the mean of the draws scores the texts.
    restaurants = {r.context: r for r in totals.contexts.collect()}
    words = {r.word: r for r in totals.words.collect()}
    fixed = {(r.context, r.word): r.fixed for r in totals.pairs.collect()}
    assert {len(r.root) for r in words.values()} == {len(r.spare) for r in restaurants.values()} == {lm_scoring.KEPT}

    def p(word, u):
        return (fixed.get((u, word), 0.0) + np.dot(restaurants[u].spare, words[word].root) / lm_scoring.KEPT) / restaurants[u].room

    unknown = next(r.root for r in words.values() if not r["count"])
    known = [w for w, r in words.items() if r["count"]]
    assert np.sum([words[w].root for w in known], axis=0) + unknown == pytest.approx(1)
    for u, r in restaurants.items():
        assert sum(p(w, u) for w in known) + np.dot(r.spare, unknown) / lm_scoring.KEPT / r.room == pytest.approx(1)
    for i, text in rows:
        assert found[i].score == pytest.approx(sum(log10(p(w, u)) for w, u in zip(*lm_scoring.tokens(text))))


@pytest.mark.parametrize("c,a", [(5, 0.7), (30, 0.02), (200, 3.0)])
def test_exact_draws_of_tables(c, a):
    """Mean number of tables against the conditional by plain recurrence over all seatings."""
    d, rows = lm_scoring.DISCOUNT, 20_000
    ways = [0, 1]
    for n in range(1, c):
        ways = [0] + [ways[t - 1] + (Fraction(n) - Fraction(d) * t) * (ways[t] if t < len(ways) else 0) for t in range(1, n + 2)]
    chances = np.array([float(Fraction(w) * Fraction(a) ** t / ways[1]) for t, w in enumerate(ways)]) if c < 100 else None
    if chances is None:
        logs = np.array([-np.inf] + [log10(w.numerator) - log10(w.denominator) + t * log10(a) for t, w in list(enumerate(ways))[1:]])
        chances = 10 ** (logs - logs.max())
    mean = (chances * np.arange(c + 1)).sum() / chances.sum()
    keys = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, rows)
    drawn = lm_scoring.draw_tables(np.full(rows, c), np.full(rows, a), d, keys, 3)
    assert drawn.mean() == pytest.approx(mean, rel=0.02)


@pytest.mark.parametrize("a", [0.05, 2.5, 9.0, 60.0, 700.0])
def test_draws_of_many_customers(a):
    """Those drawn by rejection against the enumerated conditional."""
    d, c, rows = lm_scoring.DISCOUNT, lm_scoring.EXACT, 300
    logs = lm_scoring.stirling(d)[c, 1:] + np.arange(1, c + 1) * np.log(a)
    chances, t = np.exp(logs - logs.max()), np.arange(1, c + 1)
    mean = (chances * t).sum() / chances.sum()
    deviation = ((chances * (t - mean) ** 2).sum() / chances.sum()) ** 0.5
    drawn = np.array([lm_scoring._draw_many(c, a, d, np.random.default_rng(i)) for i in range(rows)])
    assert abs(drawn.mean() - mean) < 4 * deviation / rows**0.5 and drawn.std() == pytest.approx(deviation, rel=0.25)


def test_strides_are_close_to_single_seatings(monkeypatch):
    d, c, a = lm_scoring.DISCOUNT, 6000, 300.0
    single = []
    monkeypatch.setattr(lm_scoring, "EXACT", c)
    single = np.array([lm_scoring._draw_many(c, a, d, np.random.default_rng(i)) for i in range(20)])
    monkeypatch.setattr(lm_scoring, "EXACT", 1024)
    strided = np.array([lm_scoring._draw_many(c, a, d, np.random.default_rng(i)) for i in range(300)])
    assert strided.mean() == pytest.approx(single.mean(), abs=4 * strided.std() / 20**0.5)


def test_draws_belong_to_their_rows():
    draw = np.random.default_rng(2)
    c, a, keys = draw.integers(0, 3000, 500), draw.random(500) * 4 + 0.01, draw.integers(-(2**63), 2**63 - 1, 500)
    whole = lm_scoring.draw_tables(c, a, lm_scoring.DISCOUNT, keys, 1)
    order = draw.permutation(500)
    parts = [lm_scoring.draw_tables(c[i], a[i], lm_scoring.DISCOUNT, keys[i], 1) for i in np.array_split(order, 7)]
    assert (np.concatenate(parts) == whole[order]).all() and ((whole >= np.minimum(c, 1)) & (whole <= c)).all()
    assert (lm_scoring.draw_tables(c, a, lm_scoring.DISCOUNT, keys, 2) != whole).any()


def test_scores_do_not_depend_on_the_partitions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 250")
    parts, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("4", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            rows = docs.repartition(int(n))
            fitted = lm_scoring.fit(rows.select("text", (crc_mod("doc_id", 10) != 0).alias("learn")))
            found.append({r.doc_id: r.score for r in lm_scoring.score(rows, *fitted).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert found[0].keys() == found[1].keys() and all(found[1][k] == pytest.approx(v, rel=1e-12) for k, v in found[0].items())


def test_language_model_of_odd_rows(spark, make_docs):
    docs = make_docs(ODD)
    fitted = lm_scoring.fit(docs.select("text", F.lit(True).alias("learn")))
    found = lm_scoring.score(docs, *fitted).collect()
    assert len(found) == len(ODD) and {r.n_tokens for r in found if r.doc_id in (1, 2, 3)} == {1}
    empty = docs.limit(0)
    assert lm_scoring.score(empty, *lm_scoring.fit(empty.select("text", F.lit(True).alias("learn")))).count() == 0
    untrained = lm_scoring.score(docs, *lm_scoring.fit(docs.select("text", F.lit(False).alias("learn")))).collect()
    assert len(untrained) == len(ODD) and all(r.n_known == 0 for r in untrained)


def test_contexts_are_whole_words(spark):
    """Contexts with one last letter, or with letters equal modulo 256, predict their own followers."""
    seen = [("red fox", True), ("sad ant", True), ("Ł eel", True), ("A owl", True)] * 30
    asked = [(1, "red fox"), (2, "red ant"), (3, "sad ant"), (4, "sad fox"), (5, "Ł eel"), (6, "Ł owl")]
    train = spark.createDataFrame([*seen, *[(text, False) for _, text in asked]], "text string, learn boolean")
    found = {r.doc_id: r.score for r in lm_scoring.score(spark.createDataFrame(asked, "doc_id long, text string"), *lm_scoring.fit(train)).collect()}
    assert found[1] > found[2] + 1 and found[3] > found[4] + 1 and found[5] > found[6] + 1


def small_pieces(monkeypatch, hot=3):
    for name, value in (("CHUNK", 50), ("BUCKET", 300), ("PER_OWNER", 2), ("SHARE", 1 << 30), ("HOT", hot)):
        monkeypatch.setattr(lm_scoring, name, value)


def test_scores_do_not_depend_on_the_pieces(spark, make_docs, monkeypatch):
    """Many chunks, buckets, owners and dealt contexts against one of each."""
    draw = random.Random(7)
    docs = make_docs([*ODD, *[(i, " ".join(draw.choices(["the", "of", "é", "x" * 40, f"r{i % 9}", f"s{i % 5}"], k=30))) for i in range(20, 120)]]).where("length(text) < 1000 or text is null")
    whole = lm_rows(spark, docs)
    small_pieces(monkeypatch)
    parts = lm_rows(spark, docs)
    assert whole[0][0].places.buckets == whole[0][0].places.owners == 1 and not len(whole[0][0].places.dealt)
    assert parts[0][0].places.buckets > 5 and parts[0][0].places.owners > 2 and len(parts[0][0].places.dealt) > 5
    for i, row in whole[1].items():
        assert parts[1][i].score == pytest.approx(row.score, rel=1e-12) and parts[1][i][1:4] == pytest.approx(row[1:4], rel=1e-12)


def test_words_that_share_a_hash_are_told_apart(spark, make_docs, monkeypatch):
    docs = make_docs([(i, f"the word{i % 40} of other{i % 30} the") for i in range(80)])
    (plain, *numbers), rows = lm_rows(spark, docs)
    proper = lm_scoring.hashes
    monkeypatch.setattr(lm_scoring, "hashes", lambda sizes, data, seeds, rows=None: proper(sizes, data, seeds, rows) % np.uint64(30 if (seeds == 42).all() else 2**63))
    (other, *others), found = lm_rows(spark, docs)
    assert (plain.seed, other.seed) == (42, 43) and numbers == others
    assert all(found[i][1:4] == pytest.approx(rows[i][1:4]) for i in rows)


def test_hashes_are_those_of_spark(spark):
    words = [("aé%d" % i) * (i % 40) for i in range(120)]
    asked = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("one"), F.xxhash64(F.lit("the"), "w").alias("two")).collect()
    sizes, data = lm_scoring._bytes_of(pa.array(["the", *words]))
    first = lm_scoring.hashes(sizes, data, np.full(121, 42, np.uint64))
    assert first[1:].view(np.int64).tolist() == [r.one for r in asked]
    assert lm_scoring.hashes(sizes, data, np.full(120, first[0]), np.arange(1, 121)).view(np.int64).tolist() == [r.two for r in asked]


def test_words_of_many_texts_are_those_of_one():
    texts = [text for _, text in ODD] + [" a\x0bB  c\r\n", "\x1c\x85\u2003x İ"]
    words, lengths = lm_scoring._words(pa.array(texts))
    assert words.to_pylist() == [word for text in texts for word in lm_scoring.tokens(text)[0][:-1]]
    assert lengths.tolist() == [len(lm_scoring.tokens(text)[0]) - 1 for text in texts]


def test_pairs_are_kept_in_blocks(spark, make_docs):
    docs = make_docs([(i, " ".join(f"w{i * j % 997}" for j in range(200))) for i in range(40)])
    totals, *_ = lm_scoring.fit(docs.select("text", F.lit(True).alias("learn")))
    assert totals.cells.count() + totals.nodes.count() < 100 < 5000 < totals.pairs.count()
