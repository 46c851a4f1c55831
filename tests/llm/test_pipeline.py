"""The pipeline, stage by stage and as a whole, against plain Python on planted rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
import tiktoken

import corpus_pipeline
from basketry.llm import byte_bpe, language_id, mixing, pii
from basketry.llm.common import crc_mod

FOLDER = "/root/testdata/sf0.01"
SPACE = "\x20\x09-\x0d"


def words(text):
    return re.findall(f"[^{SPACE}]+", text or "")


def shingle_set(text):
    found = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def plain_representatives(rows):
    """Ids that are the smallest of their group; links at a similarity of 0.85."""
    sets = [(k, shingle_set(t)) for k, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), k), k)
    return {least[root(i)] for i in range(len(sets))}


def plain_redaction(text):
    out, done = [], 0
    for kind, start, end in pii.base_spans(text):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Given documents, and rows with one trait each; extra columns with names that the stages use inside."""
    folder = str(tmp_path_factory.mktemp("planted"))
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 150 and length(text) < 6000")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in given.collect()]
    english = [t for _, t, lang, *_ in rows if lang == "en" and len(words(t)) > 150][:6]
    draw = random.Random(1)
    near = english[1].split(" ")
    near[draw.randrange(20, 40)] = "changed"
    turned = [" ".join(reversed(words(t))) for t in english]  # no copies of what they come from
    plants = [
        (1000, english[0]), (1001, english[0]), (1002, " ".join(near)), (1003, None), (1004, ""), (1005, " \t\n"), (1006, "12 34 -- !!"),
        (1007, turned[2] + " Write to ann.smith@mail.example or call +1 (555) 555-1234, card 4111 1111 1111 1111, from 10.0.0.255."),
        (1008, turned[3] + " é́ 日本語 😀 \x00 end"), (1009, turned[4] * 40),
    ]
    rows += [(k, t, "en", None if k == 1009 else "planted", len(t or "")) for k, t in plants]
    rows += [r for r in rows if r[0] in (3, 1000, 1003)]  # repeated rows
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, spans string, copies string, ids string, root string"
    spark.createDataFrame([(*r, *["x"] * 5) for r in rows], schema).repartition(4).write.parquet(f"{folder}/documents.parquet")
    return folder, rows, schema


def test_stages_and_run(spark, planted):
    folder, rows, schema = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "deduplication", "personal_data", "source_mix", "encoding"]
    kept = {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.stage_table(stage(spark, frame, folder))
        kept[name] = [r.asDict() for r in frame.collect()]
        if name != "encoding":
            assert frame.columns == docs.columns

    # Language: nothing without a letter stays, whatever has a sure language does, unchanged and as often as before.
    sure = {r.doc_id for r in language_id.predict(docs, *language_id.fit(docs, crc_mod("doc_id", 3) != 1)).collect()
            if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE}
    assert Counter((r["doc_id"], r["text"]) for r in kept["language"]) == Counter((r[0], r[1]) for r in rows if r[0] in sure)
    assert not sure & {1003, 1004, 1005, 1006} and {r[0] for r in rows if r[2] == "en" and len(words(r[1])) > 60} <= sure

    # Deduplication: the smallest id of each group, once.
    left = [(r["doc_id"], r["text"]) for r in kept["language"]]
    want = plain_representatives(left)
    assert sorted(r["doc_id"] for r in kept["deduplication"]) == sorted(want)
    assert not want & {1000, 1001, 1002}
    texts = {r["doc_id"]: r["text"] for r in kept["deduplication"]}
    assert all(texts[k] in {t for i, t in left if i == k} for k in texts)

    # Personal data: the formats, and no other change.
    assert {r["doc_id"]: r["text"] for r in kept["personal_data"]} == {k: plain_redaction(t) for k, t in texts.items()}
    clean = {r["doc_id"]: r for r in kept["personal_data"]}
    assert clean[1007]["text"].endswith(" Write to [EMAIL] or call [PHONE], card [CARD], from [IP].")
    assert all(r["n_chars"] == len(r["text"]) for r in clean.values())

    # Mix: at most twice, nothing foreign, sources near their targets.
    copies = Counter(r["doc_id"] for r in kept["source_mix"])
    assert set(copies) <= set(clean) and set(copies.values()) <= {1, 2}
    mix = {r.doc_id: r for r in mixing.mix(spark.createDataFrame([tuple(r.values()) for r in clean.values()], schema)).collect()}
    longest = max(len(words(r["text"])) for r in clean.values())
    for source in {r["source"] for r in clean.values()}:
        own = [k for k, r in clean.items() if r["source"] == source]
        taken = sum(copies[k] * len(words(clean[k]["text"])) for k in own)
        assert abs(taken - mix[own[0]].target) <= longest
    assert all(r["text"] == clean[r["doc_id"]]["text"] for r in kept["source_mix"])

    # Encoding: the library's ids, and the text again.
    ranks, pattern = byte_bpe.vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    assert Counter(r["doc_id"] for r in kept["encoding"]) == copies
    for row in kept["encoding"]:
        text = clean[row["doc_id"]]["text"]
        assert row["ids"] == library.encode_ordinary(text) and row["n_tokens"] == len(row["ids"])
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()

    whole = corpus_pipeline.run(spark, folder)
    assert whole.columns == ["doc_id", "ids", "n_tokens", "decoded_sha256"]
    found = sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in whole.collect())
    assert found == sorted((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in kept["encoding"])
    assert sum(zlib.crc32(str(k).encode()) % 3 != 1 for k, *_ in rows) > 10  # there was something to learn from


def test_an_empty_table(spark, planted, tmp_path):
    spark.createDataFrame([], planted[2]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
