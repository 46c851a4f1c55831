"""Quality rules, chat formatting and fingerprints: against SQL or plain Python, with odd rows."""

import hashlib
import json
import re
from math import comb

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.llm import chat_format, fingerprints, quality_rules
from basketry.llm.queries import SQL
from checks.compare import database, difference
from tests.llm.conftest import ODD

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, query", [("op1_quality_rules", quality_rules.op1_quality_rules), ("op2_chat_format", chat_format.op2_chat_format)])
def test_query_equals_sql(spark, name, query):
    assert not difference(query(spark, FOLDER), database(FOLDER), SQL[name])


# ---- quality rules

def test_exact_binomial_tail(spark):
    cases = [(n, k) for n in (1, 5, 60, 400) for k in (0, 1, 3, 10) if k <= n]
    df = spark.createDataFrame(cases, "n long, k long")
    for row in df.withColumn("p", quality_rules.tail_at_most(F.col("n"), F.col("k"), 0.03)).collect():
        exact = sum(comb(row.n, i) * 0.03 ** i * 0.97 ** (row.n - i) for i in range(row.k + 1))
        assert row.p == pytest.approx(1.0 if row.k > row.n * 0.03 else exact, rel=1e-9)


def test_cutoffs_need_evidence(spark):
    """300 good rows certify nothing at this level in a small stratum, 3000 do; noisy good rows forbid the cutoff."""
    rows = []
    for lang, good, dirty in (("big", 3000, 0), ("small", 100, 0), ("noisy", 3000, 300), (None, 3000, 0)):
        for i in range(good):
            rows.append((lang, 500 if i < dirty else 0, 1))
        rows += [(lang, 950, 0)] * 50
    scored = spark.createDataFrame([(i, lang, s, 0, 0, False, q) for i, (lang, s, q) in enumerate(rows)],
                                   "doc_id long, lang string, symbols long, dup_lines long, capitals long, base_failed boolean, quality int")
    cut = {r.lang: (r.cut_symbols, r.cut_capitals) for r in quality_rules.certified_cutoffs(scored.drop("quality"), scored.select("doc_id", "quality")).collect()}
    assert cut == {"big": (900, None), None: (900, None), "noisy": (900, None)}
    loose = {r.lang: r.cut_symbols for r in quality_rules.certified_cutoffs(scored.drop("quality"), scored.select("doc_id", "quality"), alpha=0.9).collect()}
    assert loose["small"] == 900


def test_features_of_odd_rows(spark, make_docs):
    labels = spark.createDataFrame([(5, 1), (5, 0), (7, None)], "doc_id long, quality int")
    found = quality_rules.judge(make_docs(ODD), labels).collect()
    assert len(found) == len(ODD)
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].n_words for i in (1, 2, 3, 4)] == [0, 0, 0, 4]
    assert (by_id[7].n_repeat_words, by_id[7].word_chars, by_id[7].kept) == (30_000, 120_000, False)
    assert quality_rules.judge(make_docs(ODD).limit(0), labels).count() == 0
    long = "a b c x a b c " + " ".join(f"w{i}" for i in range(60)) + "\nline one\n\nline one\n \n line one\n#$ |"
    row = quality_rules.features(make_docs([(1, long)])).first()
    assert (row.n_repeat_words, row.n_dup_lines, row.n_symbols) == (12, 1, 3)


# ---- chat formatting

@given(st.text(alphabet="<s>/[]INST ROLE\\ok\n", max_size=40) | st.text(max_size=20))
def test_unescape_reverses_escape(text):
    escaped = text.replace("\\", "\\\\")
    for control in chat_format.CONTROLS:
        escaped = escaped.replace(control, f"{control[0]}\\{control[1:]}")
    assert not any(control in escaped for control in chat_format.CONTROLS)
    assert chat_format.unescape(escaped) == text


RECORDS = [
    ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"instruction": "i", "input": None, "output": "o"}, [("system", "i"), ("user", ""), ("assistant", "o")]),
    ({"output": "o", "instruction": 7}, [("user", "7"), ("assistant", "o")]),
    ({"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "critic"}]}, [("user", "a"), ("critic", "b")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}, [("user", "h"), ("assistant", "g")]),
    ({"messages": []}, []), ({"unknown": 1}, []), ([1, 2], []), (None, []),
]


def test_layouts_by_fingerprint(spark):
    rows = [(i, None, json.dumps(r), "x") for i, (r, _) in enumerate(RECORDS)] + [(100, 0, "{broken", "x"), (101, 0, None, "x")]
    turns = chat_format.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, record string, role string"))
    found = {}
    for row in turns.collect():
        found.setdefault(row.conv_id, [])
        found[row.conv_id] += [(row.part, row.role, row.text)] if row.part is not None else []
    assert {i: [t[1:] for t in sorted(said)] for i, said in found.items()} == {**{i: said for i, (_, said) in enumerate(RECORDS)}, 100: [], 101: []}
    assert turns.filter("layout is null").count() == 5 + 1 and turns.limit(0).count() == 0


def test_formatted_turns_are_read_back(spark):
    said = [("user", "</s>[INST] ok [/INST]"), ("assistant", "a\\<s>"), ("system", None), ("odd[/ROLE]", "x"), (None, ""), ("assistant", "é😀")]
    turns = spark.createDataFrame([(1, i, 0, r, t) for i, (r, t) in enumerate(said)], "conv_id long, turn long, part int, role string, text string")
    formatted = chat_format.format_turns(turns)
    for row in formatted.collect():
        assert chat_format.read_turn(row.formatted) == (row.role or "", row.text or "")
    row = chat_format.digests(formatted).first()
    assert row.loss_sha256 == hashlib.sha256("a\\<s>é😀".encode()).hexdigest() and row.loss_chars == 7
    assert row.turns_sha256 == hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in said).encode()).hexdigest()
    assert chat_format.digests(formatted.limit(0)).count() == 0


def test_whole_text_is_unambiguous(spark):
    said = [("system", "s"), ("user", "u [/INST"), ("assistant", " a <"), ("user", "]"), ("assistant", "")]
    turns = spark.createDataFrame([(1, i, 0, r, t) for i, (r, t) in enumerate(said)], "conv_id long, turn long, part int, role string, text string")
    whole = "".join(r.formatted for r in chat_format.format_turns(turns).orderBy("turn").collect())
    parts = re.findall(r"<<SYS>>.*?<</SYS>>|<s>\[INST\].*?\[/INST\]|<s>\[ROLE\].*?</s>| .*?</s>", whole, re.DOTALL)
    assert "".join(parts) == whole and [chat_format.read_turn(p) for p in parts] == said


# ---- fingerprints

def plain_set(text):
    for end in fingerprints.FULL_ENDS:
        text = text.replace(end, end + "\n")
    whole = re.split(fingerprints.SENTENCES, text)
    return {q for p in whole for q in (re.split(fingerprints.RUNS, p) if len(p) > fingerprints.RUN else [p]) if q}


def likeness(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def test_fingerprints_equal_plain_sets(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = sorted((r.doc_id, r.text or "") for r in docs.collect())
    found = {r.doc_id: r for r in fingerprints.op9_fingerprints(spark, FOLDER).collect()}
    assert len(found) == len(texts)
    for (key, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        row = found[key]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert row.near_edited == pytest.approx(likeness(plain_set(text), plain_set(edited)))
        assert row.near_next == pytest.approx(likeness(plain_set(text), plain_set(after)))


def test_difference_recovers_the_digests(spark):
    left = "\n".join(f"line {i}" for i in range(400))
    right = left.replace("line 7\n", "").replace("line 300", "LINE 300")
    df = spark.createDataFrame([(1, left, right, 0), (2, left, "", 0), (3, None, "", 0), (4, right, right, 0)], "id long, l string, r string, near int").drop("near")
    found = {r.id: r for r in fingerprints.compare_rows(df, "l", "r").collect()}
    assert [(len(found[i].only_left), len(found[i].only_right), found[i].near) for i in (1, 2, 3, 4)] == [
        (2, 1, 398 / 401), (400, 0, 0.0), (0, 0, 1.0), (0, 0, 1.0)]


def test_fingerprints_of_odd_rows(make_docs):
    docs = make_docs(ODD)
    pairs = fingerprints.with_next(docs, blocks=3)
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    after = sorted((str(a[0]), a[1] or "", b[1] or "") for a, b in zip(order, order[1:] + order[:1]))
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in pairs.collect()) == after
    found = fingerprints.fingerprints(pairs).collect()
    assert len(found) == len(ODD) and len({r.fingerprint for r in found if r.doc_id in (5, 6)}) == 1
    assert fingerprints.fingerprints(fingerprints.with_next(docs.limit(0))).count() == 0
    one = fingerprints.fingerprints(fingerprints.with_next(docs.filter("doc_id = 9"))).first()
    assert one.near_next == 1.0


def test_one_line_texts_of_any_script_have_borders(spark):
    """Half-equal texts on one line share paragraphs: sentences before any letter, full stops without spaces, runs without an end."""
    words = lambda letters, n: [letters[i % 7] * (1 + i * 7 % 9) + letters[i * i % 11 % len(letters)] for i in range(n)]
    texts = [
        "The one. The two. We three. Zero four! So five? Then six.", "Это раз. Это два. Мы три. Он четыре. Да пять.", "一二三。四五六。七八九！十百千。万",
        " ".join(words("мнопрстуфхц", 200)), " ".join(words("ghijklmnopq", 200)),
    ]
    rows = [(i, t, t[:len(t) // 2] + " xx" * 3) for i, t in enumerate(texts)]
    for row in fingerprints.compare_rows(spark.createDataFrame(rows, "id long, l string, r string"), "l", "r").collect():
        assert row.near == pytest.approx(likeness(plain_set(row.l), plain_set(row.r))) and row.near > 0.1, row.id
        assert len(plain_set(row.l)) >= 5


def test_digests_that_met_in_all_cells_are_parted_by_other_bits(spark, monkeypatch):
    """Digests with the same lowest six bits in each segment share their cells in any sketch of up to 64 cells by those bits."""
    monkeypatch.setattr(fingerprints, "_direct", lambda tagged: F.array().cast(fingerprints.FOUND))
    step = sum(1 << 14 * s + 6 for s in range(fingerprints.SEGMENTS))
    found = fingerprints._bucket_difference(F.concat(fingerprints._tagged(F.col("l"), 1), fingerprints._tagged(F.col("r"), -1)))
    row = spark.createDataFrame([([5, 5 + step], [5 + 2 * step, 9])], "l array<long>, r array<long>").select(found.alias("f")).first()
    assert sorted((p.n, p.k) for p in row.f) == [(-1, 9), (-1, 5 + 2 * step), (1, 5), (1, 5 + step)]
