"""Token counts against the library: every kind of character, long words, special strings, odd rows."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import token_counts
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    file = token_counts.vocabulary()
    library = Tokenizer.from_str(file)
    return token_counts.counter(file), lambda text: len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abeth 's\n-=1ééΣİ日😀़̧<|>", max_size=80))
def test_equals_the_library(both, text):
    assert both[0](text) == both[1](text)


@pytest.mark.parametrize("text", [
    "", " \t\n", "x" * 5000, "ab" * 3000, "a<|endoftext|>b<|startoftext|><|ENDOFTEXT|>", "<|endoftext|>" * 3, "<|endoftext", "it's IT'S 'S ''s 'll",
    "ΑΣ ΟΔΟΣ. Σ", "İstanbul", "12345", "é ́ȩ", "한국어 ᄒ" + "ᅡᆫ", "՘ \U00010940 \U00016ea0", "a\x00b\x1cc\x85d e",
])
def test_hard_texts(both, text):
    assert both[0](text) == both[1](text)


def test_combining_marks_and_decompositions(both):
    letters = [c for c in map(chr, range(0x3000)) if unicodedata.category(c) not in ("Cs", "Co")]
    for c in letters:
        if unicodedata.combining(c) or unicodedata.decomposition(c):
            text = f"a{c}̧́{c}b {unicodedata.normalize('NFD', c)}b"
            assert both[0](text) == both[1](text), hex(ord(c))


def test_forgotten_words_are_counted_again(both, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_WORDS", 3)
    text = "one two three four five one two six seven one"
    assert both[0](text) == both[1](text)


def test_odd_rows_and_query(spark, both, make_docs, tmp_path):
    docs = make_docs([*ODD, (11, "a<|endoftext|>b")])
    rows = token_counts.count_tokens(docs, token_counts.vocabulary()).collect()
    want = sorted((str(k), len((t or "").encode()), both[1](t or "")) for k, t in [*ODD, (11, "a<|endoftext|>b")])
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert token_counts.count_tokens(docs.limit(0), token_counts.vocabulary()).count() == 0
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = token_counts.op11_token_counts(spark, str(tmp_path))
    assert dict(found.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    assert {r.doc_id for r in found.filter("over_limit").collect()} == {i for i, n, t in [(r.doc_id, r.n_bytes, r.n_tokens) for r in rows] if t > 2048}
