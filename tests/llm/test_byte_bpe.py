"""Encoding against the reference library, decoding, and odd rows."""

import hashlib

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import byte_bpe
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def machine():
    import regex

    ranks, pattern = byte_bpe.vocabulary()
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return known, regex.compile(pattern).findall, byte_bpe.Pieces(byte_bpe.Transducer(ranks, max_states=50)), byte_bpe.Utf8Machine({r: t for t, r in ranks.items()})


def encoded(machine, text):
    return [token for piece in machine[1](text) for token in machine[2][piece]]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abeth 's\n-=1é日😀", max_size=80))
def test_equals_the_library_and_decodes(machine, text):
    ids = encoded(machine, text)
    assert ids == machine[0].encode_ordinary(text)
    assert machine[3].decode(ids) == text


@pytest.mark.parametrize("text", ["ab" * 3000, "-=" * 2000 + "-", "aaaa" * 2000, " " * 3000 + "x", "ing" * 1500])
def test_long_pieces(machine, text):
    assert encoded(machine, text) == machine[0].encode_ordinary(text)


@given(st.binary(max_size=30))
def test_invalid_bytes_become_replacement_characters(data):
    text, pending = byte_bpe.Utf8Machine.feed(b"", data)
    assert text + ("�" if pending else "") == data.decode(errors="replace")


def test_odd_rows(machine, make_docs):
    ranks, pattern = byte_bpe.vocabulary()
    docs = make_docs(ODD)
    rows = byte_bpe.decode(byte_bpe.encode(docs, ranks, pattern), ranks).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == sorted((str(k), t or "") for k, t in ODD)
    assert all(r.ids == machine[0].encode_ordinary(r.text) for r in rows)
    assert byte_bpe.encode(docs.limit(0), ranks, pattern).count() == 0
    both = byte_bpe.round_trip(docs, ranks, pattern)
    assert sorted((str(r.doc_id), r.ids, r.text) for r in both.collect()) == sorted((str(r.doc_id), r.ids, r.text) for r in rows)
    assert byte_bpe.round_trip(docs.limit(0), ranks, pattern).count() == 0


def test_pieces_that_end_within_a_character(spark):
    """A pattern over bytes in disguise would cut characters; ids are then read as a whole, and broken ends replaced."""
    ranks = {bytes((b,)): b for b in range(256)}
    machine = byte_bpe.Utf8Machine({r: t for t, r in ranks.items()})
    assert machine.read([0xC3]) == ("", b"\xc3") and machine.read([0xC3, 0xA9]) == ("é", b"")
    assert machine.decode([0x61, 0xC3]) == "a�"
    packed = byte_bpe.PackedPieces(byte_bpe.Transducer(ranks))
    decoded = byte_bpe.DecodedPieces(packed, machine)
    assert decoded["é"] == "é"
    packed["cut"] = byte_bpe.np.array([0xC3], byte_bpe.np.int32).tobytes()
    assert decoded["cut"] is None


def test_query(spark, machine, make_docs, tmp_path):
    make_docs(ODD).write.parquet(str(tmp_path / "documents.parquet"))
    for row in byte_bpe.op7_byte_bpe(spark, str(tmp_path)).filter("doc_id <> 5").collect():
        text = dict(ODD)[row.doc_id] or ""
        ids = machine[0].encode_ordinary(text)
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
