import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns that the operators use inside for other things."""

    def made(rows):
        full = [(*row, *("en", "s0")[len(row) - 2:], len(row[1] or "")) for row in rows]
        names = "score string, rep string, block string, spans string, root string, word string, row string, bucket string, k_id string, m_copies string"
        return spark.createDataFrame([(*row, *["x"] * 10) for row in full], f"{SCHEMA}, {names}")

    return made


#: Null, empty, blank, no letters, ties, a repeated row, a very long text, odd characters.
ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b "), (4, "12 34 -- !!"), (5, "the same text here again"), (5, "the same text here again"),
    (6, "the same text here again"), (7, "word " * 30_000), (8, "x" * 60_000), (9, "Ünïcode ßtraße 日本語 😀 é \x00 end"), (None, "no id here"),
]
