"""Targets against a plain water filling, and what rounding may and may not change."""

import random

import pytest

from basketry.llm import mixing
from tests.llm.conftest import ODD


def plain_targets(sizes):
    """sizes: by source in order."""
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sizes)}
    left, open_, targets = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        rate = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if rate * weights[s] > 2 * sizes[s]}
        if not over:
            targets |= {s: rate * weights[s] for s in open_}
            break
        targets |= {s: 2 * sizes[s] for s in over}
        left -= sum(targets[s] for s in over)
        open_ -= over
    return targets


def documents(n=600, seed=1):
    draw = random.Random(seed)
    sources = ["a"] * 6 + ["B", "é", "z", None]
    return [(i, "w " * draw.randint(1, 60), "en", draw.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("block, fan", [(8192, 1024), (16, 2)])
def test_targets_and_rounding(make_docs, block, fan):
    rows = documents()
    found = mixing.mix(make_docs(rows), block=block, fan=fan).collect()
    sizes, source = {}, {row[0]: row[3] for row in rows}
    for row in sorted(rows, key=lambda r: (r[3] is None, r[3] or "")):
        sizes[row[3]] = sizes.get(row[3], 0) + len(row[1].split())
    targets = plain_targets(sizes)
    assert len(found) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for row in found:
        own = source[row.doc_id]
        assert row.source_size == sizes[own] and row.target == pytest.approx(targets[own])
        share = targets[own] / sizes[own]
        assert row.copies in (int(share), int(share + 1 - 1e-9)) and row.taken == row.copies * row.size <= 2 * row.size
        taken[own] += row.taken
    assert all(abs(taken[s] - targets[s]) <= 30.5 for s in sizes)  # half of the longest document


def test_reruns_agree_whatever_the_partitions(make_docs):
    docs = make_docs(documents())
    first = sorted(mixing.mix(docs).collect())
    assert first == sorted(mixing.mix(docs.repartition(7, "text")).collect())


def test_expected_copies(make_docs):
    """Over many seeds the mean of the copies of a document is its share."""
    docs = make_docs([(i, "w " * (1 + i % 5), "en", "ab"[i % 2]) for i in range(24)])
    runs = [mixing.mix(docs, seed=s) for s in range(12)]
    copies = [r.copies / (r.target / r.source_size) for run in runs for r in run.collect() if r.target < 2 * r.source_size]
    assert sum(copies) / len(copies) == pytest.approx(1, abs=0.08)


def test_odd_rows(make_docs):
    docs = make_docs(ODD)
    found = mixing.mix(docs).collect()
    assert len(found) == len(ODD) and all(r.taken == 0 for r in found if r.doc_id in (1, 2, 3))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0
