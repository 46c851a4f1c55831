"""Components against all pairs."""

import random

from basketry.llm import near_dedup
from tests.llm.conftest import ODD


def brute_force(rows):
    known = near_dedup.Words()
    sets = [set(near_dedup.shingles(text, known).tolist()) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= 85 * (len(a) + len(sets[j]) - shared):
                x, y = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                parent[y] = x
    return {(rows[i][0], len(sets[i]), rows[find(i)][0]) for i in range(len(rows))}


def copies(seed=5):
    """Groups of copies with edits, chains of edits, texts that share a passage, short texts."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = draw.choices(words, k=60)
    rows = []
    for group in range(6):
        base = draw.choices(words, k=draw.choice([30, 120, 300]))
        rows += [list(base) for _ in range(3)]
        for _ in range(25):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 40))):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append(copy)
        for _ in range(10):  # a chain
            base = list(base)
            for _ in range(max(1, len(base) // 100)):
                base[draw.randrange(len(base))] = draw.choice(words)
            rows.append(base)
    rows += [draw.choices(words, k=20) + passage for _ in range(40)]
    rows += [[draw.choice("ab") for _ in range(draw.randint(1, 6))] for _ in range(60)]
    draw.shuffle(rows)
    return [(i * 3 - 200, " ".join(row)) for i, row in enumerate(rows)]


def test_equals_all_pairs(make_docs):
    rows = copies()
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(make_docs(rows)).collect()}
    assert found == brute_force(rows)


def test_odd_rows(make_docs):
    found = near_dedup.near_duplicates(make_docs(ODD)).collect()
    assert len(found) == len(ODD)
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].n_shingles for i in (1, 2, 3, 5, 7, 8)] == [0, 0, 0, 1, 1, 1]
    assert [by_id[i].component_id for i in (1, 2, 3, 5, 6)] == [1, 2, 3, 5, 5]
    assert not by_id[6].kept and by_id[1].kept and by_id[None].kept and by_id[None].component_id is None
    docs = make_docs(ODD)
    kept = near_dedup.without_duplicates(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 7, 8, 9, None]))
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_lower_case_is_ascii_only(make_docs):
    rows = [(1, "A B C D E F"), (2, "a b c d e f"), (3, "É b c d e f"), (4, "é b c d e f")]
    assert [r.component_id for r in near_dedup.near_duplicates(make_docs(rows)).orderBy("doc_id").collect()] == [1, 1, 3, 4]


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    roots = {r.node: r.root for r in near_dedup.components(links).collect()}
    assert roots == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
