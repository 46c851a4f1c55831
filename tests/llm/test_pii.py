"""Base formats against plain patterns, the bootstrap on planted contexts, redaction."""

import random
import re

from basketry.llm import pii
from tests.llm.conftest import ODD


def plain(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [(m.start(), 1, m.end())] if all(int(x) <= 255 for x in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        doubled = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        out += [(m.start(), 2, m.end())] if 12 <= len(digits) <= 19 and doubled % 10 == 0 else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [(m.start(), 3, m.end())] if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15 else []
    return sorted(out)


def test_base_formats():
    draw = random.Random(3)
    for _ in range(20_000):
        text = "".join(draw.choice("ab@@..-+0123456789 ()1é%") for _ in range(draw.randint(0, 40)))
        assert [(s, pii.KINDS.index(k), e) for k, s, e in pii.base_spans(text)] == plain(text), text
    assert pii.base_spans("1" * 50_000 + " " + "a" * 50_000) == []


def test_confident_patterns_find_unseen_identifiers(make_docs):
    rows = [(i, f"so please write to user{i}@mail.example.com for help number {i} of many") for i in range(8)]
    rows += [(20, "so please write to user77(at)mail.example for help"), (21, "we counted 1234 sheep and user77(at)mail.example too")]
    rows += [(30 + i, f"he wrote about {1000 + i} words of text") for i in range(8)]
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(make_docs(rows)).collect()}
    # An accepted identifier is personal data wherever it stands; a number that only looks like one is not.
    assert found[20] == [("email", 19, 41)] and found[21] == [("email", 26, 48)]
    assert all(found[i] == [("email", 19, 19 + len(f"user{i}@mail.example.com"))] for i in range(8))
    assert all(found[30 + i] == [] for i in range(8))


def test_odd_rows_and_redaction(make_docs):
    rows = [*ODD, (11, "a@b.co and 10.0.0.1, +1 (555) 555-1234; 4111 1111 1111 1111"), (11, "no more"), (12, "é😀 x@y.de")]
    docs = make_docs(rows)
    found = pii.find(docs).collect()
    assert len(found) == len(rows) and all(r.spans == r.base for r in found)
    clean = pii.redact(docs)
    texts = [(r.doc_id, r.text, r.n_chars) for r in clean.collect()]
    assert clean.columns == docs.columns and len(texts) == len(rows)
    assert (11, "[EMAIL] and [IP], [PHONE]; [CARD]", 33) in texts and (11, "no more", 7) in texts and (12, "é😀 [EMAIL]", 10) in texts
    assert pii.find(docs.limit(0)).count() == 0 and pii.redact(docs.limit(0)).count() == 0


def test_discovered_identifiers_raise_further_patterns(make_docs):
    """Seeds -> write to _ -> new identifiers -> old mailbox _ -> further ones -> contact address _ -> the last one."""
    rows = [(i, f"so please write to user{i}@mail.example.com for help") for i in range(8)]
    rows += [(20 + i, f"so please write to n{'abcdef'[i]}1(at)mail.example for help") for i in range(6)]
    rows += [(30 + i, f"the old mailbox n{'abcdef'[i]}1(at)mail.example was closed") for i in range(6)]
    rows += [(40 + i, f"the old mailbox z{'abcd'[i]}2(at)other.example was closed") for i in range(4)]
    rows += [(50 + i, f"her contact address z{'abcd'[i]}2(at)other.example stands here") for i in range(4)]
    rows += [(60, "her contact address last3(at)third.example stands here"), (61, "we ate last4(at)third.example today")]
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(make_docs(rows)).collect()}
    for key, text in rows:
        words = [w for w in text.split() if "(at)" in w or "@" in w]
        start = text.index(words[0])
        assert found[key] == ([] if key == 61 else [("email", start, start + len(words[0]))]), (key, text)


def test_words_are_read_to_their_border():
    long = "y" * 5000
    assert pii.words_around(f"one two {long} a@b.co {long}z end", 5009, 5015) == (["two", long], [long + "z"])
    ends = [pii.patterns(f"mail {long}{tail} a@b.co {long}{tail} end", 5005 + len(tail) + 1, 5005 + len(tail) + 7) for tail in ("", "p", "q")]
    assert len({e for pair in ends for e in pair}) == 6 and all(len(e) < 80 for pair in ends for e in pair)
    assert pii.words_around("a@b.co", 0, 6) == ([], []) and pii.words_around(" \n a@b.co\t", 3, 9) == ([], [])


def plain_bootstrap(texts):
    """The same graph in dictionaries: (instance -> kind) of the accepted unseen instances."""
    edges = set()
    for text in texts:
        for _, _, seed, instance, *both in pii.occurrences(text, pii.base_spans(text)):
            edges |= {(seed, instance, p) for p in both if p}
    scores, held, done = {}, set(), 0
    while True:
        kind_of = {}
        for instance, by in scores.items():
            best = max(by.values())
            if best >= pii.ACCEPTED:
                kind_of[instance] = next(k for k in pii.KINDS if by[k] == best)
        confidence = {}
        for pattern in {p for *_, p in edges}:
            own = [(seed, instance) for seed, instance, p in edges if p == pattern]
            by = {}
            for k in pii.KINDS:
                support = sum(seed == k or seed is None and kind_of.get(instance) == k for seed, instance in own)
                weight = sum(1.0 if seed == k else scores.get(instance, {}).get(k, 0.0) if seed is None else 0.0 for seed, instance in own)
                by[k] = weight / (len(own) + 1) if support >= pii.SUPPORT else 0.0
            if max(by.values()) > 0:
                confidence[pattern] = by
        scores = {}
        for seed, instance, p in edges:
            if seed is None and p in confidence:
                by = scores.setdefault(instance, dict.fromkeys(pii.KINDS, 1.0))
                for k in pii.KINDS:
                    by[k] *= 1 - confidence[p][k]
        scores = {i: {k: 1 - v for k, v in by.items()} for i, by in scores.items()}
        first = lambda by: next(k for k in pii.KINDS if by[k] == max(by.values()))
        accepted = {("p", p, first(by)) for p, by in confidence.items() if max(by.values()) >= pii.CONFIDENT}
        accepted |= {("i", i, first(by)) for i, by in scores.items() if max(by.values()) >= pii.ACCEPTED}
        done += 1
        if done >= pii.ROUNDS and accepted <= held:
            return {i: first(by) for i, by in scores.items() if max(by.values()) >= pii.ACCEPTED}
        held |= accepted


def test_bootstrap_equals_a_plain_one(make_docs):
    draw = random.Random(17)
    people = ["".join(draw.choice("abcde") for _ in range(3)) for _ in range(14)]
    frames = ["please write to {} for help", "my number is {} at work", "old mailbox {} was closed", "server {} went down", "we ate {} today"]
    values = [*[f"{p}@mail.example" for p in people], *[f"{p}1(at)mail.example" for p in people], *[f"10.0.{i}.7" for i in range(9)], "+1 (555) 555-1234", "+44 20 7946 0958", *[f"x{i}y" for i in range(9)]]
    rows = []
    for i in range(160):
        frame = draw.choice(frames)
        some = values if draw.random() < 0.2 else values[:28] if "write" in frame or "mailbox" in frame else values[28:]
        rows.append((i, frame.format(draw.choice(some))))
    accepted = plain_bootstrap([t for _, t in rows])
    assert accepted
    for row in pii.find(make_docs(rows)).collect():
        text = dict(rows)[row.doc_id]
        base = pii.base_spans(text)
        extra = [(accepted[i], s, e) for s, e, seed, i, *_ in pii.occurrences(text, base) if seed is None and i in accepted]
        assert [tuple(s) for s in row.spans] == sorted([*base, *extra], key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))
