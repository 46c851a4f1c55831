import datetime as dt
import math
import random
from decimal import Decimal

from conftest import rows
import pytest
from pyspark.sql import functions as F

from basketry.operators import allocation, grouping, intervals, joins, ranking, reshape, rules

DAY = dt.date(2015, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


# ---- lookups and joins

def test_lookup_defaults_only_for_absent_keys(frame):
    df = frame([(1, "a"), (2, "b"), (3, "zz"), (4, None)], "id int, k string")
    table = frame([("a", "yes"), ("b", None), ("a", "zebra")], "k string, v string")
    out = joins.lookup(df, table, "k", {"v": ("v", "error")})
    # first entry wins for the repeated key, a stored null stays null, absent and null keys get the default
    assert rows(out, "id", "v") == [(1, "yes"), (2, None), (3, "error"), (4, "error")]


def test_lookup_order_and_key_default(frame):
    df = frame([("a",), ("c",)], "k string")
    table = frame([("a", "late", 2), ("a", "early", 1)], "k string, v string, n int")
    out = joins.lookup(df, table, "k", {"v": ("v", joins.KEY)}, order=["n"])
    assert rows(out, "k", "v") == [("a", "early"), ("c", "c")]


def test_lookup_never_multiplies_rows(frame):
    random.seed(1)
    df = frame([(i, random.randint(0, 9)) for i in range(200)], "id int, k int")
    table = frame([(random.randint(0, 12), i) for i in range(50)], "k int, v int")
    assert joins.lookup(df, table, "k", {"v": ("v", -1)}).count() == 200


def test_left_many_equals_left_join(frame):
    left = frame([(1,), (2,), (3,), (None,)], "k int")
    right = frame([(1, i) for i in range(40)] + [(2, 7), (None, 8)], "k int, v int")
    assert rows(joins.left_many(left, right, "k")) == rows(left.join(right, "k", "left"))


@pytest.mark.parametrize("on", ["k", ["k", "d"]])
def test_left_many_splits_a_hot_key(frame, spark, on):
    random.seed(5)
    left = frame([(k, day(k % 3), f"l{k}") for k in range(40)] + [(None, day(0), "none"), (7, day(1), "again")], "k int, d date, a string")
    # Key 7 holds two thirds of the many side, some of it in equal rows; keys 30 to 39 and null have no partner.
    right = frame([(7 if i % 3 else i % 30, day((7 if i % 3 else i % 30) % 3), i // 2) for i in range(600)] + [(None, day(0), 1)], "k int, d date, v int")
    if on == "k":
        right = right.drop("d")
    hot = joins.hot_keys(right, on)
    assert len(hot) == 1 and str(7) in str(hot[0][0]) and hot[0][1] >= 2
    joined = joins.left_many(left, right, on)
    assert rows(joined) == rows(left.join(right, on, "left"))
    assert joined.where("v is null").count() >= 11
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan ExistingRDD[k") == 2, plan  # each side once
    dealt = right.withColumn("deal", F.pmod(F.xxhash64(*right.columns), F.lit(hot[0][1]))).where("k = 7").groupBy("deal").count()
    assert dealt.count() == hot[0][1]


def test_hot_keys_of_even_and_empty_tables(frame):
    assert joins.hot_keys(frame([(i,) for i in range(100)], "k int"), "k") == []
    assert joins.hot_keys(frame([], "k int"), "k") == []
    assert joins.hot_keys(frame([(None,)] * 9, "k int"), "k") == []


def test_star_lookup_equals_single_lookups(frame):
    random.seed(8)
    df = frame([(i, random.choice([None, 1, 2, 3, 99]), random.choice([None, 1, 5]), f"r{i}") for i in range(60)], "id long, a long, b long, text string")
    entries = frame([("x", 1, "one"), ("x", 2, None), ("x", 3, "three"), ("y", 1, "uno")], "kind string, id long, label string")
    got = joins.star_lookup(df, "id", entries, {"al": ("x", "a"), "bl": ("y", "b"), "ay": ("y", "a")}, "none")
    assert got.columns == ["id", "a", "b", "text", "al", "bl", "ay"]
    x, y = {1: "one", 2: None, 3: "three"}, {1: "uno"}
    assert [(r.al, r.bl, r.ay) for r in got.orderBy("id").collect()] == [
        (x.get(r.a, "none"), y.get(r.b, "none"), y.get(r.a, "none")) for r in df.orderBy("id").collect()]
    assert rows(got, *df.columns) == rows(df)
    assert joins.star_lookup(df.limit(0), "id", entries, {"al": ("x", "a")}).count() == 0


def test_star_lookup_sorts_nothing_before_the_rows_are_dealt_by_key(frame):
    df = frame([(i, i % 3, f"r{i}") for i in range(9)], "id long, a long, text string")
    entries = frame([("x", 1, "one")], "kind string, id long, label string")
    plan = joins.star_lookup(df, "id", entries, {"al": ("x", "a")})._jdf.queryExecution().sparkPlan().toString()
    lines = plan.splitlines()
    dealt = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(key#" in line)
    assert not any("Aggregate" in line for line in lines[dealt:]), plan


def test_semi_and_anti(frame):
    df, keys = frame([(1,), (2,), (None,)], "k int"), frame([(1,), (1,), (None,)], "k int")
    assert rows(joins.semi(df, keys, "k")) == [(1,)]
    assert rows(joins.anti(df, keys, "k")) == [(2,), (None,)]
    assert rows(joins.has_key(df, keys, "k", "found")) == [(1, 1), (2, 0), (None, 0)]


def test_stack_frames_fills_missing_columns(frame):
    out = reshape.stack_frames(frame([(1, 2)], "a int, b int"), frame([(3,)], "a int"))
    assert rows(out) == [(1, 2), (3, None)]


def test_unpivot_drops_nulls(frame):
    out = reshape.unpivot_columns(frame([(1, 5, None)], "id int, x int, y int"), ["id"], {"X": "x", "Y": "y"}, "n", "v")
    assert rows(out) == [(1, "X", 5)]


# ---- ordered picks

def test_first_by_takes_whole_rows(frame):
    df = frame([(1, 2, None), (1, 1, "b"), (1, 3, "c"), (2, 1, None)], "k int, o int, v string")
    assert rows(grouping.first_by(df, "k", ["o"], ["v"])) == [(1, "b"), (2, None)]
    assert rows(grouping.first_by(df, "k", ["o"], {"w": "v"}, latest=True)) == [(1, "c"), (2, None)]


def test_merge_latest(frame):
    stored = frame([(1, "a", 1), (2, "b", 5), (3, "c", 1)], "id int, v string, n int")
    new = frame([(1, "A", 2), (2, "B", 4), (3, "C", 1), (4, "D", 1)], "id int, v string, n int")
    assert rows(grouping.merge_latest(stored, new, ["id"], "n")) == [
        (1, "A", 2), (2, "b", 5), (3, "C", 1), (4, "D", 1)]


# ---- numbering

def test_running_counts_equal_a_plain_window(frame):
    random.seed(2)
    # One group holds more than a third of the rows, one day of it many.
    data = [
        (i, 0 if i % 2 else random.randint(0, 5), day(random.randint(0, 6)), random.random() < 0.4) for i in range(400)
    ]
    df = frame(data, "id int, g int, d date, paid boolean")
    got = ranking.running_counts(df, "g", "d", ["id"], {"n": F.lit(True), "p": F.col("paid")})
    expected = []
    for group in {r[1] for r in data}:
        n = p = 0
        for r in sorted((r for r in data if r[1] == group), key=lambda r: (r[2], r[0])):
            n, p = n + 1, p + r[3]
            expected.append((r[0], n, p if r[3] else None))
    assert rows(got, "id", "n", "p") == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_running_counts_of_one_group_and_day(frame, spark):
    """One group holds all rows but a few, one day of it a third of all: no range, and so no window, holds them together."""
    n = 900
    data = [(n - i, 5 if i % 30 else None if i % 60 else i, day(3) if i % 3 else day(i % 9), i % 4 == 0) for i in range(n)]
    data += [(2000, 5, None, True), (2001, None, None, False)]
    df = frame(data, "id int, g int, d date, paid boolean").repartition(3)
    got = ranking.running_counts(df, "g", "d", ["id"], {"n": F.lit(True), "p": F.col("paid")})
    assert got.columns == ["id", "g", "d", "paid", "n", "p"]
    expected = [(r[0], None, None) for r in data if r[1] is None or r[2] is None]
    for group in {r[1] for r in data if r[1] is not None}:
        k = p = 0
        for r in sorted((r for r in data if r[1] == group and r[2]), key=lambda r: (r[2], r[0])):
            k, p = k + 1, p + r[3]
            expected.append((r[0], k, p if r[3] else None))
    assert rows(got, "id", "n", "p") == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    windows = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    assert all("__part" in line for line in windows)
    parts = spark.read.parquet(got.inputFiles()[0].rsplit("/", 1)[0]).groupBy("__part").count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < n / 2
    assert ranking.running_counts(df.limit(0), "g", "d", ["id"], {"n": F.lit(True)}).count() == 0


def test_rank_bucket_is_not_ntile(frame):
    got = ranking.rank_buckets(frame([(i,) for i in range(7)], "v int"), {"b": [("v", False)]}, 5)
    assert [b for _, b in sorted(got.select("v", "b").collect())] == [1, 2, 3, 3, 4, 5, 5]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 11, 503])
def test_rank_bucket_over_many_rows_with_one_value(frame, n):
    df = frame([(i, 1 if i % 3 else i) for i in range(n)], "id int, v int")
    got = ranking.rank_buckets(df, {"b": [("v", True), ("id", False)]}, 5)
    order = sorted(((1 if i % 3 else i), i) for i in range(n))
    order.sort(key=lambda r: (-r[0], r[1]))
    expected = sorted((i, math.ceil((k + 1) * 5 / n)) for k, (_, i) in enumerate(order))
    assert sorted(tuple(r) for r in got.select("id", "b").collect()) == expected


@pytest.mark.parametrize("descending", [False, True])
def test_rank_bucket_of_wide_values_and_nulls(frame, descending):
    """Decimals over the whole range, dates, nulls and ties; without sorting or shuffling the rows."""
    random.seed(12)
    amounts = [Decimal(random.choice([1, -1]) * random.randint(0, 10**random.randint(0, 28))).scaleb(-4) for _ in range(120)]
    data = [(i, random.choice([None, *amounts]), random.choice([None, day(random.randint(-900, 900)), day(3)])) for i in range(700)]
    df = frame(data, "id long, v decimal(32,4), d date")
    got = ranking.rank_buckets(df, {"b": [("v", descending), ("d", not descending), ("id", False)]}, 7)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    sign = -1 if descending else 1

    def place(r):
        # Ascending puts nulls first, descending last, as ORDER BY does.
        return ((r[1] is None) == descending, sign * (r[1] or 0)), ((r[2] is None) != descending, -sign * (r[2] or day(0)).toordinal()), r[0]

    ordered = sorted(data, key=place)
    assert {r.id: r.b for r in got.collect()} == {r[0]: math.ceil((k + 1) * 7 / 700) for k, r in enumerate(ordered)}


def test_rank_of_an_empty_table(frame):
    df = frame([], "v int")
    assert ranking.rank_buckets(df, {"b": [("v", False)]}, 5).count() == 0


def test_rank_buckets_of_floats_in_two_orders(frame):
    random.seed(13)
    df = frame([(i, random.choice([None, 0.1, -2.5, 1e-300, random.uniform(-1e9, 1e9)])) for i in range(301)], "id int, v double")
    got = {r.id: (r.up, r.down) for r in ranking.rank_buckets(df, {"up": [("v", False), ("id", False)], "down": [("v", True), ("id", False)]}, 4).collect()}
    data = [(r.id, r.v) for r in df.collect()]
    up = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    down = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    place = {name: {r[0]: math.ceil((k + 1) * 4 / 301) for k, r in enumerate(rows_)} for name, rows_ in (("up", up), ("down", down))}
    assert got == {i: (place["up"][i], place["down"][i]) for i, _ in data}


def test_rank_rows_of_an_empty_table(frame):
    df = frame([], "v int")
    assert ranking.rank_rows(df, [F.col("v").asc()], "n").count() == 0


def test_rank_rows(frame):
    got = ranking.rank_rows(frame([(i * 7 % 50,) for i in range(50)], "v int"), [F.col("v").desc()], "n")
    assert all(r["n"] == 50 - r["v"] for r in got.collect())


# ---- intervals

def test_interval_match_equals_between(frame):
    random.seed(3)
    points = frame([(i, random.choice("ab"), day(random.randint(0, 90))) for i in range(300)], "id int, k string, d date")
    spans = []
    for i in range(30):
        start = random.randint(0, 80)
        spans.append((i, random.choice("ab"), day(start), day(start + random.randint(-2, 30))))
    spans += [(98, "a", None, day(5)), (99, "b", day(5), None)]
    intervals_df = frame(spans, "iv int, k string, s date, e date")
    got = intervals.interval_match(points, "d", intervals_df, "s", "e", on=["k"])
    expected = points.join(intervals_df, "k").where("d between s and e")
    assert rows(got, "id", "iv") == rows(expected, "id", "iv")


def test_interval_without_end_in_sight(frame):
    points = frame([(1, dt.date(1969, 12, 31)), (2, dt.date(2015, 1, 1)), (3, dt.date(9999, 12, 31))], "id int, d date")
    spans = frame([(1, dt.date(2015, 1, 1), dt.date(9999, 12, 31)), (2, dt.date(1, 1, 1), dt.date(1969, 12, 31))], "iv int, s date, e date")
    assert rows(intervals.interval_match(points, "d", spans, "s", "e"), "id", "iv") == [(1, 2), (2, 1), (3, 1)]
    assert intervals.interval_match(points, "d", spans.limit(0), "s", "e").count() == 0


def test_interval_days_include_both_ends(frame):
    out = intervals.interval_days(frame([(day(0), day(2)), (day(3), day(1))], "s date, e date"), "s", "e", "d")
    assert rows(out, "d") == [(day(0),), (day(1),), (day(2),)]


# ---- rules

RULE_SCHEMA = "rule_no int, es string, ls string, em string, lm string, level string"


def test_first_rule_wins_numerically_and_null_fields_match_nothing(frame):
    df = frame([("Google", "cpc"), ("google", "mail"), ("bing", None), ("other", "x")], "source string, medium string")
    sheet = frame([(10, "google", "x", "x", "x", "ten"), (9, "x", "goo", "CPC", "x", "nine"),
                   (20, "x", "x", "x", "x", "rest"), (1, None, "x", "x", "x", "empty")], RULE_SCHEMA)
    out = rules.match_rules(df, sheet, {"source": ("es", "ls"), "medium": ("em", "lm")}, ["level"])
    assert rows(out, "source", "medium", "level", "rule_no") == [
        ("Google", "cpc", "nine", 9), ("bing", None, None, None), ("google", "mail", "ten", 10),
        ("other", "x", "rest", 20)]


def test_rules_equal_a_scan_of_the_sheet(frame):
    """Random rules and texts against testing every rule on every text; any number of rules is allowed."""
    random.seed(6)
    word = lambda: random.choice(["goo", "Google", "cpc", "x", "x", "x", "mail", "e", "", "facebook", None])
    sheet = [(i, word(), random.choice(["x", "x", word()]), word(), random.choice(["x", "x", word()]), f"l{i}") for i in random.sample(range(900), 300)]
    texts = [(random.choice(["google", "GOOGLE ads", "facebook", "mail", "", "e", None]), random.choice(["cpc", "email", "", "x", None])) for _ in range(60)]
    fields = {"source": ("es", "ls"), "medium": ("em", "lm")}
    low = lambda v: (v or "").lower()

    def plain(text):
        for rule in sorted(sheet):
            tests = [(low(e) in ("x", low(t))) and (low(k) == "x" or low(k) != "" and low(k) in low(t))
                     for t, e, k in zip(text, rule[1:4:2], rule[2:5:2])]
            if None not in text and all(tests):
                return (*text, rule[0], rule[5])
        return (*text, None, None)

    df = frame(texts, "source string, medium string")
    got = rules.match_rules(df, frame(sheet, RULE_SCHEMA), fields, ["level"])
    assert rows(got, "source", "medium", "rule_no", "level") == sorted(map(plain, texts), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_twenty_five_thousand_rules(frame):
    sheet = frame([(i, f"s{i}", "x", "x", "x", f"l{i}") for i in range(25_000)] + [(30_000, "x", "x", "x", "x", "rest")], RULE_SCHEMA)
    df = frame([("s24999", "m"), ("t", "m")], "source string, medium string")
    got = rules.match_rules(df, sheet, {"source": ("es", "ls"), "medium": ("em", "lm")}, ["level"])
    assert rows(got, "source", "level") == [("s24999", "l24999"), ("t", "rest")]
    above = got.where("level is not null").groupBy("level").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in above and "Join Cross" not in above


def test_rules_with_a_common_prefix_make_few_pairs(frame, spark, tmp_path):
    """25,000 patterns that start alike, against texts that all start so: the rarest piece decides who meets whom."""
    sheet = [(i, "x", f"www.shop{i:05d}", "x", "x", f"l{i}") for i in range(25_000)]
    texts = [(f"www.shop{i * 61:05d}.example", "m") for i in range(400)] + [("www.shopping", "m")]
    fields = {"source": ("es", "ls"), "medium": ("em", "lm")}
    got = rules.match_rules(frame(texts, "source string, medium string"), frame(sheet, RULE_SCHEMA), fields, ["level"])
    assert rows(got, "source", "rule_no") == sorted([(t, i * 61) for i, (t, _) in enumerate(texts[:400])] + [("www.shopping", None)])
    cut = frame([(t, "m", t, "m") for t, _ in texts], "source string, medium string, __text_source string, __text_medium string").withColumn(
        "__pieces", rules.pieces(F.col("__text_source"), "source"))
    sheet_of = frame([(i, p) for i, _, p, *_ in sheet], "n int, __ls string")
    routed = rules.routed(sheet_of, cut, {"source": (F.lit(True), F.col("__ls"))})
    pairs = sum(p.count() for p in rules.by_rarest_pieces(cut, routed))
    assert pairs < len(sheet) * len(texts) / 200


@pytest.mark.parametrize("crowded", [0, 5, 10**9])
def test_a_second_piece_splits_a_crowd(frame, monkeypatch, crowded):
    monkeypatch.setattr(rules, "CROWDED", crowded)
    random.seed(15)
    word = lambda n: "".join(random.choice("abc") for _ in range(random.randint(1, n)))
    sheet = [(i, "x", word(6), "x", random.choice(["x", word(4)]), f"l{i}") for i in range(200)]
    texts = sorted({(word(12), word(6)) for _ in range(80)})
    got = rules.match_rules(frame(texts, "source string, medium string"), frame(sheet, RULE_SCHEMA), {"source": ("es", "ls"), "medium": ("em", "lm")}, ["level"])

    def plain(source, medium):
        return next(((source, medium, i) for i, _, a, _, b, _ in sheet if a in source and (b == "x" or b in medium)), (source, medium, None))

    assert rows(got, "source", "medium", "rule_no") == sorted((plain(*t) for t in texts), key=lambda r: tuple((v is None, str(v)) for v in r))


# ---- allocation

def test_shares_sum_to_the_month(frame):
    random.seed(4)
    df = frame([(i, random.choice("abc"), float(random.randint(0, 50))) for i in range(100)], "id int, month string, v double")
    shared = allocation.with_month_totals(df, ["month"], {"t": F.sum("v")}).withColumn(
        "share", allocation.share_of_total("v", "t"))
    for row in shared.groupBy("month").agg(F.sum("share").alias("s")).collect():
        assert abs(row["s"] - 1) < 1e-9
