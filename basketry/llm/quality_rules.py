"""Quality rules whose cutoffs are certified on labelled rows: few good documents are rejected, with a guarantee.

Each rule scores a document in thousandths; more is worse. A cutoff of a rule in a stratum (a language) is certified if the exact
binomial bound says so: if good documents were rejected at a rate above ALPHA / rules, then as few rejections among
the labelled good ones as were seen would have a chance of at most DELTA / (strata * rules). The share of ALPHA makes
the union of the rules keep to ALPHA per stratum; the share of DELTA corrects for all strata and rules. Within
one of them the cutoffs are tested from the loosest on, in fixed order, which needs no further correction (the chance only grows).
Among the certified cutoffs the one is taken that rejects the most labelled bad documents in excess of good ones; without such a
cutoff the rule is off in that stratum. Nothing is fitted on the labelled rows before, so all of them are holdout.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import WORD, bind, stage_table, table

ALPHA = 0.02
DELTA = 0.05
CUTOFFS = (0, 10, 20, 50, 100, 150, 200, 300, 400, 500, 600, 700, 800, 900)
RULES = ("symbols", "dup_lines", "capitals")
LEAST_WORDS = 50


def _repeat_words(words: Column) -> Column:
    """Words inside a window of three words that occurs more than once: windows are sorted, equal neighbours marked."""
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    windows = F.sort_array(F.transform(starts, lambda i: F.struct(
        F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i"))))
    covered = bind(windows, lambda sorted_: F.transform(
        F.filter(sorted_, lambda x, j: F.coalesce(x["w"] == F.get(sorted_, j - 1)["w"], F.lit(False))
                 | F.coalesce(x["w"] == F.get(sorted_, j + 1)["w"], F.lit(False))),
        lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return F.when(F.size(words) >= 3, F.size(F.array_distinct(F.flatten(covered)))).otherwise(0)


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, rule scores) per row, all long.

    Null texts count as empty. One pass over whole texts with built-in functions, no shuffle.
    """
    text = F.coalesce("text", F.lit(""))
    by_words = bind(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda words: F.struct(
        F.size(words).alias("n_words"), F.length(F.array_join(words, "")).alias("word_chars"),
        _repeat_words(words).alias("n_repeat_words"),
    ))
    by_lines = bind(F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)), lambda lines: F.struct(
        F.size(lines).alias("lines"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
    ))
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), by_words.alias("w"), by_lines.alias("l"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("upper"), F.regexp_count(text, F.lit("[a-z]")).alias("lower"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.call_function("div", part.cast("long") * 1000, F.greatest(whole, F.lit(1)).cast("long"))

    return counted.select(
        "doc_id", "lang",
        *[F.col(c).cast("long").alias(c.split(".")[-1]) for c in ("w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words")],
        share(F.col("n_symbols"), F.col("w.n_words")).alias("symbols"), share(F.col("l.n_dup_lines"), F.col("l.lines")).alias("dup_lines"),
        share(F.col("upper"), F.col("upper") + F.col("lower")).alias("capitals"),
    ).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))


def tail_at_most(rows: Column, hits: Column, rate: float) -> Column:
    """The chance of at most `hits` out of `rows` at `rate`, summed in logarithms. Above the mean it is taken as 1."""
    odds = F.lit(rate / (1 - rate))

    def step(state: Column, i: Column) -> Column:
        term = state["term"] + F.log(F.greatest((rows - i + 1).cast("double"), F.lit(1e-300)) / i * odds)
        high, low = F.greatest(term, state["total"]), F.least(term, state["total"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    first = rows * F.log1p(F.lit(-rate))
    summed = F.aggregate(
        F.when(hits >= 1, F.sequence(F.lit(1).cast("long"), hits)).otherwise(F.array().cast("array<bigint>")),
        F.struct(first.alias("term"), first.alias("total")), step, lambda state: F.exp(state["total"]))
    return F.when(hits > rows * rate, F.lit(1.0)).otherwise(summed)


def certified_cutoffs(scored: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum (`lang`) with a cutoff per rule, null where the rule is off.

    `labels` has doc_id and quality; several labels of a document count as bad if one does. Unlabelled rows and rows that
    fail the base rules take no part. Grouped sums only: a hot language is combined before it is shuffled.
    """
    marked = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = scored.filter(~F.col("base_failed")).join(marked, "doc_id").select("lang", *RULES, (F.col("quality") == 1).alias("good"))
    tests = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(cut).cast("long").alias("cutoff"), (F.col(rule) > cut).alias("over"))
        for rule in RULES for cut in CUTOFFS]))
    one = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    counts = stage_table(held.select("lang", "good", tests.alias("t")).groupBy("lang", "t.rule", "t.cutoff").agg(
        one(F.col("good")).alias("good_rows"), one(F.col("good") & F.col("t.over")).alias("good_over"),
        one(~F.col("good") & F.col("t.over")).alias("bad_over")))
    strata = counts.select("lang").distinct().count()
    level = delta / max(1, strata * len(RULES))
    safe = counts.filter(
        (F.col("bad_over") > F.col("good_over"))
        & (tail_at_most(F.col("good_rows"), F.col("good_over"), alpha / len(RULES)) <= level))
    best = F.max_by("cutoff", F.struct(F.col("bad_over") - F.col("good_over"), F.col("cutoff")))
    chosen = safe.groupBy("lang", "rule").agg(best.alias("cutoff"))
    return chosen.groupBy("lang").agg(*[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in RULES])


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Features, `base_failed` and `kept` per row. Empty tables give an empty result; a null language is a stratum of its own.

    The cutoffs are stored first, so that Spark knows their size and may broadcast them; beyond its threshold the join is
    split at hot languages.
    """
    scored = stage_table(features(docs))
    cutoffs = stage_table(certified_cutoffs(scored, labels)).withColumnRenamed("lang", "stratum")
    over = reduce(or_, [F.coalesce(F.col(rule) > F.col(f"cut_{rule}"), F.lit(False)) for rule in RULES])
    joined = scored.join(cutoffs, F.col("lang").eqNullSafe(F.col("stratum")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~over)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _rule_rows() -> str:
    return " union all ".join(f"select lang, good, '{rule}' as rule, {rule} as score from held" for rule in RULES)


OP1_SQL = rf"""
with texts as (select doc_id, lang, coalesce(text, '') as t from documents),
listed as (select doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from texts),
placed as (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as p from listed),
word_counts as (select doc_id, count(*) as n_words, sum(length(w)) as word_chars from placed group by doc_id),
windows as (
    select doc_id, p, w || ' ' || lead(w, 1) over o || ' ' || lead(w, 2) over o as win from placed
    window o as (partition by doc_id order by p)),
repeated as (select doc_id, p from windows where win is not null qualify count(*) over (partition by doc_id, win) > 1),
covered as (select doc_id, count(distinct q) as n from (select doc_id, unnest([p, p + 1, p + 2]) as q from repeated) group by doc_id),
lines as (
    select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup
    from (select doc_id, unnest(string_split(t, chr(10))) as line from texts)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
letters as (
    select doc_id, lang, len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols,
        len(regexp_extract_all(t, '[A-Z]')) as up, len(regexp_extract_all(t, '[a-z]')) as low from texts),
counted as (
    select doc_id, lang, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
        n_symbols::bigint as n_symbols, coalesce(n_dup, 0)::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words,
        coalesce(n_lines, 0) as n_lines, up, low
    from letters left join word_counts using (doc_id) left join covered using (doc_id) left join lines using (doc_id)),
scored as (
    select *, n_symbols * 1000 // greatest(n_words, 1) as symbols, n_dup_lines * 1000 // greatest(n_lines, 1) as dup_lines,
        up * 1000 // greatest(up + low, 1) as capitals,
        n_words < {LEAST_WORDS} or n_repeat_words * 100 > n_words * 50 as base_failed
    from counted),
held as (
    select lang, symbols, dup_lines, capitals, q = 1 as good from scored
    join (select doc_id, min(quality) as q from labels where quality is not null group by doc_id) using (doc_id) where not base_failed),
tests as (
    select lang, rule, cutoff, count(*) filter (where good) as n, count(*) filter (where good and score > cutoff) as k,
        count(*) filter (where not good and score > cutoff) as b
    from ({_rule_rows()}), (select unnest({list(CUTOFFS)}) as cutoff) group by all),
safe as (
    select * from tests where b > k and k <= n * {ALPHA / len(RULES)}
        and list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
            + i * ln({ALPHA / len(RULES)}) + (n - i) * ln(1 - {ALPHA / len(RULES)}))))
        <= {DELTA} / (select count(*) * {len(RULES)} from (select distinct coalesce(lang, ''), lang is null from held))),
chosen as (select lang, rule, arg_max(cutoff, struct_pack(a := b - k, c := cutoff)) as cutoff from safe group by lang, rule),
cuts as (
    select lang as stratum, {', '.join(f"max(cutoff) filter (where rule = '{rule}') as cut_{rule}" for rule in RULES)} from chosen group by lang)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and not ({' or '.join(f'coalesce({rule} > cut_{rule}, false)' for rule in RULES)}) as kept
from scored left join cuts on lang is not distinct from stratum
"""
