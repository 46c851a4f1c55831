"""Ordered pattern rules applied to text columns; the first matching rule wins."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.text import contains_or_any, equals_or_any
from basketry.session import stage_table

ANYTHING = "x"
#: Length of the pieces that route contains-tests to texts.
PIECE = 3
#: Pairs of texts and rules under one piece beyond which a second piece splits them.
CROWDED = 100_000


def all_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def pieces(text: Column, field: str) -> Column:
    """All pieces of up to PIECE characters of a text, marked with its field."""
    found = [_pieces_of(text, size) for size in range(1, PIECE + 1)]
    return F.transform(F.array_distinct(F.concat(*found)), lambda piece: F.struct(F.lit(field).alias("field"), piece.alias("piece")))


def _pieces_of(text: Column, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    cut = F.transform(starts, lambda i: F.substr(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, cut).otherwise(F.array().cast("array<string>"))


def pattern_pieces(pattern: Column, field: str) -> Column:
    """The pieces of full length of a pattern, or the whole of a shorter one. A text with the pattern has them all."""
    long = F.array_distinct(_pieces_of(pattern, PIECE))
    found = F.when(F.length(pattern) >= PIECE, long).otherwise(F.array(pattern))
    return F.transform(found, lambda piece: F.struct(F.lit(field).alias("field"), piece.alias("piece")))


def routed(rules: DataFrame, cut: DataFrame, patterns: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Rules with the two rarest pieces of their patterns among the texts (`__on`, `__second`), and if the first is crowded.

    A piece is crowded when its texts times its rules are more than CROWDED pairs. `__second` is null where a rule has one piece.
    """
    held = cut.select(F.explode("__pieces").alias("__piece")).groupBy("__piece").agg(F.count("*").alias("__texts"))
    nothing = F.array().cast("array<struct<field:string,piece:string>>")
    own = F.concat(*[F.when(sought, pattern_pieces(pattern, c)).otherwise(nothing) for c, (sought, pattern) in patterns.items()])
    names = rules.columns
    # At most as many pieces per rule as its own patterns have characters.
    listed = rules.withColumn("__piece", F.explode(own)).join(held, "__piece", "left").groupBy(*names).agg(
        F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("__texts", F.lit(0)).alias("texts"), F.col("__piece").alias("piece")))), 1, 2).alias("__rarest")
    ).withColumns({"__on": F.col("__rarest")[0]["piece"], "__held": F.col("__rarest")[0]["texts"], "__second": F.get("__rarest", F.lit(1))["piece"]})
    # A piece that no text has rules the rule out.
    possible = stage_table(listed.where("__held > 0").drop("__rarest"))
    crowds = possible.groupBy("__on").agg((F.max("__held") * F.count("*") > CROWDED).alias("__crowded"))
    return possible.join(crowds, "__on").drop("__held")


def by_rarest_pieces(cut: DataFrame, rules: DataFrame) -> list[DataFrame]:
    """Pairs of texts and rules that share the rule's rarest piece, and the second rarest where the first is crowded."""
    crowded, free = rules.where("__crowded"), rules.where("not __crowded")
    single = cut.withColumn("__on", F.explode("__pieces")).drop("__pieces")
    marks = crowded.select("__on").distinct()
    alone = F.struct(F.lit("").alias("field"), F.lit("").alias("piece"))
    both = cut.withColumn("__on", F.explode("__pieces")).join(marks, "__on").withColumn(
        "__second", F.explode(F.array_append("__pieces", alone))).drop("__pieces")
    split = crowded.withColumn("__second", F.coalesce("__second", alone))
    return [single.join(free, "__on"), both.join(split, ["__on", "__second"])]


def match_rules(
    df: DataFrame,
    rules: DataFrame,
    fields: dict[str, tuple[str, str]],
    take: list[str],
    *,
    number: str = "rule_no",
) -> DataFrame:
    """Add the `take` columns (and the number) of the first rule that accepts all fields.

    `fields` maps a data column to its (exact, like) rule columns. Comparison is in lower case, `x`
    accepts anything, an empty like accepts nothing, and a row with a null field matches no rule.

    The distinct field combinations are stored first, so that no test is pushed down to the rows they come
    from. Rules meet them by equality, whatever their number: on the exact fields a rule sets; without
    one, on the piece of its patterns that the fewest texts have, and on a second one where many texts and rules share
    the first; rules that accept everything are reduced to the first of them. All fields are tested after that.
    """
    columns = [c for pair in fields.values() for c in pair] + take
    entry = F.struct(F.col(number).alias("number"), *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])
    low = {c: F.lower(F.coalesce(F.col(c), F.lit(""))).alias(f"__{c}") for pair in fields.values() for c in pair}
    sheet = stage_table(rules.select(entry.alias("__rule"), *low.values()).where(
        all_of([F.col(f"__{like}") != "" for _, like in fields.values()])))
    complete = all_of([F.col(c).isNotNull() for c in fields])
    texts = stage_table(df.select(*fields).where(complete).distinct()).withColumns(
        {f"__text_{c}": F.lower(F.col(c)) for c in fields})
    accepts = all_of([
        test for c, (exact, like) in fields.items()
        for test in (equals_or_any(F.col(f"__text_{c}"), F.col(f"__{exact}")), contains_or_any(F.col(f"__text_{c}"), F.col(f"__{like}")))
    ])
    sets = {c: F.col(f"__{exact}") != ANYTHING for c, (exact, _) in fields.items()}
    seeks = {c: F.col(f"__{like}") != ANYTHING for c, (_, like) in fields.items()}
    none_set = all_of([~s for s in sets.values()])

    hits = []
    # One row per set of exact fields in use, of at most 2 ** len(fields) sets.
    used = {frozenset(c for c in fields if row[c]) for row in sheet.select(*[sets[c].alias(c) for c in fields]).distinct().collect()}
    for size in range(1, len(fields) + 1):
        for chosen in combinations(fields, size):
            if frozenset(chosen) not in used:
                continue
            own = sheet.where(all_of([sets[c] if c in chosen else ~sets[c] for c in fields]))
            same = all_of([F.col(f"__text_{c}") == F.col(f"__{fields[c][0]}") for c in chosen])
            hits.append(texts.join(own, same).where(accepts).select(*fields, "__rule"))
    patterns = {c: (seeks[c], F.col(f"__{like}")) for c, (_, like) in fields.items()}
    searching = sheet.where(none_set & reduce(lambda a, b: a | b, seeks.values()))
    cut = texts.withColumn("__pieces", F.concat(*[pieces(F.col(f"__text_{c}"), c) for c in fields]))
    hits += [] if frozenset() not in used else [
        pairs.where(accepts).select(*fields, "__rule") for pairs in by_rarest_pieces(cut, routed(searching, cut, patterns))
    ]
    hits = hits or [texts.withColumn("__rule", F.lit(None).cast(sheet.schema["__rule"].dataType)).select(*fields, "__rule").limit(0)]
    found = reduce(DataFrame.unionByName, hits).groupBy(*fields).agg(F.min("__rule").alias("__found"))

    catch_all = sheet.where(none_set & all_of([~s for s in seeks.values()])).agg(F.min("__rule").alias("rule")).scalar()
    hit = F.when(complete, F.least(F.col("__found"), catch_all))
    return (
        df.join(found, list(fields), "left").withColumn("__hit", hit)
        .withColumns({number: F.col("__hit.number"), **{c: F.col(f"__hit.{c}") for c in take}})
        .select(*df.columns, *[c for c in (number, *take) if c not in df.columns])
    )
