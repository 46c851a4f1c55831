"""Text: slugs, character filters, wildcard tests, recoding by an inline table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def keep_chars(text: Column | str, char_class: str) -> Column:
    """Remove every character that is not in the regular-expression class."""
    return F.regexp_replace(as_column(text), f"[^{char_class}]", "")


def slug(text: Column | str) -> Column:
    """Lower case, letters a-z and digits only."""
    return keep_chars(F.lower(as_column(text)), "a-z0-9")


def wildcard_any(text: Column | str, *patterns: str) -> Column:
    """True when any `*`/`?` pattern matches, ignoring case. Null text matches nothing."""
    lowered = F.lower(as_column(text))

    def one(pattern: str) -> Column:
        escaped = pattern.lower().replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
        return lowered.like(escaped.replace("*", "%").replace("?", "_"))

    return F.coalesce(reduce(lambda a, b: a | b, [one(p) for p in patterns]), F.lit(False))


def recode(value: Column | str, table: dict, default: object = None) -> Column:
    """Lookup in a small inline table; `default` only when the value is not in the table."""
    column = as_column(value)
    chain = None
    for key, label in table.items():
        chain = F.when(column == F.lit(key), F.lit(label)) if chain is None else chain.when(
            column == F.lit(key), F.lit(label)
        )
    return chain.otherwise(F.lit(default))


def differs(value: Column | str, constant: object) -> Column:
    """`<>` that is true for null."""
    return ~as_column(value).eqNullSafe(F.lit(constant))


def blank(text: Column | str) -> Column:
    """Null, empty or spaces only."""
    return F.coalesce(F.trim(as_column(text)), F.lit("")) == ""


def contains_or_any(text: Column, pattern: Column, anything: str = "x") -> Column:
    """Contains-test of a rule; `x` accepts anything and an empty pattern accepts nothing."""
    return (pattern == anything) | ((pattern != "") & text.contains(pattern))


def equals_or_any(text: Column, wanted: Column, anything: str = "x") -> Column:
    return (wanted == anything) | (text == wanted)


def cut_size_suffix(name: Column | str) -> Column:
    """Remove a trailing ` - X` or ` - XX` (X is any character) from a product name."""
    trimmed = F.trim(as_column(name))
    one, two = F.substr(F.right(trimmed, F.lit(4)), F.lit(1), F.lit(3)), F.substr(
        F.right(trimmed, F.lit(5)), F.lit(1), F.lit(3)
    )
    return F.trim(
        F.when(one == " - ", F.left(trimmed, F.length(trimmed) - 4))
        .when(two == " - ", F.left(trimmed, F.length(trimmed) - 5))
        .otherwise(as_column(name))
    )
