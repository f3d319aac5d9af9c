"""String predicates and small text helpers, all built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def shortest_words(words: Iterable[str]) -> list[str]:
    """The words without those that contain another one: finding "bit" finds "bitcoin"."""
    listed = list(dict.fromkeys(words))
    return [w for w in listed if not any(other != w and other in w for other in listed)]


def mentions(columns: Sequence[str | Column], words: Iterable[str]) -> Column:
    """True when any column contains any word, unanchored and case-sensitive.

    The same as matching an alternation of the literal words, but a byte search
    per word is several times faster than a backtracking matcher on long text,
    and one ``exists`` over the list keeps the generated code small. Both it and
    OR are three-valued, so a NULL column does not hide a hit in another one.
    """
    listed = F.array(*[F.lit(word) for word in shortest_words(words)])

    def hit(text: Column) -> Column:
        return F.exists(listed, lambda word: F.contains(text, word))

    hits = [hit(F.col(c) if isinstance(c, str) else c) for c in columns]
    return reduce(lambda left, right: left | right, hits)


def is_numeric_id(bundle: str | Column) -> Column:
    """ASCII digits only; ``\\z`` so that a trailing line break does not pass."""
    column = F.col(bundle) if isinstance(bundle, str) else bundle
    return column.rlike(r"^[0-9]+\z")


def platform(bundle: str | Column) -> Column:
    """IOS for numeric ids, ANDROID for all others, NULL for NULL."""
    numeric = is_numeric_id(bundle)
    return F.when(numeric, F.lit("IOS")).when(~numeric, F.lit("ANDROID"))


def capitalise(column: Column) -> Column:
    """First letter upper case, all the rest lower case."""
    rest = F.substr(column, F.lit(2))
    return F.concat(F.upper(F.substring(column, 1, 1)), F.lower(rest))
