"""Persona name, rank and app category as SQL expressions built from tables of values.

SQL text rather than Column objects, because a permanent view can only be
created from text; ``pyspark.sql.functions.expr`` serves the DataFrame side.
"""

from __future__ import annotations

from collections.abc import Iterable

from bundlescope import fixed_values as fixed


def literal(value: object) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, str):
        if "'" in value or "\\" in value:
            raise ValueError(f"no quotes or backslashes in mapped values: {value!r}")
        return f"'{value}'"
    return str(value)


def _in(column: str, values: Iterable[str]) -> str:
    return f"{column} IN ({', '.join(literal(v) for v in values)})"


def _case(branches: Iterable[tuple[str, str]], otherwise: str | None = None) -> str:
    whens = " ".join(f"WHEN {test} THEN {result}" for test, result in branches)
    return f"CASE {whens}{f' ELSE {otherwise}' if otherwise else ''} END"


def persona_name(column: str = "segment_grp_1", primary: bool = True) -> str:
    """Display name of a refined segment; NULL and '' are Not Found, others stay."""
    names = fixed.PERSONA_NAMES + (fixed.PERSONA_NAMES_PRIMARY_ONLY if primary else ())
    branches = [(_in(column, groups), literal(name)) for groups, name in names]
    branches.append((f"{column} IS NULL OR {column} = ''", literal(fixed.NOT_FOUND)))
    return _case(branches, otherwise=column)


def persona_rank(column: str = "segment_grp_1") -> str:
    """decimal(3,1) rank of a refined segment, NULL when it has none."""
    ranks = [(_in(column, groups), literal(rank)) for groups, rank in fixed.PERSONA_RANKS]
    return f"CAST({_case(ranks)} AS DECIMAL(3,1))"


def app_category(column: str = "category") -> str:
    """First matching pattern in order; NULL category is Not Found, no match is NULL."""
    branches = [
        (f"{column} {'LIKE' if '%' in pattern else '='} {literal(pattern)}", literal(name))
        for pattern, name in fixed.APP_CATEGORIES
    ]
    branches.append((f"{column} IS NULL", literal(fixed.NOT_FOUND)))
    return _case(branches)


def has_second_tag(column: str = "category") -> str:
    return f"COALESCE({_in(column, [category for category, _ in fixed.SECOND_TAGS])}, FALSE)"


def second_category(column: str = "category") -> str:
    """Second tag of the categories that have one, else NULL."""
    named = [(c, tag) for c, tag in fixed.SECOND_TAGS if tag is not None]
    return _case((f"{column} = {literal(c)}", literal(tag)) for c, tag in named)


def persona_tags(segment: str = "segment_grp_1", category: str = "category") -> str:
    """Array of the one or two (persona, app_category) tags an app carries.

    The second tag is left out where it equals the first one.
    """
    first = (
        f"named_struct('persona', {persona_name(segment)}, 'app_category', {app_category(category)})"
    )
    second = (
        f"named_struct('persona', {persona_name(segment, primary=False)}, "
        f"'app_category', {second_category(category)})"
    )
    return (
        f"CASE WHEN {has_second_tag(category)} THEN array_distinct(array({first}, {second})) "
        f"ELSE array({first}) END"
    )


def persona_view_query(table: str, columns: Iterable[str], unique_rows: bool = False) -> str:
    """The persona view over a table, one scan for both tags.

    A view row holds every table column, so two rows of the view can only be
    equal when two table rows are: removing duplicates before the tags are
    unnested gives the distinct union of both tags at half its shuffle. A table
    known to have one row per app (``unique_rows``) needs no shuffle at all.
    """
    names = ", ".join(f"`{c}`" for c in columns)
    source = f"SELECT {names} FROM {table}" if unique_rows else f"SELECT DISTINCT {names} FROM {table}"
    return (
        f"SELECT {names}, tag.persona AS persona, {persona_rank()} AS rank, "
        f"tag.app_category AS app_category "
        f"FROM (SELECT *, explode({persona_tags()}) AS tag FROM ({source}))"
    )
