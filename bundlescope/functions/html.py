"""Tags and attributes from whole HTML pages with built-in regular expressions.

All patterns run in one pass over a page of any shape: repeats are possessive, so
that nothing is tried twice and Java's matcher does not recurse, and what is not
closed ends with the page, so that no start scans the same rest again. A quote
opens a value only behind an equals sign; values may also be unquoted.
"""

from __future__ import annotations

import json
import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character references whose result is not that of the
# HTML 4 names (a plain blank for &nbsp;), or that have no name there.
CHARACTER_REFERENCES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&#x27;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
)

# What may stand inside a tag: anything but its end, and whole quoted values.
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_TAG_END = r"(?:>|\z)"
_NAMED = r"(?=[\s/>])"
_ATTRIBUTE = r"""[\s/"']([^\s=>/"'][^\s=>/]*+)\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+"""
_INVISIBLE = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|<script{_NAMED}[^>]*+(?:>.*?(?:</script\s*+>|\z)|\z)"
    rf"|<style{_NAMED}[^>]*+(?:>.*?(?:</style\s*+>|\z)|\z)"
)
_REFERENCE = r"&(?:#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,8}|[a-zA-Z][a-zA-Z0-9]{1,30});"


def visible(page: Column) -> Column:
    """The page without comments, scripts and styles, whose text holds no tags."""
    return F.regexp_replace(page, _INVISIBLE, "")


def _opening_tags(page: Column, tag: str) -> Column:
    found = F.regexp_extract_all(page, F.lit(rf"(?is)<{re.escape(tag)}{_NAMED}{_INSIDE}{_TAG_END}"), F.lit(0))
    return F.filter(found, lambda t: t.endswith(">"))


def opening_tag(
    page: Column, tag: str, attribute: str | None = None, value: str | None = None
) -> Column:
    """First opening tag, or the first one with this attribute value; NULL when there is none."""
    tags = _opening_tags(page, tag)
    if attribute is not None:
        tags = F.filter(tags, lambda t: F.coalesce(_raw_attribute(t, attribute) == value, F.lit(False)))
    return F.get(tags, 0)


def _raw_attribute(opening: Column, attribute: str) -> Column:
    every = F.regexp_extract_all(opening, F.lit(f"(?s){_ATTRIBUTE}"), F.lit(0))
    wanted = rf"(?is)^[\s/\"']{re.escape(attribute)}\s*+="
    first = F.get(F.filter(every, lambda a: a.rlike(wanted)), 0)
    value = F.regexp_replace(first, r"(?s)^[^=]*+=\s*+", "")
    return F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")


def attribute_of(opening: Column, attribute: str) -> Column:
    """Decoded value of one attribute of an opening tag, NULL when it is absent."""
    return decode(_raw_attribute(opening, attribute))


def inner_text(
    page: Column, tag: str, attribute: str | None = None, value: str | None = None
) -> Column:
    """Text inside the first matching element, '' when the page has none.

    Tags nested in it are dropped and their text kept; nothing is trimmed.
    """
    opening = opening_tag(page, tag, attribute, value)
    rest = F.substr(page, F.instr(page, opening) + F.length(opening))
    inside = F.regexp_extract(rest, rf"(?is)^(.*?)</{re.escape(tag)}\s*+>", 1)
    return F.coalesce(decode(F.regexp_replace(inside, r"(?s)<[a-zA-Z/!?][^>]*+(?:>|\z)", "")), F.lit(""))


def decode(text: Column) -> Column:
    """Text with its character references replaced, each once; those of & itself come last."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)))
    ampersand = r"^&(?:amp|#0*+38|#[xX]0*+26);$"
    ordered = F.concat(
        F.filter(found, lambda r: ~r.rlike(ampersand)), F.filter(found, lambda r: r.rlike(ampersand))
    )
    decoded = F.aggregate(ordered, text, lambda done, r: F.replace(done, r, _character(r)))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def _character(reference: Column) -> Column:
    """What a reference stands for; itself if that is nothing."""
    known = {f"&{name};": chr(code) for name, code in name2codepoint.items()} | dict(CHARACTER_REFERENCES)
    names = F.from_json(F.lit(json.dumps(known)), "map<string,string>")
    digits = F.regexp_extract(reference, r"^&#[xX]?([0-9a-fA-F]++);$", 1)
    decimal = reference.rlike("^&#[0-9]")
    code = F.when(decimal, digits).otherwise(F.conv(digits, 16, 10)).try_cast("bigint")
    usable = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(F.when(usable, code)), 8, "0")), "UTF-32")
    return F.coalesce(F.try_element_at(names, reference), character, reference)
