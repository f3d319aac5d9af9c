"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over a text finds the anchors: at-signs,
plus signs, digits, ``://`` and the cue words of secrets. From each anchor a
deterministic parser expands to the boundaries of what it may be part of and
validates that; no expression is searched for in the text. Parsers move a floor
along, the end of what they have read, so every character is read a bounded
number of times whatever the text.

Kinds: ``email``, ``ip``, ``card``, ``phone``; then ``iban`` (country code, check
digits, modulus 97), ``secret`` (a cue, ``=`` or ``:``, a value with a digit) and
``url`` (an address that names an account, ``scheme://user@host``). Spans are
code points, end exclusive; those of one kind never overlap.

Nulls: a null text is empty; null ids stay. Repeated rows each give their row. An
empty table gives no rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from string import ascii_letters, ascii_uppercase, digits

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.llm.arrow import table, text_slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "secret", "url")
CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key")

_DIGITS = frozenset(digits)
_ALNUM = frozenset(ascii_letters + digits)
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_SCHEME = _ALNUM | frozenset("+.-")
_VALUE = _ALNUM | frozenset("_-+/=.")
_TRAILING = ".,;:!?)"
_NO_URL = frozenset(" \t\n\x0b\x0c\r\"'<>")


def _run(text: str, at: int, chars: frozenset[str]) -> int:
    """The end of the characters from ``at`` on that are in the set."""
    end = len(text)
    while at < end and text[at] in chars:
        at += 1
    return at


def _back(text: str, at: int, floor: int, chars: frozenset[str]) -> int:
    while at > floor and text[at - 1] in chars:
        at -= 1
    return at


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = _back(text, at, floor, _LOCAL)
    end = _run(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    labels = 1
    while end < len(text) and text[end] == "." and (more := _run(text, end + 1, _LABEL)) > end + 1:
        end, labels = more, labels + 1
    return (start, end) if labels > 1 else None


def _address(text: str, at: int) -> tuple[int, bool]:
    """The end of up to four dotted numbers, and whether they are an address."""
    end, parts = at, []
    while True:
        more = _run(text, end, _DIGITS)
        parts.append(text[end:more].lstrip("0"))
        end = more
        if len(parts) == 4 or not (text[end : end + 1] == "." and text[end + 1 : end + 2] in _DIGITS):
            break
        end += 1
    return end, len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def luhn(number: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(number)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _card(text: str, at: int) -> tuple[int, bool]:
    """The end of digits with at most one blank or hyphen between two, and whether they are a card."""
    end = _run(text, at, _DIGITS)
    while text[end : end + 1] in (" ", "-") and text[end + 1 : end + 2] in _DIGITS:
        end = _run(text, end + 1, _DIGITS)
    number = text[at:end].replace(" ", "").replace("-", "")
    return end, 13 <= len(number) <= 19 and luhn(number)


def _phone(text: str, at: int) -> tuple[int, bool]:
    """The end of what a plus sign starts, and whether it is a number."""
    if text[at + 1 : at + 2] not in _DIGITS:
        return at + 1, False
    end = _run(text, at + 2, _PHONE)
    while end > at + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end <= at + 3:
        return at + 1, False
    return end, 9 <= sum(c in _DIGITS for c in text[at:end]) <= 15


def _iban(text: str, at: int) -> tuple[int, int] | None:
    """An account number whose check digits start at ``at``."""
    start = at - 2
    if start < 0 or not (text[start] in ascii_uppercase and text[start + 1] in ascii_uppercase):
        return None
    if start and text[start - 1] in _ALNUM or text[at + 1 : at + 2] not in _DIGITS:
        return None
    end, number = start, ""
    while len(number) < 35 and end < len(text):
        if text[end] in _ALNUM:
            number += text[end]
        elif text[end] != " " or text[end + 1 : end + 2] not in _ALNUM:
            break
        end += 1
    while len(number) >= 15:
        whole = end == len(text) or text[end] not in _ALNUM
        if whole and int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1:
            return start, end
        end -= 1
        number = number[:-1] if text[end] in _ALNUM else number
    return None


def _secret(text: str, at: int) -> tuple[int, int, bool]:
    """What stands behind a cue that ends at ``at``, and whether it is a secret's value."""
    place = _run(text, at, frozenset("\"'")) if text[at : at + 1] in ("'", '"') else at
    place = _run(text, place, frozenset(" "))
    if text[place : place + 1] not in ("=", ":"):
        return at, place, False
    place = _run(text, place + 1, frozenset(" "))
    place += text[place : place + 1] in ("'", '"')
    end = _run(text, place, _VALUE)
    value = text[place:end]
    return place, end, len(value) >= 8 and any(c in _DIGITS for c in value)


def _url(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """An address with an account around a ``://`` at ``at``."""
    start = _back(text, at, floor, _SCHEME)
    end = at + 3
    while end < len(text) and text[end] not in _NO_URL and text[end] != "/":
        end += 1
    host = text[at + 3 : end].rstrip(_TRAILING)
    if start == at or not 0 < host.find("@") < len(host) - 1:
        return None
    while end < len(text) and text[end] not in _NO_URL:
        end += 1
    return start, at + 3 + len(text[at + 3 : end].rstrip(_TRAILING))


@functools.cache
def _anchors():
    import ahocorasick

    found = ahocorasick.Automaton()
    for sign in ("@", "+", "://", *digits):
        found.add_word(sign, (sign if sign not in _DIGITS else "digit", len(sign)))
    for cue in CUES:
        for word in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(word, ("cue", len(word)))
    found.make_automaton()
    return found


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text by kind, then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    floor = dict.fromkeys(KINDS, 0)

    def keep(kind: str, span: tuple[int, int] | None) -> None:
        if span:
            found[kind].append(span)
            floor[kind] = span[1]

    for last, (anchor, length) in _anchors().iter(text):
        at = last - length + 1
        if anchor == "digit":
            if at >= floor["card"]:
                end, ok = _card(text, at)
                keep("card", (at, end) if ok else None)
                floor["card"] = end
            if at >= floor["ip"]:
                end, ok = _address(text, at)
                keep("ip", (at, end) if ok else None)
                floor["ip"] = end
            if at - 2 >= floor["iban"]:
                keep("iban", _iban(text, at))
        elif anchor == "@":
            keep("email", _email(text, at, floor["email"]))
        elif anchor == "+" and at >= floor["phone"]:
            end, ok = _phone(text, at)
            keep("phone", (at, end) if ok else None)
            floor["phone"] = end
        elif anchor == "cue" and at >= floor["secret"]:
            start, end, ok = _secret(text, last + 1)
            keep("secret", (start, end) if ok else None)
            floor["secret"] = end
        elif anchor == "://" and at >= floor["url"]:
            keep("url", _url(text, at, floor["url"]))
    return [(kind, *span) for kind in KINDS for span in found[kind]]


_SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"


def with_spans(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of every row."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    arrow = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            spans = [
                [dict(zip(("kind", "start", "end"), s)) for s in spans_of(t)] for t in texts.to_pylist()
            ]
            yield table(arrow, [batch.column("doc_id"), spans])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    return chosen.mapInArrow(find, f"doc_id bigint, spans {_SPANS}")


def masked(docs: DataFrame) -> DataFrame:
    """doc_id and text with every span replaced by its kind in angle brackets."""
    arrow = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            yield table(arrow, [batch.column("doc_id"), [mask_text(t) for t in texts.to_pylist()]])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    return chosen.mapInArrow(mask, "doc_id bigint, text string")


def mask_text(text: str) -> str:
    """Overlapping spans of several kinds are one, named after the one that starts first."""
    parts, at = [], 0
    for start, _, end, kind in sorted((s, -e, e, k) for k, s, e in spans_of(text)):
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _joined(spans: F.Column) -> F.Column:
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, line), ",")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        F.size(F.array_remove(kinds, "")) - F.size(F.array_remove(kinds, kind)) for kind in BASE_KINDS
    ]
    counts = [n.cast("bigint").alias(f"n_{kind}") for n, kind in zip(counts, BASE_KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
