"""License scans over a positional rare-token index, in DataFrame expressions alone.

A template is a phrase or a sentence of a licence's header, with a label and, for some, a
mandatory key phrase that must begin within 12 words after it. Of a phrase all words
count, of a sentence those of seven letters or more, each at its place in it. The index
holds, for every text, the places of the words that count in some template. A template's
rarest word over all texts, by inverse document frequency, is its anchor: from the
anchor's places the template's starts follow, and intersecting them with the other words'
places, shifted likewise, leaves the starts where all words stand. The key phrase is
found the same way and its places widened to those a template may start at. Every step
is a pass over place lists, so a text costs in proportion to its words. A text without
any anchor needs no more.

Only the frequencies of the templates' words, some dozens, reach the driver.

Words are runs of characters other than ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``
after A-Z are lower-cased. The score is the largest share of one label's templates that
a text holds. Nulls: a null text has no words; null ids stay. Repeated rows each give
their row. An empty table gives no rows. Columns other than doc_id and text are not
looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.llm.arrow import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY_DISTANCE = 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Of a header's sentence words of so many letters count.
LONG_WORD = 7


@dataclass(frozen=True)
class Template:
    label: str
    phrase: str
    key: str = ""
    sentence: bool = False

    @property
    def words(self) -> list[str]:
        return self.phrase.split()

    @property
    def marks(self) -> list[tuple[int, str]]:
        """The words that count, with their places in the template."""
        least = LONG_WORD if self.sentence else 1
        return [(at, word) for at, word in enumerate(self.words) if len(word) >= least]


# The base phrases and labels.
BASE = (
    Template("cc-by", "cc by"),
    Template("gpl", "general public license"),
    Template("reserved", "all rights reserved"),
)
MORE = (
    Template("agpl", "affero general public license"),
    Template("apache", "apache license"),
    Template("apache-2.0", "apache license", "version 2 0"),
    Template("bsd", "bsd license"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nc-4.0", "cc by nc", "4 0"),
    Template("cc-by-sa", "cc by sa"),
    Template("gpl-2", "general public license", "version 2"),
    Template("gpl-3", "general public license", "version 3"),
    Template("lgpl", "lesser general public license"),
    Template("mit", "mit license"),
    Template("mpl", "mozilla public license"),
)


def _sentences(label: str, *texts: str) -> tuple[Template, ...]:
    return tuple(Template(label, text, sentence=True) for text in texts)


# Sentences of the licences' own headers, in lower case and without marks.
HEADERS = (
    *_sentences(
        "apache-2.0",
        "you may not use this file except in compliance with the license",
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis",
        "see the license for the specific language governing permissions and limitations under the license",
    ),
    *_sentences(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
    ),
    *_sentences(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
        "this program is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose",
    ),
    *_sentences(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted",
    ),
    *_sentences(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files",
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software",
    ),
    *_sentences("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    *_sentences("unlicense", "this is free and unencumbered software released into the public domain"),
)
TEMPLATES = BASE + MORE + HEADERS


def vocabulary() -> list[str]:
    return sorted({w for t in TEMPLATES for w in (*(word for _, word in t.marks), *t.key.split())})


def indexed(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and postings (word, at) of the words that occur in templates."""
    lowered = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    split = docs.select("doc_id", F.regexp_extract_all(lowered, F.lit(WORD), 0).alias("words"))
    placed = F.transform("words", lambda w, at: F.struct(w.alias("word"), at.cast("int").alias("at")))
    known = F.filter(placed, lambda p: p["word"].isin(vocabulary()))
    return split.select("doc_id", F.size("words").cast("bigint").alias("n_words"), known.alias("postings"))


def anchors(index: DataFrame) -> dict[Template, int]:
    """Of each template the word that fewest texts have, by its place among those that count."""
    words = index.select(F.explode(F.array_distinct(F.transform("postings", lambda p: p["word"]))).alias("word"))
    held = {r.word: r.n for r in words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {t: min(range(len(t.marks)), key=lambda k: (held.get(t.marks[k][1], 0), k)) for t in TEMPLATES}


def _listed(index: DataFrame) -> DataFrame:
    """doc_id, n_words and a list of places for every word of the vocabulary."""

    def held(word: str) -> Column:
        return F.transform(F.filter("postings", lambda p: p["word"] == word), lambda p: p["at"])

    lists = [held(word).alias(f"_w{n}") for n, word in enumerate(vocabulary())]
    return index.select("doc_id", "n_words", *lists)


def _starts(marks: list[tuple[int, str]], anchor: int) -> Column:
    """Where all marked words stand at their places: the anchor's starts met with the others'."""
    number = {word: f"_w{n}" for n, word in enumerate(vocabulary())}

    def shifted(at: int, word: str) -> Column:
        return F.transform(number[word], lambda place: place - at) if at else F.col(number[word])

    found = F.filter(shifted(*marks[anchor]), lambda start: start >= 0)
    for k, mark in enumerate(marks):
        if k != anchor:
            found = F.array_intersect(found, shifted(*mark))
    return found


def places(template: Template, anchor: int) -> Column:
    """The starts of a template's places, without those whose key phrase is missing."""
    starts = _starts(template.marks, anchor)
    if not template.key:
        return starts
    last = len(template.words)
    keys = _starts(list(enumerate(template.key.split())), 0)
    near = F.flatten(F.transform(keys, lambda k: F.sequence(k - (last + KEY_DISTANCE - 1), k - last)))
    return F.array_intersect(starts, near)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the starts of base phrases, base labels, all labels and the score."""
    index = stored(indexed(docs), "license-index")
    rarest = anchors(index)
    found = _listed(index).select(
        "doc_id", "n_words", *[places(t, rarest[t]).alias(f"_{n}") for n, t in enumerate(TEMPLATES)]
    )

    def labels(numbers: range) -> Column:
        named = [F.when(F.size(f"_{n}") > 0, F.lit(TEMPLATES[n].label)) for n in numbers]
        return F.array_sort(F.array_distinct(F.array_compact(F.array(*named))))

    base = range(len(BASE))
    return found.select(
        "doc_id",
        "n_words",
        F.concat(*[F.col(f"_{n}") for n in base]).alias("base_starts"),
        labels(base).alias("base_labels"),
        labels(range(len(TEMPLATES))).alias("labels"),
        F.greatest(*[_share(numbers) for numbers in _by_label().values()]).alias("score"),
    )


def _by_label() -> dict[str, list[int]]:
    """The numbers of each label's templates."""
    found: dict[str, list[int]] = {}
    for n, t in enumerate(TEMPLATES):
        found.setdefault(t.label, []).append(n)
    return found


def _share(numbers: list[int]) -> Column:
    held = [(F.size(f"_{n}") > 0).cast("int") for n in numbers]
    return sum(held[1:], held[0]).cast("double") / F.lit(float(len(numbers)))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_starts").cast("bigint").alias("n_base"),
        F.array_min("base_starts").cast("bigint").alias("first_word"),
        F.array_max("base_starts").cast("bigint").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def _sql_starts(marks: list[tuple[int, str]]) -> str:
    tests = " AND ".join(f"w[i + {at + 1}] = '{word}'" for at, word in marks)
    return f"list_filter(range(0, len(w)), lambda i: {tests})"


def _sql_template(number: int, template: Template) -> str:
    starts = _sql_starts(template.marks)
    if not template.key:
        return f"{starts} AS t{number}"
    low, key = len(template.words), _sql_starts(list(enumerate(template.key.split())))
    near = f"list_filter({key}, lambda k: k >= s + {low} AND k < s + {low + KEY_DISTANCE})"
    return f"list_filter({starts}, lambda s: len({near}) > 0) AS t{number}"


def _sql_score() -> str:
    shares = [
        f"({' + '.join(f'CAST(len(t{n}) > 0 AS INTEGER)' for n in numbers)}) / {len(numbers)}.0::DOUBLE"
        for numbers in _by_label().values()
    ]
    return f"greatest({', '.join(shares)})"


def _sql_labels(templates: tuple[Template, ...]) -> str:
    cases = ", ".join(f"CASE WHEN len(t{n}) > 0 THEN '{t.label}' END" for n, t in enumerate(templates))
    return f"list_sort(list_distinct(list_filter([{cases}], lambda x: x IS NOT NULL)))"


OP9_SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM documents),
found AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    {", ".join(_sql_template(n, t) for n, t in enumerate(TEMPLATES))} FROM d),
named AS (
  SELECT doc_id, n_words, list_concat(list_concat(t0, t1), t2) AS starts,
    {_sql_labels(BASE)} AS base, {_sql_labels(TEMPLATES)} AS every, {_sql_score()} AS score FROM found)
SELECT doc_id, n_words, CAST(len(starts) AS BIGINT) AS n_base, list_min(starts) AS first_word,
  list_max(starts) AS last_word, array_to_string(base, ',') AS base_labels,
  array_to_string(every, ',') AS labels, score FROM named
"""
