"""Quality rules of documents and of the hosts they come from.

A document fails ``base`` with fewer than 20 words or over 30 % of its words in
repeated 8-word windows. For its host it also counts as a failure if symbols or
repeated lines are more than a tenth of its words or 30 % of its lines. A host's failure rate
is shrunk towards all hosts: a beta prior, fitted by moments to the hosts' own
rates, is added to its counts, and a host whose shrunk rate is above one half is
rejected with all its documents. So a host needs both a high rate and enough
documents to be rejected.

Nulls: a null text has no words; a null or empty source is no host, and only the
document's own rules decide. Repeated rows count as often as they occur. An empty
table gives no rows. Columns other than source and text pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.llm.arrow import mixed, run_hashes, set_apart, stored, text_slices, word_hashes, words_of
from bundlescope.operators.joins import lookup_join

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MAX_HOST_RATE = 0.5
SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: pa.Array, bounds: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in that text."""
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    runs = run_hashes(word_hashes(words), window)
    whole = owner[: len(runs)] == owner[window - 1 :][: len(runs)]
    at = np.flatnonzero(whole)
    keys = mixed(runs[at] + mixed(owner[at] + np.uint64(1)))
    order = np.argsort(keys)
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    twice = at[np.unique(np.concatenate([order[same], order[same + 1]]))] if len(same) else same
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, np.minimum(twice + window, len(words)), -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(change)[:-1] > 0)])
    return covered[bounds[1:]] - covered[bounds[:-1]]


def _lines(text: str) -> tuple[int, int]:
    lines = text.split("\n")
    worded = [x for x in lines if x.strip(_SPACE)]
    return len(lines), len(worded) - len(set(worded))


def measured(docs: DataFrame) -> DataFrame:
    """Every row and column with the measures of its text after them."""
    columns = docs.columns

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            words, bounds = words_of(texts)
            plain = texts.to_pylist()
            lines = [_lines(t) for t in plain]
            found = [
                np.diff(bounds),
                [len(t) - sum(map(t.count, _SPACE)) for t in plain],
                [sum(map(t.count, SYMBOLS)) for t in plain],
                [x[1] for x in lines],
                repeated_words(words, bounds),
                [x[0] for x in lines],
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x, pa.int64()) for x in found)],
                names=[*columns, *(f"_{m}" for m in MEASURES)],
            )

    shape = ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes), *(f"_{m} bigint" for m in MEASURES)])
    return docs.mapInArrow(measure, shape)


def base_failed() -> F.Column:
    many = F.lit(100) * F.col("_n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("_n_words")
    return (F.col("_n_words") < MIN_WORDS) | many


def any_rule_failed() -> F.Column:
    symbols = F.lit(10) * F.col("_n_symbols") > F.col("_n_words")
    lines = F.lit(100) * F.col("_n_dup_lines") > F.lit(30) * F.col("_n_lines")
    return base_failed() | symbols | lines


def host_verdicts(rows: DataFrame) -> DataFrame:
    """Shrunk failure rate of each host: _host, host_rate, host_rejected.

    One row of sums over hosts reaches the driver.
    """
    named = rows.where(F.col("source").isNotNull() & (F.col("source") != ""))
    hosts = stored(
        named.groupBy(F.col("source").alias("_host")).agg(
            F.count(F.lit(1)).alias("docs"), F.sum(any_rule_failed().cast("bigint")).alias("failed")
        ),
        "hosts",
    )
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("docs").alias("docs"),
        F.sum("failed").alias("failed"),
        F.sum(F.col("failed") * F.col("failed") / F.col("docs")).alias("squares"),
    ).first()
    a, b = beta_prior(sums["hosts"], sums["docs"] or 0, sums["failed"] or 0, sums["squares"] or 0.0)
    rate = (F.col("failed") + F.lit(a)) / (F.col("docs") + F.lit(a + b))
    return hosts.select("_host", rate.alias("host_rate"), (rate > MAX_HOST_RATE).alias("host_rejected"))


def beta_prior(hosts: int, docs: int, failed: int, squares: float) -> tuple[float, float]:
    """The prior whose mean and spread are those of the hosts' rates, weighted by documents.

    With no spread to speak of it weighs as much as 1000 documents, with the
    widest possible spread as much as two.
    """
    if not docs:
        return 1.0, 1.0
    mean = failed / docs
    if mean in (0.0, 1.0):
        return 1000.0 * mean, 1000.0 * (1 - mean)
    spread = squares / docs - mean * mean
    weight = mean * (1 - mean) / spread - 1 if spread > 0 else 1000.0
    weight = min(1000.0, max(2.0, weight))
    return mean * weight, (1 - mean) * weight


def judged(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """Measured rows with ``host_rejected`` and ``kept``."""
    joined = lookup_join(rows, hosts, "source", "_host").drop("_host")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.withColumn("host_rejected", rejected).withColumn("kept", ~base_failed() & ~rejected)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that their own rules and their host's verdict keep, with their columns."""
    rows, back = set_apart(docs, "source", "text")
    hosts = host_verdicts(measured(rows.select("source", "text")).drop("text"))
    return judged(measured(rows), hosts).where("kept").select(*back)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    rows = stored(measured(docs).drop("text"), "measures")
    out = judged(rows, host_verdicts(rows))
    return out.select(
        "doc_id",
        *[F.col(f"_{m}").alias(m) for m in MEASURES[:5]],
        base_failed().alias("base_failed"),
        "kept",
    )


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, pos, array_to_string(w[pos:pos + 7], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS pos FROM d WHERE len(w) >= 8)),
twice AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows)
  WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT word) AS n
  FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS word FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
line_counts AS (
  SELECT doc_id, count(*) AS n_lines,
    count(*) FILTER (WHERE regexp_matches(line, '[^\x20\x09-\x0D]'))
      - count(DISTINCT line) FILTER (WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_dup
  FROM lines GROUP BY doc_id),
m AS (
  SELECT d.doc_id, d.source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(l.n_dup AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, l.n_lines
  FROM d JOIN line_counts l ON d.doc_id = l.doc_id LEFT JOIN repeats r ON d.doc_id = r.doc_id),
f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    base_failed OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines AS failed FROM m),
hosts AS (
  SELECT source, count(*) AS docs, count(*) FILTER (WHERE failed) AS bad
  FROM f WHERE source <> '' GROUP BY source),
moments AS (SELECT sum(bad) / sum(docs) AS mean, sum(bad * bad / docs) / sum(docs) AS sq FROM hosts),
prior AS (
  SELECT mean, CASE WHEN mean IN (0, 1) OR sq - mean * mean <= 0 THEN 1000.0
    ELSE least(1000.0, greatest(2.0, mean * (1 - mean) / (sq - mean * mean) - 1)) END AS weight FROM moments),
verdicts AS (
  SELECT source, (bad + mean * weight) / (docs + weight) > 0.5 AS rejected FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(v.rejected, false) AS kept
FROM f LEFT JOIN verdicts v ON f.source = v.source
"""
