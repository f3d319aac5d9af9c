"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without outer ``[\\x20\\x09-\\x0D]``, A-Z lower-cased,
hashed to 128 bits. Documents come in batches. A batch is reduced to one row per
key (documents that hold it, largest document id) and merge-anti-joined with the runs
so far, one after the other: what no run has is the batch's own and becomes a new run;
what is left of the batch are ``hits``, further sightings of keys that a run has. So each
key is in one run, once, and its documents are those of its row and of its hits, which
are few, since most lines occur once. A level with ``fanout`` runs is compacted to one
run of the next level, so a key is rewritten once per level and not once per batch.

Runs, batches and hits are tables dealt out by key into the same number of buckets and
sorted in each, so the joins between them shuffle nothing. Texts are read once for
their keys and once to drop lines. A line that very many documents hold is one row of a
plain join, whose partitions adaptive execution can split.

Nulls: a null text is one empty line; rows without a document id keep all their
lines and count for no key. Rows that repeat a document id are one document.
An empty table gives no rows. Other columns are not looked at, whatever their names, and
stay in ``kept_lines``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.llm.arrow import set_apart, stored, table, text_slices
from bundlescope.session import scratch_path

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 3
_SPACE = b" \t\n\x0b\x0c\r"


def key_of(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The hashed key of a line in UTF-8, or None if it is too short to be looked at."""
    import xxhash

    key = line.strip(_SPACE)
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key.lower())  # bytes.lower() changes A-Z alone


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The distinct keys of each row with a document id: doc_id, line."""
    arrow = pa.schema([("doc_id", pa.int64()), ("line", pa.binary())])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            ids, lines = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts.to_pylist()):
                found = {key_of(line, min_chars) for line in text.encode().split(b"\n")} - {None}
                ids += [doc] * len(found)
                lines += found
            yield table(arrow, [ids, lines])

    chosen = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string")
    )
    return chosen.mapInArrow(keys, "doc_id bigint, line binary")


_RUN = "line binary, docs bigint, last bigint"


class LineRuns:
    """Levels of sorted runs with line, docs, last, each key once, and hits of their keys."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.hits: list[DataFrame] = []
        self.paths: dict[DataFrame, str] = {}

    def _all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _dealt(self, rows: DataFrame, label: str) -> DataFrame:
        """The rows as a table in the shared folder, dealt out by line and sorted.

        Only its files stay; the catalog entry, by which Spark learns of the buckets, goes.
        """
        name = f"{label}_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, label)
        writer = rows.select("line", "docs", "last").repartition(self.buckets, "line").write.format("parquet")
        writer.bucketBy(self.buckets, "line").sortBy("line").option("path", path).saveAsTable(name)
        found = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        self.paths[found] = path
        return found

    def _together(self, tables: list[DataFrame]) -> DataFrame:
        """The rows of several tables, read as plain files.

        A union of bucketed tables counts as dealt out by line, also where its scans are not
        read by bucket, and a grouping of it would then be wrong.
        """
        return self.spark.read.schema(_RUN).parquet(*[self.paths[t] for t in tables])

    def _level(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._level(self._dealt(self._together(runs), "line_run"), level + 1)

    def add(self, batch: DataFrame) -> None:
        """Add one batch of line, docs, last whose documents no earlier batch had."""
        batch = self._dealt(batch, "line_batch")
        if not self._all():
            self._level(batch, 0)
            return
        fresh = batch
        for run in self._all():
            fresh = fresh.join(run.select("line").hint("merge"), "line", "left_anti")
        fresh = self._dealt(fresh, "line_run")
        self.hits.append(self._dealt(batch.join(fresh.select("line").hint("merge"), "line", "left_anti"), "line_hits"))
        self._level(fresh, 0)

    def lines(self, min_docs: int = 1) -> DataFrame:
        """line, docs, last of the lines that so many documents have, one row per line."""
        if not self.hits:
            return self._together(self._all()).where(F.col("docs") >= min_docs)
        summed = self._together(self.hits).groupBy("line").agg(
            F.sum("docs").alias("docs"), F.max("last").alias("last")
        )
        more = self._dealt(summed, "line_more").select("line", F.col("docs").alias("_docs"), F.col("last").alias("_last"))
        found = [run.join(more.hint("merge"), "line", "left") for run in self._all()]
        told = [
            one.select(
                "line",
                (F.col("docs") + F.coalesce("_docs", F.lit(0))).alias("docs"),
                F.greatest("last", "_last").alias("last"),
            )
            for one in found
        ]
        return stored(reduce(DataFrame.union, told).where(F.col("docs") >= min_docs), "common-lines")


def line_index(keys: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> LineRuns:
    """The runs of a corpus's keys (``stored_keys``), added in batches of documents."""
    runs = LineRuns(keys.sparkSession, fanout)
    for number in range(batches):
        part = keys.where(F.col("batch") == number)
        runs.add(part.groupBy("line").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last")))
    return runs


def stored_keys(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, line and batch of each document's distinct keys, in a folder per batch.

    Rows that repeat a document id are brought together only where there are any.
    """
    ids = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count()
    keys = line_keys(docs)
    if not ids.where("count > 1").isEmpty():
        keys = keys.distinct()
    path = scratch_path(docs.sparkSession, "line-keys")
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    keys.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    return docs.sparkSession.read.schema("doc_id bigint, line binary, batch int").parquet(path)


def dropped_lines(keys: DataFrame, common: DataFrame) -> DataFrame:
    """The keys that each document loses: doc_id, lines."""
    lost = keys.join(common.select("line", "last"), "line").where(F.col("doc_id") != F.col("last"))
    return lost.groupBy("doc_id").agg(F.collect_set("line").alias("_lines"))


def _rejoined(text: str, lost: set[bytes]) -> tuple[str, int, int]:
    lines = text.encode().split(b"\n")
    kept = [x for x in lines if key_of(x) not in lost] if lost else lines
    return b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)


def without_common_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """All rows with the remaining text, and ``n_lines``, ``n_dropped`` after them.

    Other columns must not be called like these or ``_doc`` and ``_lines``.
    """
    keys = stored_keys(docs, batches)
    lost = dropped_lines(keys, line_index(keys, batches).lines(MIN_DOCS))
    joined = docs.join(lost.withColumnRenamed("doc_id", "_doc"), docs["doc_id"] == F.col("_doc"), "left")
    columns, text_at = docs.columns, docs.columns.index("text")
    counts = [("n_lines", pa.int64()), ("n_dropped", pa.int64())]

    def rejoin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            sets = [set(x or ()) for x in batch.column("_lines").to_pylist()]
            done = [_rejoined(t, s) for t, s in zip(texts.to_pylist(), sets)]
            arrays = [batch.column(n) for n in range(len(columns))]
            arrays[text_at] = pa.array([x[0] for x in done], pa.string())
            arrays += [pa.array([x[k] for x in done], kind) for k, (_, kind) in enumerate(counts, 1)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *(n for n, _ in counts)])

    shape = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return joined.select(*[docs[c] for c in columns], "_lines").mapInArrow(
        rejoin, f"{shape}, n_lines bigint, n_dropped bigint"
    )


def kept_lines(docs: DataFrame, length: str | None = None, batches: int = BATCHES) -> DataFrame:
    """All rows and columns with the remaining text; a column named by ``length`` gets its
    code points where lines were dropped."""
    rows, back = set_apart(docs, "doc_id", "text")
    found = without_common_lines(rows, batches)
    if length in docs.columns:
        at = docs.columns.index(length)
        name, kind = rows.columns[at], docs.schema[at].dataType
        kept = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col(name))
        back[at] = kept.cast(kind).alias(length)
    return found.select(*back)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_common_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


OP7_SQL = """
WITH numbered AS (
  SELECT doc_id, pos, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
common AS (
  SELECT key, max(doc_id) AS last FROM numbered WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT a.doc_id, a.pos, a.line, c.key IS NOT NULL AND a.doc_id <> c.last AS lost
  FROM numbered a LEFT JOIN common c ON a.key = c.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
  CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
