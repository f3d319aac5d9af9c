"""Packing by minimum bin slack: token pieces into as few fixed-size sequences as possible.

The plan is made from the counts of piece lengths alone, at most one per length
up to the capacity, so its size does not depend on the corpus. For each sequence
the longest piece left is taken, and a bitset subset-sum over the lengths left
finds the fullest combination that still fits beside it; that combination is
taken as often as the counts allow and then removed. Which piece goes where is
then settled without gathering pieces: a piece's rank among those of its length
is the count in earlier write tasks plus its place in its own.

Nulls: a null text is empty, one piece with the end id alone; null ids stay null.
Repeated rows are packed as often as they occur. An empty table gives no rows. Columns
other than doc_id and text are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bundlescope.llm.arrow import ragged, stored, table, text_slices
from bundlescope.llm.tokens import encoder, library_path, with_end

CAPACITY = 2048
_PIECE = (
    "doc_id bigint, piece int, start bigint, length bigint, ids binary, task int, earlier bigint"
)
_PIECE_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("task", pa.int32()),
        ("earlier", pa.int64()),
    ]
)


def encoded_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY
) -> DataFrame:
    """Token pieces of at most ``capacity`` ids, cut only where a document is longer.

    ``task`` is the write task and ``earlier`` the pieces of the same length that
    the task made before; together they number the pieces of a length.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task = encoder(tokenizer), TaskContext.get().partitionId()
        made = np.zeros(capacity + 1, np.int64)
        for batch, texts in text_slices(batches, "text"):
            ids, bounds = with_end(*known.encode(texts), end_id)
            totals = np.diff(bounds)
            parts = -(-totals // capacity)
            owner = np.repeat(np.arange(len(totals)), parts)
            number = ragged(np.zeros(len(parts), np.int64), parts)
            start = number * capacity
            length = np.minimum(capacity, totals[owner] - start)
            first = bounds[owner] + start
            raw, order = ids.astype("<u4"), np.argsort(length, kind="stable")
            ordered = length[order]
            heads = np.flatnonzero(np.diff(ordered, prepend=-1))
            earlier = np.empty(len(length), np.int64)
            runs = np.diff(np.append(heads, len(ordered)))
            earlier[order] = np.arange(len(ordered)) - np.repeat(heads, runs) + made[ordered]
            made[ordered[heads]] += runs
            yield table(
                _PIECE_ARROW,
                [
                    batch.column("doc_id").take(pa.array(owner)),
                    number.astype(np.int32),
                    start,
                    length,
                    [raw[a : a + n].tobytes() for a, n in zip(first, length)],
                    np.full(len(length), task, np.int32),
                    earlier,
                ],
            )

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    return chosen.mapInArrow(pieces, _PIECE)


def _fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The lengths, with how many of each, that fill most of ``room``.

    Bit s of ``reach`` says that some combination has s ids. Longer lengths come
    first, each in powers of two up to its count; going back, a length is used
    only if the sum cannot be reached without it.
    """
    reach, layers, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left:
            times = min(times, left)
            layers.append((length, times, reach))
            reach |= (reach << (length * times)) & mask
            left -= times
            times *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, times, before in reversed(layers):
        if not before >> total & 1:
            total -= length * times
            chosen[length] = chosen.get(length, 0) + times
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Patterns as (how many sequences, pieces of each length in one)."""
    left = {n: c for n, c in histogram.items() if c}
    patterns = []
    while left:
        longest = max(left)
        left[longest] -= 1
        pattern = _fullest({n: c for n, c in left.items() if c}, capacity - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[n] // c for n, c in pattern.items())
        patterns.append((times, pattern))
        for n, c in pattern.items():
            left[n] -= times * c
            if not left[n]:
                del left[n]
    return patterns


def _places(patterns: list[tuple[int, dict[int, int]]], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces per sequence, first offset)."""
    rows, used, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for times, pattern in patterns:
        offset = 0
        for length, count in sorted(pattern.items(), reverse=True):
            rows.append((length, used[length], sequence, count, offset))
            used[length] += times * count
            offset += length * count
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each row of a stored piece table its ``sequence_id`` and ``offset``.

    Only lengths, tasks and counts are shuffled beside the rows' own columns; the
    driver gets at most ``capacity`` counts and sends back their plan.
    """
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan(histogram, capacity), capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select(
        "length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base")
    )
    ranked = pieces.join(bases, ["length", "task"]).withColumn("_rank", F.col("earlier") + F.col("_base"))
    kept = [c for c in pieces.columns if c not in ("task", "earlier")]
    keys = places[:, 0] * (1 << 48) + places[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = places[np.searchsorted(keys, length * (1 << 48) + rank, side="right") - 1]
            turn = rank - at[:, 1]
            sequence, slot = at[:, 2] + turn // at[:, 3], turn % at[:, 3]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(at[:, 4] + slot * length)],
                names=[*kept, "sequence_id", "offset"],
            )

    types = dict(pieces.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept)
    return ranked.select(*kept, "_rank").mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their ids and places: doc_id, piece, start, length, ids, sequence_id, offset."""
    return placed(stored(encoded_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)


def packed_digest(docs: DataFrame) -> DataFrame:
    """The packing of documents with a checksum in place of the ids."""
    pieces = stored(encoded_pieces(docs, library_path("word_bpe_49k.json")), "pieces")
    thin = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return placed(thin)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
