"""Helpers shared by the operators: Arrow batches, words, hashes, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.session import scratch_path

#: Text bytes worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to a table in the shared folder and read again: it cuts the
    lineage, and losing executors cannot change or lose what later steps read."""
    spark = spark_of(df)
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def set_apart(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """The rows with every column but the used ones under a name that no operator uses, and
    the columns that give them their names and order back."""
    apart = [c if c in used else f"passed_{n}" for n, c in enumerate(docs.columns)]
    return docs.toDF(*apart), [F.col(a).alias(c) for a, c in zip(apart, docs.columns)]


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Each batch in slices of a few MB of text, with its text (null: empty)."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start), texts.slice(start, stop - start)
            start = stop


def list_bounds(lists: pa.Array) -> np.ndarray:
    """Where each list starts in the flattened values, and where the last one ends."""
    offsets = lists.offsets.to_numpy()
    return (offsets - offsets[0]).astype(np.int64)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of characters other than ``[\\x20\\x09-\\x0D]`` of each text, flat, and each text's bounds."""
    lists = pc.ascii_split_whitespace(texts)
    flat, bounds = lists.flatten(), list_bounds(lists)
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not filled.all():
        flat = flat.filter(pa.array(filled))
        bounds = np.concatenate([[0], np.cumsum(filled)])[bounds]
    return flat, bounds


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; each distinct word is hashed once."""
    import xxhash

    if len(words) == 0:
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    known = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()]
    return np.array(known, np.uint64)[coded.indices.to_numpy()]


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of so many consecutive words, by its first word."""
    count = max(0, len(hashes) - length + 1)
    out = np.full(count, np.uint64(length))
    for k in range(length):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count])
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0]+1, ... for each run, one run after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def table(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
