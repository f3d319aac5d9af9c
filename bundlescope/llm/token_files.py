"""Token-id files: flat unsigned integers, 64-bit document offsets, memory-mapped reading.

A corpus is a folder with three flat little-endian files per shard: ``ids``
(unsigned 16- or 32-bit, by the vocabulary's size), ``offsets`` (unsigned 64-bit,
one more than documents, from 0 within the shard) and ``docs`` (signed 64-bit
document ids), and a Parquet table ``shards`` with one row per shard. Shards are
ranges of document ids in ascending order; a shard's base, the ids in all shards
before it, is a prefix sum over that table.

Every task writes files under names of its own and reports them; only those that
committed tasks report are in ``shards``, so a task that is run twice or lost
leaves at most files that nothing names.

Nulls: a null text is an empty one; a null document id sorts first and is read
back as null. Repeated rows are documents of their own. An empty table gives no
shard and no rows. Other columns are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.llm.arrow import table, text_slices
from bundlescope.llm.tokens import encoder, library_path, with_end
from bundlescope.session import scratch_path

NULL_DOC = np.iinfo(np.int64).min
_SHARD = "shard int, name string, n_docs bigint, n_tokens bigint"
_SHARD_ARROW = pa.schema(
    [("shard", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
)
_DOC = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
_DOC_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
)


def _local(folder: str) -> str | None:
    parts = urlparse(folder)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def _file_system(folder: str):
    from pyarrow import fs

    local = _local(folder)
    return (fs.LocalFileSystem(), local) if local else fs.FileSystem.from_uri(folder)


def _mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """A flat file as an array: mapped where it is a local or mounted file."""
    local = _local(folder)
    if local is None:
        system, path = _file_system(folder)
        return np.frombuffer(system.open_input_file(f"{path}/{name}").read(), kind)
    try:
        return np.memmap(f"{local}/{name}", dtype=kind, mode="r")
    except ValueError:  # an empty file can't be mapped
        return np.zeros(0, kind)


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 1,
    id_type: str = "<u2",
    partitions: int | None = None,
) -> None:
    """Encode whole texts, append ``end_id`` to each, write shards in document order."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        known, highest = encoder(tokenizer), np.iinfo(np.dtype(id_type)).max
        system, path = _file_system(folder)
        system.create_dir(path, recursive=True)
        n_docs = n_tokens = 0
        with (
            system.open_output_stream(f"{path}/{name}.ids") as ids_file,
            system.open_output_stream(f"{path}/{name}.offsets") as offsets_file,
            system.open_output_stream(f"{path}/{name}.docs") as docs_file,
        ):
            offsets_file.write(np.zeros(1, "<u8").tobytes())
            for batch, texts in text_slices(batches, "text"):
                ids, bounds = with_end(*known.encode(texts), end_id)
                if len(ids) and ids.max() > highest:
                    raise ValueError(f"an id does not fit {id_type}")
                ids_file.write(ids.astype(id_type).tobytes())
                offsets_file.write((n_tokens + bounds[1:]).astype("<u8").tobytes())
                named = batch.column("doc_id").fill_null(int(NULL_DOC)).to_numpy()
                docs_file.write(named.astype("<i8").tobytes())
                n_docs += batch.num_rows
                n_tokens += len(ids)
        if n_docs:
            yield table(_SHARD_ARROW, [[number], [name], [n_docs], [n_tokens]])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    ordered = (
        chosen.repartitionByRange(partitions, "doc_id")
        if partitions
        else chosen.repartitionByRange("doc_id")
    )
    ordered.sortWithinPartitions("doc_id").mapInArrow(shard, _SHARD).write.parquet(f"{folder}/shards")


def read(spark: SparkSession, folder: str, id_type: str = "<u2") -> DataFrame:
    """Documents of a corpus: doc_id, start, n_tokens and ids (unsigned 32-bit, little-endian).

    The driver sees one row per shard, no more than there were write tasks.
    """
    rows = spark.read.schema(_SHARD).parquet(f"{folder}/shards").orderBy("shard").collect()
    bases = np.concatenate([[0], np.cumsum([r.n_tokens for r in rows], dtype=np.int64)])
    shards = [(r.name, int(base)) for r, base in zip(rows, bases)]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in batch.column(0).to_pylist():
                name, base = shards[n]
                ids = _mapped(folder, f"{name}.ids", id_type)
                offsets = _mapped(folder, f"{name}.offsets", "<u8").astype(np.int64)
                named = _mapped(folder, f"{name}.docs", "<i8")
                first = 0
                while first < len(named):
                    last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + (1 << 20))) - 1)
                    block = range(first, min(last, len(named)))
                    yield table(
                        _DOC_ARROW,
                        [
                            [None if named[k] == NULL_DOC else int(named[k]) for k in block],
                            base + offsets[block.start : block.stop],
                            np.diff(offsets[block.start : block.stop + 1]),
                            [ids[offsets[k] : offsets[k + 1]].astype("<u4").tobytes() for k in block],
                        ],
                    )
                    first = block.stop

    return spark.range(0, len(shards), 1, max(1, len(shards))).mapInArrow(documents, _DOC)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as token files, read back: doc_id, start, n_tokens, ids_crc32."""
    folder = scratch_path(spark, "token-files")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write(docs, folder, library_path("word_bpe_49k.json"), end_id=1)
    found = read(spark, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def checksum(ids: np.ndarray) -> int:
    """The digest of a document's ids, for tests and for readers of the files."""
    return zlib.crc32(ids.astype("<u4").tobytes())
