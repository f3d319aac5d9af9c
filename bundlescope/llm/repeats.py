"""Repeated byte strings by prefix-free parsing.

A string of ``LENGTH`` bytes (a window) is repeated if it also starts anywhere
else. A rolling hash of 16 bytes triggers phrase boundaries, so the same bytes
are parsed alike wherever they stand. A full suffix array in corpus order is not
needed to find repeats: two windows are equal when their suffixes agree for 400
bytes, so suffixes only have to be told apart that far. They are, in two steps, as the
suffixes of a phrase followed by suffixes of the parse are in the array:

* Windows that start in one phrase share their first boundary, and so what
  follows it. That context is the class of a block of windows. A block whose class
  occurs once has no repeated window; if all blocks of a class are equal bytes,
  all its windows are repeated. That settles all but the edges of repeats.
* Blocks of a class that differ are cut into parts of ``PART`` windows, at distances from
  the boundary, and the parts put into classes by the bytes that all their windows share.
  Windows are told apart one by one only in the parts of a class that differ, some two
  at each edge of a repeat.

Most blocks occur once, so a first pass only counts classes. Those that occur twice or more are
broadcast as bits, at most ``FILTER_BITS`` whatever the table's size, and the second pass makes
rows of these blocks alone. Bits that two classes share let some others through, more of them
where the bits are full; they are counted again, exactly. The texts that hold a block that
repeats are found by bits of their keys in the same way. They, and the few that share their
bits, are shuffled and written for the steps that follow; others are left as they are where they are read.

Classes are 64-bit hashes; a block or window counts as equal to another if two
hashes of its bytes, 128 bits in all, are. Windows without any boundary (long runs of a
short period, mostly) are blocks of their own. Each text first reduces its own
repetitions, and shuffles carry hashes, save those of the texts with repeats.

Texts are looked up by a 128-bit hash of the whole text, as two integers: equal
texts have equal results. Nulls: a null text is empty; null ids stay. Repeated rows are repeats
of each other. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.llm.arrow import list_bounds, mixed, ragged, stored, table, text_slices

LENGTH = 400
TRIGGER = 16
PERIOD = 64
#: Windows whose first boundary is at most so far in, and the context after it that all of them hold.
CONTEXTS = ((0, 64, 320), (65, 200, 200))
PART = 8
#: 64 MB of bits.
FILTER_BITS = 1 << 29
_BITMAP = 1 << 15
#: Text bytes worked on at once; a longer text is a slice of its own.
_SLICE = 1 << 20
_random = np.random.default_rng(77)
_BASES = [int(x) | 1 for x in _random.integers(1 << 40, 1 << 62, 2)]
_BYTES = [_random.integers(1 << 20, 1 << 63, 256, np.uint64) for _ in range(2)]


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, np.uint64(base))
    if count:
        factors[0] = 1
    return np.multiply.accumulate(factors)


class Strings:
    """Hashes of any substring of some bytes."""

    def __init__(self, data: np.ndarray, which: int):
        base = _BASES[which]
        count = len(data) + 1
        self.down = _powers(pow(base, -1, 1 << 64), count)
        self.sums = np.zeros(count, np.uint64)
        np.cumsum(_BYTES[which][data] * _powers(base, count)[:-1], out=self.sums[1:])

    def at(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    binary = texts.cast(pa.large_binary())
    bounds = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = np.frombuffer(binary.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def _keys(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    import xxhash

    digests = [xxhash.xxh3_128_digest(data[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
    both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def parsed(data: np.ndarray, bounds: np.ndarray, first: Strings) -> tuple[np.ndarray, ...]:
    """Blocks of the windows of some texts: text, boundary, first and last window start, class."""
    sums = first.sums[TRIGGER:] - first.sums[:-TRIGGER] if len(data) >= TRIGGER else first.sums[:0]
    hits = np.flatnonzero(mixed(sums * first.down[: len(sums)] + np.uint64(TRIGGER)) % np.uint64(PERIOD) == 0)
    text = np.searchsorted(bounds, hits, side="right") - 1
    inside = hits + TRIGGER <= bounds[text + 1]
    hits, text = hits[inside], text[inside]
    low, last = bounds[text], bounds[text + 1] - LENGTH
    before = np.where(np.diff(text, prepend=-1) == 0, np.roll(hits, 1), -1)
    start = np.maximum.reduce([before + 1, low, hits + TRIGGER - LENGTH])
    found = []
    ranges = [(a, b, 0, c) for a, b, c in CONTEXTS] + [(CONTEXTS[-1][1] + 1, LENGTH, CONTEXTS[-1][1], TRIGGER)]
    for least, most, left, right in ranges:
        i0, i1 = np.maximum(start, hits - most), np.minimum(hits - least, last)
        some = np.flatnonzero(i0 <= i1)
        at = hits[some]
        found.append((text[some], at, i0[some], i1[some], mixed(first.at(at - left, at + right) + np.uint64(most))))
    done = [np.concatenate(x) for x in zip(*found)]
    covered = np.zeros(len(data) + 1, np.int64)
    np.add.at(covered, done[2], 1)
    np.add.at(covered, done[3] + 1, -1)
    room = np.zeros(len(data) + 1, np.int64)
    long = np.diff(bounds) >= LENGTH
    np.add.at(room, bounds[:-1][long], 1)
    np.add.at(room, bounds[1:][long] - LENGTH + 1, -1)
    free = np.flatnonzero((np.cumsum(room) > 0) & (np.cumsum(covered) == 0))
    alone = (np.searchsorted(bounds, free, side="right") - 1, free, free, free)
    alone += (mixed(first.at(free, free + LENGTH) + np.uint64(1)),)
    return tuple(np.concatenate(x) for x in zip(done, alone))


def contents(second: Strings, at: np.ndarray, i0: np.ndarray, i1: np.ndarray) -> np.ndarray:
    """Hashes of the bytes of blocks or parts and of where their windows are about the boundary."""
    return mixed(second.at(i0, i1 + LENGTH) + (at - i0).astype(np.uint64) * np.uint64(LENGTH))


def parts(first: Strings, text: np.ndarray, at: np.ndarray, i0: np.ndarray, i1: np.ndarray) -> tuple[np.ndarray, ...]:
    """The parts of some blocks, in the form of blocks."""
    least = (at - i1) // PART
    counts = (at - i0) // PART - least + 1
    step = ragged(least, counts)
    text, at, i0, i1 = (np.repeat(x, counts) for x in (text, at, i0, i1))
    high = at - step * PART
    low = high - PART + 1
    kind = mixed(first.at(high, low + LENGTH) + mixed(step.astype(np.uint64) + np.uint64(1)))
    return text, at, np.maximum(i0, low), np.minimum(i1, high), kind


def _counted(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows and how often each occurs."""
    order = np.lexsort(columns[::-1])
    ordered = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in ordered:
        new[1:] |= c[1:] != c[:-1]
    heads = np.flatnonzero(new)
    return [c[heads] for c in ordered], np.diff(np.append(heads, len(order)))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _rows(owner: Sequence[str]) -> tuple[str, pa.Schema]:
    """Rows of blocks, parts or windows: class, content, the text they are in, how often it has them."""
    names = ("kind", "content", *owner, "n")
    return ", ".join(f"{c} bigint" for c in names), pa.schema([(c, pa.int64()) for c in names])


def class_rows(docs: DataFrame) -> DataFrame:
    """The classes of the blocks of some texts and how often these have them."""
    shape = pa.schema([("kind", pa.int64()), ("n", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches, "text", _SLICE):
            data, bounds = _bytes_of(texts)
            (kind,), n = _counted(parsed(data, bounds, Strings(data, 0))[-1])
            yield table(shape, [_signed(kind), n])

    return _texts(docs).where(F.octet_length("text") >= LENGTH).mapInArrow(rows, "kind bigint, n bigint")


def bits_of(keys: DataFrame, column: str, most: int = FILTER_BITS) -> Broadcast:
    """One bit per well mixed 64-bit key, 16 bits or more a key up to ``most``, broadcast."""
    rows, count = keys.count(), _BITMAP
    while count < min(16 * rows, most):
        count *= 2
    place = F.col(column).bitwiseAND(F.lit(count - 1))
    found = keys.groupBy(F.shiftright(place, 15).alias("bucket")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(F.lit(_BITMAP - 1))).alias("bits")
    )
    bits = np.zeros((count // _BITMAP, _BITMAP // 8), np.uint8)
    for row in found.toLocalIterator():
        bits[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits.reshape(-1))


def perhaps(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys have their bit: all that were given, and some others."""
    at = keys.view(np.uint64) & np.uint64(8 * len(bits) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def block_rows(docs: DataFrame, twice: Broadcast) -> DataFrame:
    """Blocks of every text, of the classes that have their bit: kind, content, the text's key k1, k2,
    and how often it has the block."""
    shape, arrow = _rows(["k1", "k2"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches, "text", _SLICE):
            data, bounds = _bytes_of(texts)
            found = parsed(data, bounds, Strings(data, 0))
            text, at, i0, i1, kind = (x[perhaps(twice.value, found[-1])] for x in found)
            if len(text) == 0:
                continue
            (text, kind, content), n = _counted(text, kind, contents(Strings(data, 1), at, i0, i1))
            k1, k2 = _keys(data, bounds)
            yield table(arrow, [_signed(kind), _signed(content), k1[text], k2[text], n])

    return _texts(docs).where(F.octet_length("text") >= LENGTH).mapInArrow(rows, shape)


def repeats_by_text(rows: DataFrame, *owner: str) -> DataFrame:
    """For each text the contents in classes that occur twice or more: ``whole`` those of classes that
    are equal throughout, ``open`` the others."""
    classes = rows.groupBy("kind").agg(
        F.sum("n").alias("total"), F.min("content").alias("low"), F.max("content").alias("high")
    )
    twice = classes.where("total > 1").select("kind", (F.col("low") == F.col("high")).alias("whole"))
    return rows.select("kind", "content", *owner).join(twice, "kind").groupBy(*owner).agg(
        F.collect_set(F.when(F.col("whole"), F.col("content"))).alias("whole"),
        F.collect_set(F.when(~F.col("whole"), F.col("content"))).alias("open"),
    )


def _open_parts(batch: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray) -> tuple:
    """Hashes of the texts, their blocks that repeat as a whole, and the parts of their open ones."""
    first, second = Strings(data, 0), Strings(data, 1)
    text, at, i0, i1, _ = parsed(data, bounds, first)
    content = contents(second, at, i0, i1)
    whole = _listed(text, content, batch.column("whole"))
    some = _listed(text, content, batch.column("open"))
    return first, second, (i0[whole], i1[whole]), parts(first, text[some], at[some], i0[some], i1[some])


def part_rows(texts: DataFrame) -> DataFrame:
    """The parts of blocks that differ within their class, as rows like those of blocks."""
    shape, arrow = _rows(["place"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in text_slices(batches, "text", _SLICE):
            _, second, _, (text, at, i0, i1, kind) = _open_parts(batch, *_bytes_of(values))
            (text, kind, content), n = _counted(text, kind, contents(second, at, i0, i1))
            yield table(arrow, [_signed(kind), _signed(content), batch.column("place").to_numpy()[text], n])

    some = texts.where(F.size("open") > 0).select("place", "text", "whole", "open")
    return some.mapInArrow(rows, shape)


def window_rows(texts: DataFrame) -> DataFrame:
    """The windows in parts that differ within their class, as rows like those of blocks."""
    shape, arrow = _rows(["place"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in text_slices(batches, "text", _SLICE):
            first, second, _, (text, at, i0, i1, _) = _open_parts(batch, *_bytes_of(values))
            here = _listed(text, contents(second, at, i0, i1), batch.column("open_parts"))
            lengths = (i1 - i0 + 1)[here]
            at = ragged(i0[here], lengths)
            one, two = (hashes.at(at, at + LENGTH) for hashes in (first, second))
            (text, one, two), n = _counted(np.repeat(text[here], lengths), one, two)
            yield table(arrow, [_signed(one), _signed(two), batch.column("place").to_numpy()[text], n])

    some = texts.where(F.size("open_parts") > 0).select("place", "text", "whole", "open", "open_parts")
    return some.mapInArrow(rows, shape)


def _listed(text: np.ndarray, content: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which blocks are in the list of their text."""
    filled = lists.fill_null([]) if lists.null_count else lists
    bounds, values = list_bounds(filled), filled.flatten().to_numpy().view(np.uint64)
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    salt = np.uint64(0x9E3779B97F4A7C15)
    return np.isin(content + mixed(text.astype(np.uint64)) * salt, values + mixed(owner) * salt)


def _kept(docs: DataFrame, texts: Broadcast) -> DataFrame:
    """doc_id and text of the rows whose key has its bit, with the key, k1 and k2."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in text_slices(batches, "text", _SLICE):
            k1, k2 = _keys(*_bytes_of(values))
            found = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(k1), pa.array(k2)], names=["doc_id", "text", "k1", "k2"]
            )
            yield found.filter(pa.array(perhaps(texts.value, k1)))

    return docs.mapInArrow(key, "doc_id bigint, text string, k1 bigint, k2 bigint")


def _no_longs(column: str) -> Column:
    return F.coalesce(F.col(column), F.array().cast("array<bigint>")).alias(column)


def _texts_with_repeats(docs: DataFrame) -> tuple[Broadcast, DataFrame]:
    """The bits of the keys of texts with repeated blocks, and the rows that have them, with ``place``, a
    number of their own, and the blocks that are ``whole`` or ``open``."""
    counted = class_rows(docs).groupBy("kind").agg(F.sum("n").alias("total"))
    twice = stored(counted.where("total > 1").select("kind"), "block-classes")
    blocks = stored(block_rows(docs, bits_of(twice, "kind")), "blocks")
    found = stored(repeats_by_text(blocks, "k1", "k2"), "block-repeats")
    keys = bits_of(found, "k1")
    joined = _kept(docs, keys).join(found, ["k1", "k2"], "left").select(
        "doc_id", "text", _no_longs("whole"), _no_longs("open"), F.monotonically_increasing_id().alias("place")
    )
    return keys, stored(joined, "texts-with-repeats")


def _repeated_parts(texts: DataFrame) -> DataFrame:
    """The rows with their parts that repeat as a whole, ``whole_parts``, those to be told apart,
    ``open_parts``, and the repeated ``windows`` of these."""
    rows = stored(part_rows(texts), "parts")
    found = stored(repeats_by_text(rows, "place").toDF("place", "whole_parts", "open_parts"), "part-repeats")
    opened = texts.join(found.where(F.size("open_parts") > 0).drop("whole_parts"), "place")
    windows = stored(window_rows(opened), "windows")
    # A window's class is its hash; of two windows in one class that differ neither counts.
    same = windows.groupBy("kind", "content").agg(F.sum("n").alias("total")).where("total > 1")
    single = windows.join(same.drop("total"), ["kind", "content"]).groupBy("place").agg(
        F.collect_set("content").alias("windows")
    )
    lists = found.join(single, "place", "left")
    return texts.join(lists, "place", "left").select(
        "doc_id", "text", "whole", "open", *[_no_longs(c) for c in ("whole_parts", "open_parts", "windows")]
    )


_SHAPE = "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<bigint>"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("kept", pa.binary())]
    + [(c, pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")]
    + [("spans", pa.list_(pa.int64()))]
)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, the remaining bytes, and n_bytes, n_removed, n_spans, spans of every row."""
    chosen = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    keys, texts = _texts_with_repeats(chosen)

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in text_slices(batches, "text", _SLICE):
            data, bounds = _bytes_of(values)
            rest = pa.array(~perhaps(keys.value, _keys(data, bounds)[0]))
            here = batch.filter(rest)
            sizes = pa.array(np.diff(bounds)).filter(rest)
            zeros = np.zeros(len(sizes), np.int64)
            kept = here.column("text").cast(pa.binary())
            yield table(_ARROW, [here.column("doc_id"), kept, sizes, zeros, zeros, [[]] * len(sizes)])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in text_slices(batches, "text", _SLICE):
            data, bounds = _bytes_of(values)
            _, second, (low, high), (text, at, i0, i1, _) = _open_parts(batch, data, bounds)
            content = contents(second, at, i0, i1)
            whole, part = (_listed(text, content, batch.column(c)) for c in ("whole_parts", "open_parts"))
            lengths = (i1 - i0 + 1)[part]
            at = ragged(i0[part], lengths)
            owner = np.repeat(text[part], lengths)
            single = at[_listed(owner, second.at(at, at + LENGTH), batch.column("windows"))]
            change = np.zeros(len(data) + 1, np.int64)
            np.add.at(change, np.concatenate([low, i0[whole], single]), 1)
            np.add.at(change, np.concatenate([high, i1[whole], single]) + LENGTH, -1)
            gone = np.cumsum(change)[:-1] > 0
            columns: list[list] = [[] for _ in range(5)]
            for a, b in zip(bounds[:-1], bounds[1:]):
                mask = gone[a:b]
                edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
                for column, value in zip(
                    columns, (data[a:b][~mask].tobytes(), b - a, int(mask.sum()), len(edges) // 2, edges)
                ):
                    column.append(value)
            yield table(_ARROW, [batch.column("doc_id"), *columns])

    others = chosen.mapInArrow(leave, _SHAPE)
    return others.union(_repeated_parts(texts).mapInArrow(remove, _SHAPE))


def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def digest(kept: bytes) -> str:
    return hashlib.sha256(kept).hexdigest()
