"""Benchmark decontamination by latent semantic retrieval.

Words are lower-cased, without outer punctuation. Of every whole text the words
that occur in the benchmark at all are stored with their places; no other word
counts for any of what follows, and texts are not read again. Passages are 32
words, every 16 words; benchmark items are cut the same way.

Terms are weighted by the cube of the logarithm of their inverse frequency in
segments of 16 words. The latent space is the range of a randomised SVD of all weighted
passages: the sum of A'A times a random matrix, orthonormalised. What each task adds up
has the size of the benchmark's vocabulary, and the sums are added by
blocks of terms. Cosines do not depend on the directions of the axes in the space, so no further rotation is
made. Every passage is compared with all benchmark passages in it, and is a candidate
for those at a cosine of ``MIN_COSINE``, whatever the lengths of the vectors. Around each
candidate the longest common subsequence of words with the whole item is found,
and whether the item's answer, its last words, is there. A document leaks an item
at ``MIN_LCS`` of the item's words, or at ``MIN_LCS_ANSWERED`` with the whole answer.

A benchmark of more than ``MAX_ITEM_WORDS`` words is searched in blocks of items, of about
half as many words each, so that a task holds one block at a time; every block takes a pass
over the documents.
Nulls: a null text is empty and neither leaks nor is leaked; rows without
document id keep null in the result, and ``without_leaks`` judges each of them by its
own text. Repeated rows give one row per item. Empty
tables give no rows. Other columns are not looked at, and stay in ``without_leaks``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.llm.arrow import list_bounds, ragged, set_apart, stored, table, text_slices, words_of

RANK = 96
STEP = 16
BLOCK = 1024
MIN_COSINE = 0.4
MIN_LCS = 0.6
MIN_LCS_ANSWERED = 0.5
ANSWER_WORDS = 5
MAX_TERMS = 64_000
MAX_ITEM_WORDS = 1_000_000
_OUTER = ".,;:!?\"'()[]{}*#$%&|<>-_"


def located(texts: pa.Array, known: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms of known words, their places among the words of their text, and the texts' bounds."""
    return located_and_counted(texts, known)[:3]


def located_and_counted(texts: pa.Array, known: dict[str, int]) -> tuple[np.ndarray, ...]:
    """The same, and each text's number of words. Words of punctuation alone are no words."""
    flat, bounds = words_of(texts)
    if len(flat) == 0:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), bounds, np.diff(bounds)
    coded = flat.dictionary_encode()
    plain = pc.utf8_trim(pc.utf8_lower(coded.dictionary), _OUTER)
    at = pc.fill_null(pc.index_in(plain, value_set=pa.array(known, plain.type)), len(known)).to_numpy()
    numbers = np.append(np.fromiter(known.values(), np.int32, len(known)), np.int32(-1))[at]
    numbers[pc.equal(plain, "").to_numpy(zero_copy_only=False)] = -2
    terms = numbers[coded.indices.to_numpy()]
    real = np.concatenate([[0], np.cumsum(terms != -2)])
    hits = np.flatnonzero(terms >= 0)
    text = np.searchsorted(bounds, hits, side="right") - 1
    places = (real[hits] - real[bounds[text]]).astype(np.int32)
    return terms[hits], places, np.searchsorted(hits, bounds), np.diff(real[bounds])


class Passages:
    """The weighted terms of some texts by segments of STEP words that hold any."""

    def __init__(self, terms: np.ndarray, places: np.ndarray, bounds: np.ndarray, weights: np.ndarray):
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        some = np.flatnonzero(weights[terms] > 0)
        self.terms, text = terms[some], text[some]
        self.weights = weights[self.terms]
        keys = text.astype(np.int64) << 32 | (places[some] // STEP)
        self.heads = np.flatnonzero(np.diff(keys, prepend=-1))
        self.keys = keys[self.heads]

    def sums(self, vectors: np.ndarray) -> np.ndarray:
        """The sum of the vectors of each segment's terms, of which it has at most STEP."""
        lengths = np.diff(np.append(self.heads, len(self.terms)))
        order = np.argsort(-lengths, kind="stable")
        heads, ordered = self.heads[order], -lengths[order]
        added = vectors[self.terms[heads]]
        for k in range(1, -ordered[0]):
            longer = np.searchsorted(ordered, -k)
            added[:longer] += vectors[self.terms[heads[:longer] + k]]
        out = np.empty_like(added)
        out[order] = added
        return out

    def vectors(self, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A vector for each segment together with the next, its text and its first place."""
        if not len(self.heads):
            return np.zeros((0, RANK), np.float32), self.keys, self.keys
        sums = self.sums(space)
        joined = sums.copy()
        joined[:-1] += np.where((np.diff(self.keys) == 1)[:, None], sums[1:], 0)
        return joined, self.keys >> 32, (self.keys & 0xFFFFFFFF) * STEP


def frequencies(terms: np.ndarray, places: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """In how many segments each term is."""
    text = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))
    segment = np.cumsum(np.diff(text << 32 | places // STEP, prepend=-1) != 0)
    return np.bincount(np.unique(segment * size + terms) % size, minlength=size)


def inverse_frequencies(frequency: np.ndarray, segments: int) -> np.ndarray:
    """The cubes of the logarithms: what sets items apart is in their rare terms."""
    share = np.maximum(frequency, 1) / max(2, segments + 1)
    return (-np.log(share)).astype(np.float32) ** 3


def sketch_sums(found: Passages, omega: np.ndarray) -> np.ndarray:
    """A'A times a random matrix, over the segments of some texts."""
    out = np.zeros(omega.shape, np.float32)
    if not len(found.heads):
        return out
    weights = np.zeros(len(omega), np.float32)
    weights[found.terms] = found.weights
    lengths = np.diff(np.append(found.heads, len(found.terms)))
    projected = found.sums(weights[:, None] * omega)
    projected /= np.add.reduceat(found.weights**2, found.heads)[:, None]
    order = np.argsort(found.terms, kind="stable")
    ordered, segment = found.terms[order], np.repeat(np.arange(len(lengths)), lengths)[order]
    edges = np.flatnonzero(np.diff(ordered, prepend=-1))
    out[ordered[edges]] = np.add.reduceat(projected[segment], edges, axis=0)
    return weights[:, None] * out


def random_matrix(size: int) -> np.ndarray:
    return np.random.default_rng(11).standard_normal((size, RANK), np.float32)


def latent_space(sketch: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted term vectors in the latent space."""
    basis, _ = np.linalg.qr(sketch.astype(np.float64))
    out = np.zeros((len(sketch), RANK), np.float32)
    out[:, : basis.shape[1]] = weights[:, None] * basis
    return out


def common_subsequence(item: dict[int, int], length: int, words: list[int]) -> int:
    """Words in the longest common subsequence; ``item`` has the places of each word as bits."""
    row, full = 0, (1 << length) - 1
    for word in words:
        here = row | item.get(word, 0)
        row = here & ~(here - ((row << 1) | 1)) & full
    return row.bit_count()


class Benchmark:
    """The items: their terms, and the vectors of their passages once there is a space."""

    def __init__(self, rows: list[dict]):
        self.ids = [r["item_id"] for r in rows]
        texts = pa.array([r["text"] for r in rows], pa.large_string())
        flat, _ = words_of(texts)
        plain = set(pc.utf8_trim(pc.utf8_lower(flat), _OUTER).to_pylist()) - {""}
        self.known = {w: n for n, w in enumerate(sorted(plain))}
        self.terms, self.places, self.bounds = located(texts, self.known)
        self.words = [self.terms[a:b].tolist() for a, b in zip(self.bounds[:-1], self.bounds[1:])]
        self.bits = []
        for words in self.words:
            bits: dict[int, int] = defaultdict(int)
            for k, w in enumerate(words):
                bits[w] |= 1 << k
            self.bits.append(dict(bits))
        self.counts = [{w: places.bit_count() for w, places in bits.items()} for bits in self.bits]
        self.lengths = np.array([len(words) for words in self.words], np.int64)

    def passages(self, weights: np.ndarray) -> Passages:
        return Passages(self.terms, self.places, self.bounds, weights)

    def place(self, space: np.ndarray, weights: np.ndarray) -> None:
        vectors, self.owner, self.starts = self.passages(weights).vectors(space)
        self.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)

    def verified(self, item: int, terms: np.ndarray, places: np.ndarray) -> tuple[float, bool, bool]:
        """Share of the item's words in common order, whether the answer is there, and the verdict."""
        words, region, counts = self.words[item], terms.tolist(), self.counts[item]
        # No common subsequence has more words than the item has of those in the region.
        most = sum(map(counts.__getitem__, counts.keys() & set(region)))
        if most / len(words) < MIN_LCS_ANSWERED:
            return most / len(words), False, False
        share = common_subsequence(self.bits[item], len(words), region) / len(words)
        if share < MIN_LCS_ANSWERED:
            return share, False, False
        answer = words[-ANSWER_WORDS:]
        n = len(answer)
        answered = any(
            region[k : k + n] == answer and places[k + n - 1] - places[k] == n - 1
            for k in range(len(region) - n + 1)
        )
        return share, answered, share >= MIN_LCS or answered


def candidates(found: Passages, space: np.ndarray, bench: Benchmark) -> np.ndarray:
    """Rows of text, item and the place where the item would begin, one per pair of passages."""
    vectors, text, start = found.vectors(space)
    norms = np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)
    rows = [np.zeros((0, 3), np.int64)]
    for first in range(0, len(vectors), 4096):
        part = slice(first, first + 4096)
        dots = vectors[part] @ bench.vectors.T
        some = np.flatnonzero(dots.max(axis=1, initial=-1) >= MIN_COSINE * norms[part])
        passage, query = np.nonzero(dots[some] >= MIN_COSINE * norms[first + some, None])
        at = first + some[passage]
        rows.append(np.stack([text[at], bench.owner[query], start[at] - bench.starts[query]], axis=1))
    return np.concatenate(rows)


def _cut(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of regions whose sizes come to some MAX_TERMS."""
    if sizes.sum() < MAX_TERMS:
        yield slice(None)
        return
    heads = np.flatnonzero(np.diff(np.cumsum(sizes) // MAX_TERMS, prepend=-1))
    for first, end in zip(heads, np.append(heads[1:], len(sizes))):
        yield slice(first, end)


def holding_enough(item: np.ndarray, low: np.ndarray, high: np.ndarray, terms: np.ndarray, bench: Benchmark) -> np.ndarray:
    """Item, low and high of the regions, each once, that hold MIN_LCS_ANSWERED of their item's words.

    Counted are the item's places whose word is in the region. No common subsequence has more
    words than that, so no other region can leak.
    """
    order = np.argsort(item, kind="stable")
    heads = np.flatnonzero(np.diff(item[order], prepend=-1))
    size = len(terms) + 1
    local = np.zeros(len(bench.known), np.int32)
    kept = [np.zeros((0, 3), np.int64)]
    for some in np.split(order, heads[1:]) if len(order) else []:
        here = item[some[0]]
        counts, enough = bench.counts[here], MIN_LCS_ANSWERED * bench.lengths[here]
        words = list(counts)
        local[words] = np.arange(1, len(words) + 1)
        regions = np.unique(low[some] * size + high[some])
        first, end = regions // size, regions % size
        if (end - first).sum() > size:  # long items: first those with enough places, which takes no time for each region
            places = np.concatenate([[0], np.cumsum(local[terms] > 0)])
            enough_places = places[end] - places[first] >= enough
            first, end = first[enough_places], end[enough_places]
        lengths, times = end - first, np.array([0, *counts.values()], np.float32)
        for part in _cut(lengths + len(words)):
            present = np.zeros((len(lengths[part]), len(times)), bool)
            found = local[terms[ragged(first[part], lengths[part])]]
            present[np.repeat(np.arange(len(present)), lengths[part]), found] = True
            good = np.flatnonzero(present @ times >= enough)
            if len(good):
                kept.append(np.stack([np.full(len(good), here), first[part][good], end[part][good]], axis=1))
        local[words] = 0
    return np.concatenate(kept)


def leaks_in(
    terms: np.ndarray, places: np.ndarray, bounds: np.ndarray, weights: np.ndarray, space: np.ndarray, bench: Benchmark
) -> list[tuple[int, int, float, bool]]:
    """(text, item, share, answered) of every item that a text leaks, the best place of each."""
    best: dict[tuple[int, int], tuple[float, bool]] = {}
    found = candidates(Passages(terms, places, bounds, weights), space, bench)
    text, item, begin = found.T
    lengths = bench.lengths[item]
    slack = STEP + lengths // 4
    located = np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds)) << 32 | places
    low = np.searchsorted(located, text << 32 | np.maximum(begin - slack, 0))
    high = np.searchsorted(located, text << 32 | begin + lengths + slack)
    regions = holding_enough(item, low, high, terms, bench)
    owner = np.searchsorted(bounds, regions[:, 1], side="right") - 1
    for t, (i, a, b) in zip(owner.tolist(), regions.tolist()):
        share, answered, leaked = bench.verified(i, terms[a:b], places[a:b])
        if leaked:
            best[t, i] = max(best.get((t, i), (0.0, False)), (share, answered))
    return [(t, i, *found) for (t, i), found in sorted(best.items())]


_LOCATED = "doc_id bigint, text_key binary, n_words bigint, terms array<int>, places array<int>"


def _text_key() -> Column:
    """What tells rows without document id apart: their text."""
    return F.when(F.col("doc_id").isNull(), F.unhex(F.sha2(F.col("text").cast("string").cast("binary"), 256)))


def _located_rows(docs: DataFrame, known: dict[str, int]) -> DataFrame:
    lists = pa.list_(pa.int32())
    arrow = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.binary()), ("n_words", pa.int64()), ("terms", lists), ("places", lists)]
    )
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            terms, places, bounds, words = located_and_counted(texts, shared.value)
            offsets = pa.array(bounds.astype(np.int32))
            yield table(
                arrow,
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    words,
                    pa.ListArray.from_arrays(offsets, pa.array(terms)),
                    pa.ListArray.from_arrays(offsets, pa.array(places)),
                ],
            )

    chosen = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), _text_key().alias("text_key"), F.col("text").cast("string")
    )
    return chosen.mapInArrow(rows, _LOCATED)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most MAX_TERMS terms, or of one text that has more."""
    for batch in batches:
        bounds, start = list_bounds(batch.column("terms")), 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + MAX_TERMS, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    terms, places = batch.column("terms"), batch.column("places")
    return terms.flatten().to_numpy(), places.flatten().to_numpy(), list_bounds(terms)


def summed(rows: DataFrame, size: int, width: int, kind: str, measure) -> np.ndarray:
    """The sum over all rows of ``measure(terms, places, bounds)``, size x width numbers.

    Each task sends its sum in blocks of terms; a block's parts are added in one
    task each, as many as there were tasks. The driver gets size x width numbers.
    """
    arrow, shape = pa.schema([("block", pa.int32()), ("part", pa.binary())]), "block int, part binary"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in _slices(batches):
            part = measure(*_arrays(batch)).reshape(size, width)
            if total is None:
                total = part
            else:
                total += part
        if total is not None:
            cut = range(0, size, BLOCK)
            yield table(arrow, [[k // BLOCK for k in cut], [total[k : k + BLOCK].astype(kind).tobytes() for k in cut]])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(*(c.to_pylist() for c in batch.columns)):
                totals[block] = totals.get(block, 0) + np.frombuffer(part, kind)
        if totals:
            yield table(arrow, [list(totals), [x.tobytes() for x in totals.values()]])

    found = stored(rows.mapInArrow(sums, shape).repartition("block").mapInArrow(added, shape), "latent")
    out = np.zeros((size, width), kind)
    for r in found.collect():
        out[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.part, kind).reshape(-1, width)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_ITEM_WORDS) -> DataFrame:
    """doc_id, item_id, lcs and answered, a row per document and item it leaks."""
    best = F.max(F.struct("lcs", "answered")).alias("best")
    found = _leaking_texts(docs, benchmark, max_words).groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", "best.lcs", "best.answered")


def _leaking_texts(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_ITEM_WORDS) -> DataFrame:
    """doc_id, text_key (of rows without document id), item_id, lcs and answered."""
    items = benchmark.where(F.col("text").isNotNull() & (F.col("text") != "")).select("item_id", "text").distinct()
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    if words <= max_words:
        return _leaking_block(docs, items)
    blocks = 2 * words // max_words + 1
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = [stored(_leaking_block(docs, items.where(number == k)), "leaks") for k in range(blocks)]
    return reduce(DataFrame.union, found)


def _leaking_block(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The same for items that a task can hold."""
    bench = Benchmark([r.asDict() for r in items.collect()])
    size = max(1, len(bench.known))
    rows = stored(_located_rows(docs, bench.known), "located")
    segments = rows.agg(F.sum(F.ceil(F.col("n_words") / STEP))).first()[0] or 0
    frequency = summed(rows, size, 1, "int64", lambda *x: frequencies(*x, size))[:, 0]
    weights = inverse_frequencies(frequency, segments)
    omega = random_matrix(size)
    sketch = summed(rows, size, RANK, "float32", lambda *x: sketch_sums(Passages(*x, weights), omega))
    space = latent_space(sketch + sketch_sums(bench.passages(weights), omega), weights)
    bench.place(space, weights)
    shared = docs.sparkSession.sparkContext.broadcast((weights, space, bench))
    arrow = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_key", pa.binary()),
            ("item_id", pa.int64()),
            ("lcs", pa.float64()),
            ("answered", pa.bool_()),
        ]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = leaks_in(*_arrays(batch), *shared.value)
            at = pa.array([f[0] for f in found], pa.int64())
            ids = shared.value[2].ids
            yield table(
                arrow,
                [
                    batch.column("doc_id").take(at),
                    batch.column("text_key").take(at),
                    [ids[f[1]] for f in found],
                    [f[2] for f in found],
                    [f[3] for f in found],
                ],
            )

    return rows.mapInArrow(search, "doc_id bigint, text_key binary, item_id bigint, lcs double, answered boolean")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with all their columns."""
    docs, back = set_apart(docs, "doc_id", "text")
    found = _leaking_texts(docs, benchmark).select(F.col("doc_id").alias("_doc"), "text_key").distinct()
    found = stored(found, "leaking")
    kept = docs.join(found.where("_doc IS NOT NULL"), F.col("doc_id") == F.col("_doc"), "left_anti")
    texts = found.where("_doc IS NULL").select(F.col("text_key").alias("_key"))
    kept = kept.join(texts, _text_key() == F.col("_key"), "left_anti")
    return kept.select(*back)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    return leaks(docs, benchmark)
