"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams.

Features are the distinct unigrams, bigrams and one- and two-word skip-grams of a
text, A-Z lower-cased and without outer punctuation, and unigrams cut to their
first 5 to 8 letters, for inflected words; all are hashed to 2^20 places.
Training takes at most ``max_rows`` labelled documents, the ones with the
smallest hashed ids, in one task: per-coordinate rates, and L1 keeps the weights
that are not zero to a few thousand, at most 2^20 floats, which every task gets.
Scoring reads every whole text.

Nulls: a null label is no label, a null text is empty and scored by the bias; a
document that is labelled more than once counts as toxic if one label says so. A
null id is never held out. Without any labelled row every score is one half. An
empty table gives no rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.llm.arrow import mixed, stored, table, text_slices, words_of

BITS = 20
MAX_ROWS = 12_000
EPOCHS = 5
BATCH = 16
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 1.0
LIMIT = 0.7
TOXIC_WEIGHT = 3.0
STEMS = (5, 6, 7, 8)
_OUTER = ".,;:!?\"'()[]{}*#$%&|<>-_"


def feature_lists(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All features of each text, repeated as often as they occur, and their bounds."""
    import xxhash

    flat, bounds = words_of(pc.ascii_lower(texts))
    if len(flat) == 0:
        return np.zeros(0, np.int32), bounds
    coded = flat.dictionary_encode()
    plain = pc.utf8_trim(coded.dictionary, _OUTER).to_pylist()
    at = coded.indices.to_numpy()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in plain], np.uint64)[at]
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    features, owners = [hashes], [owner]
    for length in STEMS:
        stems = [xxhash.xxh3_64_intdigest(w[:length], length) if len(w) >= length else 0 for w in plain]
        stemmed = np.array(stems, np.uint64)[at]
        long = np.flatnonzero(stemmed)
        features.append(stemmed[long])
        owners.append(owner[long])
    for gap in (1, 2, 3):
        pairs = mixed(hashes[:-gap] * np.uint64(0x9E3779B97F4A7C15) + hashes[gap:] + np.uint64(gap))
        inside = owner[: len(owner) - gap] == owner[gap:]
        features.append(pairs[inside])
        owners.append(owner[: len(owner) - gap][inside])
    order = np.argsort(np.concatenate(owners), kind="stable")
    places = (np.concatenate(features)[order] >> np.uint64(64 - BITS)).astype(np.int32)
    counts = np.bincount(np.concatenate(owners), minlength=len(bounds) - 1)
    return places, np.concatenate([[0], np.cumsum(counts)])


def ftrl(rows: list[np.ndarray], toxic: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The bias, the places whose weight is not zero, and their weights."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last place is the bias, without L1

    def weights(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == size, 0.0, L1)
        w = -(z[at] - np.sign(z[at]) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    for _ in range(EPOCHS):
        for first in range(0, len(rows), BATCH):
            part = [np.append(r, size) for r in rows[first : first + BATCH]]
            doc = np.repeat(np.arange(len(part)), [len(r) for r in part])
            at, where = np.unique(np.concatenate(part), return_inverse=True)
            w = weights(at)
            score = np.bincount(doc, w[where], minlength=len(part))
            error = 1 / (1 + np.exp(-np.clip(score, -35, 35))) - toxic[first : first + BATCH]
            error *= np.where(error < 0, TOXIC_WEIGHT, 1.0)
            gradient = np.bincount(where, error[doc], minlength=len(at))
            squares = np.bincount(where, (error * error)[doc], minlength=len(at))
            rate = (np.sqrt(n[at] + squares) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - rate * w
            n[at] += squares
    every = np.arange(size + 1)
    w = weights(every)
    places = np.flatnonzero(w[:size])
    return float(w[size]), places.astype(np.int32), w[places].astype(np.float32)


def held_out() -> F.Column:
    """Documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> dict:
    """bias, places and weights, learnt in one task from at most ``max_rows`` documents."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    one = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    shape = pa.schema([("toxic", pa.int32()), ("doc_id", pa.int64()), ("places", pa.list_(pa.int32()))])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            places, bounds = feature_lists(texts)
            lists = [np.unique(places[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            yield table(shape, [batch.column("toxic").cast(pa.int32()), batch.column("doc_id"), lists])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string")).join(
        chosen, "doc_id"
    )
    vectors = rows.select("doc_id", "text", "toxic").mapInArrow(
        features, "toxic int, doc_id bigint, places array<int>"
    )
    model = pa.schema(
        [("bias", pa.float64()), ("places", pa.list_(pa.int32())), ("weights", pa.list_(pa.float32()))]
    )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, toxic = [], []
        for batch in batches:
            lists += [np.asarray(x, np.int32) for x in batch.column("places").to_numpy(zero_copy_only=False)]
            toxic += batch.column("toxic").to_pylist()
        if lists:
            bias, places, weights = ftrl(lists, np.array(toxic, np.float64))
            yield table(model, [[bias], [places], [weights]])

    ordered = vectors.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    found = stored(
        ordered.mapInArrow(learn, "bias double, places array<int>, weights array<float>"), "toxicity"
    ).collect()
    if not found:
        return {"bias": 0.0, "places": [], "weights": []}
    return found[0].asDict()


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score of every row."""
    arrow = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    packed = docs.sparkSession.sparkContext.broadcast(
        (model["bias"], np.array(model["places"], np.int32), np.array(model["weights"], np.float32))
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, places, weights = packed.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[places] = weights
        for batch, texts in text_slices(batches, "text"):
            found, bounds = feature_lists(texts)
            told = np.flatnonzero(dense[found])
            owner = np.searchsorted(bounds, told, side="right") - 1
            pairs = np.unique(owner.astype(np.int64) << BITS | found[told])
            sums = np.bincount(pairs >> BITS, dense[pairs & ((1 << BITS) - 1)], minlength=batch.num_rows)
            yield table(
                arrow, [batch.column("doc_id"), 1 / (1 + np.exp(-np.clip(bias + sums, -35, 35)))]
            )

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    return chosen.mapInArrow(score, "doc_id bigint, score double")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    found = scored(docs, trained(docs, labels))
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted")
    )
