"""Near duplicates by HyperMinHash.

A text's set is its distinct word shingles. Its sketch has one register per hash
function: the smallest hash, kept as its leading-zero count and the ten bits
after the first one bit. Bands of registers bring together texts that may be
alike; the share of equal registers, corrected for registers that are equal by
chance, estimates their similarity; what may pass is confirmed on the full sets.

Texts with equal sets are one class from the start. Within a band's bucket no
list of pairs is made: each class is first held against the smallest classes of its
buckets, at most one per bucket, and of those that seem alike against three. What that
links needs no more comparing. In buckets that still hold several components, the members
outside the bucket's largest component are held against the others, but only where they
share a rare shingle. Shingles are put in ascending order of the open classes that hold
them; two sets alike enough have one in common among the first n - ceil(tn) + 1 of each
(t is the limit, n a set's size), and the first one they share stands so early in both
that enough shingles follow. So near copies of a text that share its words but not each
other's changes seldom meet. Those that meet are paired only if the parities of their
shingles in 1024 places differ in no more places than the sets may differ in shingles.
None of this loses a pair that the limit would link: every pair of classes that share a
bucket is in one component already, is compared, or is below the limit. With 32 bands
of 5 registers a pair at 0.85 is
in no common bucket 7 times in 10^9, at 0.8 3 times in 10^6. An estimate more than
``MARGIN`` = 6 standard errors below the limit drops a pair unconfirmed; computed from
the binomial, a pair exactly at a limit of 0.85 is lost that way 2.3 times in 10^8, at
one of 0.8 1.4 times in 10^8, and more alike pairs less often.

Nulls: a null or wordless text has an empty set and is linked with nothing; a
null document id is linked with nothing and kept. Rows that repeat a document id
are one document with several texts. An empty table gives no rows. Other columns
are not looked at, and stay in ``without_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bundlescope.llm.arrow import (
    mixed,
    run_hashes,
    stored,
    table,
    text_slices,
    word_hashes,
    words_of,
)
from bundlescope.llm.components import components
from bundlescope.operators.joins import perhaps_listed

WORDS = 5
PERCENT = 80
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
MARGIN = 6.0
CENTERS = 3
#: 64-bit words of a set's parities.
PARITY_WORDS = 16
_PARITIES = [f"p{k}" for k in range(PARITY_WORDS)]
_MULTIPLIERS = np.random.default_rng(20240607).integers(0, 1 << 31, REGISTERS, np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles."""
    flat, bounds = words_of(pc.ascii_lower(texts))
    hashes = word_hashes(flat)
    runs = run_hashes(hashes, words)
    for start, stop in zip(bounds[:-1], bounds[1:]):
        if stop - start >= words:
            yield np.unique(runs[start : stop - words + 1])
        else:
            yield run_hashes(hashes[start:stop], stop - start) if stop > start else runs[:0]


def registers(shingles: np.ndarray) -> np.ndarray:
    """The compressed register of each hash function."""
    keys = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(keys), 2048):
        hashed = keys[k : k + 2048][None, :] * _MULTIPLIERS[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    # The exponent of the float is the place of the first one bit, and with it the leading zeros.
    place = np.frexp(least.astype(np.float64))[1].astype(np.int64)
    rest = least.astype(np.int64) - np.where(place > 0, 1 << np.maximum(place - 1, 0), 0)
    shift = place - 1 - MANTISSA
    mantissa = np.where(shift >= 0, rest >> np.maximum(shift, 0), rest << np.maximum(-shift, 0))
    return ((32 - place) << MANTISSA | mantissa).astype("<u2")


def chance_of_equal_registers() -> float:
    """How often registers of two disjoint sets of like size are equal."""
    n, total = 1000.0, 0.0
    for zeros in range(32):
        edges = 2.0 ** -(zeros + 1) * (1 + np.arange((1 << MANTISSA) + 1) / (1 << MANTISSA))
        total += float((np.diff(-np.exp(-n * edges)) ** 2).sum())
    return total


_CHANCE = chance_of_equal_registers()


def estimated(equal: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal registers, corrected for chance."""
    return np.clip((equal - _CHANCE) / (1 - _CHANCE), 0, 1)


_SKETCH = "doc_id bigint, n_shingles bigint, set_key binary, registers binary"
_SKETCH_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_key", pa.binary()),
        ("registers", pa.binary()),
    ]
)


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Size, 128-bit hash and registers of every row's shingle set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch, texts in text_slices(batches, "text"):
            sets = list(shingle_sets(texts, words))
            yield table(
                _SKETCH_ARROW,
                [
                    batch.column("doc_id"),
                    [len(s) for s in sets],
                    [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                    [registers(s).tobytes() if len(s) else None for s in sets],
                ],
            )

    return _chosen(docs).mapInArrow(sketch, _SKETCH)


def _chosen(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))


def band_keys(classes: DataFrame) -> DataFrame:
    """One row per class and band: band (a hash of its number and registers), node, n."""
    arrow = pa.schema([("band", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _register_matrix(batch.column("registers")).reshape(-1, BANDS, ROWS)
            keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(found), 1))
            for k in range(ROWS):
                keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + found[:, :, k])
            nodes = batch.column("node").to_numpy()
            sizes = batch.column("n").to_numpy()
            yield table(
                arrow,
                [keys.reshape(-1).view(np.int64), np.repeat(nodes, BANDS), np.repeat(sizes, BANDS)],
            )

    return classes.select("node", "n", "registers").mapInArrow(
        bands, "band bigint, node bigint, n bigint"
    )


def _register_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


def promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b whose estimate is not more than MARGIN standard errors below the limit."""
    limit = percent / 100
    least = limit - MARGIN * np.sqrt(limit * (1 - limit) / REGISTERS)
    known = classes.select("node", "registers")
    rows = pairs.join(known.toDF("a", "ra"), "a").join(known.toDF("b", "rb"), "b")
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            equal = _register_matrix(batch.column("ra")) == _register_matrix(batch.column("rb"))
            ok = pa.array(estimated(equal.mean(axis=1)) >= least)
            yield table(arrow, [batch.column("a").filter(ok), batch.column("b").filter(ok)])

    return rows.select("a", "b", "ra", "rb").mapInArrow(compare, "a bigint, b bigint")


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs a, b whose full sets are alike enough."""
    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    arrow = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "text"):
            sets = [s.view(np.int64) for s in shingle_sets(texts, words)]
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], schema=arrow)

    sets = stored(_texts_of(docs, ends).mapInArrow(whole, "node bigint, shingles array<bigint>"), "shingles")
    rows = pairs.join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a")
    common = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    sizes = F.size("sa").cast("bigint") + F.size("sb")
    alike = F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("sizes") - F.col("common"))
    counted = rows.select("a", "b", common.alias("common"), sizes.alias("sizes"))
    return counted.where(alike).select("a", "b")


def _texts_of(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """The rows of the documents in ``ends``; texts of others are left where they are."""
    ends = stored(ends, "wanted")
    near = perhaps_listed(_chosen(docs), ends, "doc_id", ends.count())
    return near.join(ends, "doc_id", "left_semi")


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each place whether an odd number of the shingles falls there. Where two sets'
    parities differ, the sets do, so they differ in as many shingles at least."""
    bits = PARITY_WORDS * 64
    odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def rare_shingles(docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """node, n, token, place (from 1) and parities of the shingles by which the nodes' sets
    can be alike.

    Shingles that no other set of the nodes has come first and are left out, since nothing
    meets there.
    """
    arrow = pa.schema([("part", pa.int64()), ("token", pa.int64())])
    sketch = pa.schema(
        [("part", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), *((w, pa.int64()) for w in _PARITIES)]
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int], list[np.ndarray]]]:
        """Nodes, a hash of each node and set, and the sets of some texts."""
        import xxhash

        for batch, texts in text_slices(batches, "text"):
            nodes, found = batch.column("doc_id").to_pylist(), list(shingle_sets(texts, words))
            parts = [xxhash.xxh3_64_intdigest(f.tobytes(), d & (1 << 64) - 1) >> 1 for d, f in zip(nodes, found)]
            yield nodes, parts, found

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts, found in sets(batches):
            owner = np.repeat(np.array(parts, np.int64), [len(f) for f in found])
            yield table(arrow, [owner, np.concatenate(found).view(np.int64)])

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, parts, found in sets(batches):
            sizes = [len(f) for f in found]
            yield table(sketch, [parts, nodes, sizes, *np.stack([parities(f) for f in found]).T])

    texts = stored(_texts_of(docs, nodes.select(F.col("node").alias("doc_id"))), "open-texts")
    held = stored(texts.mapInArrow(tokens, "part bigint, token bigint"), "open-shingles")
    shape = ", ".join(f"{name} bigint" for name in sketch.names)
    signed = stored(texts.mapInArrow(signs, shape).distinct(), "open-sets")
    often = stored(
        held.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"), "common-shingles"
    )
    of_set = Window.partitionBy("part")
    order = F.row_number().over(of_set.orderBy("sets", "token")).alias("order")
    common = held.join(often, "token").select("part", "token", order, F.count(F.lit(1)).over(of_set).alias("common"))
    place = F.col("n") - F.col("common") + F.col("order")
    longest = F.col("n") - F.expr(f"({percent} * n + 99) div 100") + 1
    return common.join(signed, "part").where(place <= longest).select(
        "node", "n", "token", place.alias("place"), *_PARITIES
    )


def near_duplicate_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    rows = stored(sketches(docs, words), "sketches")
    filled = rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = stored(
        filled.groupBy("set_key").agg(
            F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"), F.min("registers").alias("registers")
        ),
        "classes",
    )
    bands = stored(band_keys(classes), "bands")
    buckets = bands.groupBy("band").agg(F.min("node").alias("center"), F.max("node").alias("_last"))
    shared = stored(
        bands.join(buckets.where("center <> _last").drop("_last"), "band"), "buckets"
    )
    starred = shared.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    alike = promising(starred, classes, percent).groupBy("b").agg(F.array_sort(F.collect_set("a")).alias("a"))
    first = alike.select(F.explode(F.slice("a", 1, CENTERS)).alias("a"), "b")
    links = stored(confirmed(stored(first, "stars"), docs, words, percent), "links")
    found = components(links)
    apart = _apart(_open_buckets(shared, found), docs, words, percent)
    more = stored(promising(apart, classes, percent), "apart")
    if not more.isEmpty():
        found = components(links.union(confirmed(more, docs, words, percent)))
    nodes = classes.select("set_key", F.col("node").alias("_class"))
    named = found.select(F.col("node").alias("_class"), F.col("component").alias("_component"))
    known = nodes.join(named, "_class", "left").select(
        "set_key", F.coalesce("_component", "_class").alias("_component")
    )
    joined = rows.drop("registers").join(known, "set_key", "left")
    linked = F.when(F.col("n_shingles") > 0, F.col("_component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(linked, F.col("doc_id")))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _open_buckets(shared: DataFrame, found: DataFrame) -> DataFrame:
    """band, node, component and the bucket's largest component ``main``, where there are several."""
    members = stored(
        shared.join(found, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component")),
        "members",
    )
    parts = members.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size"))
    main = parts.groupBy("band").agg(
        F.max(F.struct("size", "component"))["component"].alias("main"), F.count(F.lit(1)).alias("parts")
    )
    return stored(members.join(main.where("parts > 1"), "band").drop("parts"), "open-buckets")


def _apart(open_buckets: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs of classes in open buckets and different components that can be alike enough."""
    outside = F.max(F.col("component") != F.col("main"))
    nodes = stored(
        open_buckets.groupBy("node").agg(F.max("component").alias("component"), outside.alias("outside")),
        "open-classes",
    )
    rare = stored(rare_shingles(docs, nodes, words, percent).join(nodes, "node"), "rare-shingles")
    one = rare.where("outside").select(
        F.col("token").alias("_token"), F.col("node").alias("x"), F.col("n").alias("nx"),
        F.col("component").alias("cx"), F.col("place").alias("px"), *[F.col(w).alias(f"_{w}") for w in _PARITIES],
    )
    other = rare.select(
        "token", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("component").alias("cy"),
        F.col("place").alias("py"), "outside", *_PARITIES,
    )
    once = ~F.col("outside") | (F.col("x") < F.col("y"))
    sizes = F.lit(100) * F.least("nx", "ny") >= F.lit(percent) * F.greatest("nx", "ny")
    common = F.expr(f"({percent} * (nx + ny) + {99 + percent}) div {100 + percent}")
    early = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")) + 1 >= common
    different = [F.bit_count(F.col(w).bitwiseXOR(F.col(f"_{w}"))) for w in _PARITIES]
    differ = sum(different[1:], different[0]) <= F.col("nx") + F.col("ny") - 2 * common
    matches = (F.col("_token") == F.col("token")) & (F.col("cx") != F.col("cy")) & once & sizes & early & differ
    pairs = one.join(other, matches)
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def without_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near duplicates, with all its columns."""
    gone = near_duplicate_components(docs, words, percent).where(~F.col("kept"))
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicate_components(docs, words=3, percent=85)
