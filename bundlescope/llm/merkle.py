"""A Merkle manifest of a dataset, kept as a postorder append log.

Rows of one tree (a language, say) are its leaves in ascending order. Every two
consecutive nodes of a level become their parent; a node left over at the end of a
level becomes a parent alone. Nodes are logged in the order in which they are
complete, so a node stands right after its subtree. Its position follows from the
sizes of the subtrees before it: a node of level l whose last leaf is number e
(from 1) comes after all nodes that end before e, which are
``2 * (e - 1) - popcount(e - 1)``, and after the l nodes that end at e below it. A
proof addresses its siblings by these positions alone; no node holds a pointer.

The log is built in layers of aligned blocks of 2 ** ``BLOCK_LEVELS`` nodes. A
builder takes one block, logs its nodes and hands its last node to the layer above,
where these are leaves again, until each tree has one node left. A block's log is
one row. Nodes and rows come to builders and proofs one by one, in order, behind the
log of their block; neither holds more than one block of a tree at once,
and a tree that holds most rows is spread over as many builders as it has blocks.
The driver sees the number of layers only.

A leaf is the hex sha256 of its row's fields, each ``-`` if null, else the length in
bytes, a colon and the value. Nulls: any column may be null; a null tree is a tree
of its own, a null key comes first. Rows with equal keys are ordered by their leaf;
repeated rows are leaves of their own, and as they are equal it does not matter
which comes first. An empty table has no trees and no root. Long texts are hashed
where they are read and never moved. Columns other than those named are not looked
at, so they may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.llm.arrow import stored, table
from bundlescope.operators.batching import number_rows
from bundlescope.operators.joins import lookup_join

BLOCK_LEVELS = 10
_SIZE = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def position(level: int, index: int, leaves: int) -> int:
    """Where the log of a tree with so many leaves has a node, from 0."""
    before = min((index + 1) << level, leaves) - 1
    return 2 * before - before.bit_count() + level


def height(leaves: int) -> int:
    """The level of the last node left."""
    return max(0, leaves - 1).bit_length()


def parent(children: bytes) -> bytes:
    """The digest of one or two digests, which are hashed as lowercase hex text."""
    return hashlib.sha256(children.hex().encode()).digest()


def block_log(units: bytes, levels: int) -> bytes:
    """All nodes over consecutive digests up to the node of ``levels``, in completion order."""
    out = bytearray()
    waiting: list[bytes] = [b""] * (levels + 1)
    count = len(units) // _SIZE
    for n in range(count):
        node, level = units[n * _SIZE : (n + 1) * _SIZE], 0
        out += node
        last = n + 1 == count
        while level < levels and (waiting[level] or last):
            node, waiting[level] = parent(waiting[level] + node), b""
            level += 1
            out += node
        waiting[level] = node
    return bytes(out)


def siblings(log: bytes, index: int, leaves: int, levels: int) -> bytes:
    """The digests beside the path from a leaf of a block's log up to ``levels``, lowest first."""
    out = bytearray()
    for level in range(levels):
        beside = (index >> level) ^ 1
        if beside << level < leaves:
            at = position(level, beside, leaves) * _SIZE
            out += log[at : at + _SIZE]
    return bytes(out)


def folded(leaf: bytes, proof: bytes, index: int, leaves: int) -> bytes:
    """The root that a leaf and its proof give."""
    node = leaf
    for level in range(height(leaves)):
        at = index >> level
        if (at ^ 1) << level < leaves:
            beside, proof = proof[:_SIZE], proof[_SIZE:]
            node = parent(beside + node if at & 1 else node + beside)
        else:
            node = parent(node)
    return node


def row_digest(fields: Sequence[Column]) -> Column:
    """The hex sha256 of a row's fields with their lengths."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def numbered(leaves: DataFrame, key: str) -> DataFrame:
    """Rows tree, digest and others with ``index``, their place in their tree, and its ``leaves``.

    The whole table is numbered by tree and key over range partitions; equal rows may
    be cut anywhere.
    """
    names = leaves.columns
    mixed = leaves.withColumn("_cut", F.rand(20240607))
    rows = number_rows(mixed, *dict.fromkeys(["tree", key, "digest", "_cut"]), name="_row")
    trees = rows.groupBy(F.col("tree").alias("_tree")).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("leaves")
    )
    found = rows.join(trees, F.col("tree").eqNullSafe(F.col("_tree")))
    return found.select(*names, (F.col("_row") - F.col("_first")).alias("index"), "leaves")


@dataclass(frozen=True)
class Manifest:
    """Layers of block logs, one row per block, and each tree's root (binary) and leaves."""

    layers: list[DataFrame]
    roots: DataFrame
    block_levels: int


_LOG = "tree string, block bigint, n bigint, levels int, leaves bigint, log binary, top binary"
_LOG_ARROW = pa.schema(
    [
        ("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("levels", pa.int32()),
        ("leaves", pa.int64()), ("log", pa.binary()), ("top", pa.binary()),
    ]
)


def _in_blocks(rows: DataFrame, block_levels: int) -> DataFrame:
    """Rows of tree and index with ``block``, all of a block in one partition in ascending order; a
    row without index, whose block is known, comes first."""
    block = F.coalesce("block", F.expr(f"shiftright(index, {block_levels})"))
    return rows.withColumn("block", block).repartition("tree", "block").sortWithinPartitions(
        "tree", "block", F.asc_nulls_first("index")
    )


def _logged(units: DataFrame, block_levels: int) -> DataFrame:
    """One row per aligned block of tree, index, digest (binary), units (in the layer), leaves."""
    names = ("tree", "block", "units", "leaves")

    def log(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digests = None, []

        def done() -> pa.RecordBatch:
            tree, number, of_layer, leaves = last
            levels = min(block_levels, height(of_layer))
            nodes = block_log(b"".join(digests), levels)
            row = (tree, number, len(digests), levels, leaves, nodes, nodes[-_SIZE:])
            return table(_LOG_ARROW, [[x] for x in row])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*names, "digest")]
            for *block, digest in zip(*columns):
                if block != last:
                    if digests:
                        yield done()
                    last, digests = block, []
                digests.append(digest)
        if digests:
            yield done()

    rows = units.withColumn("block", F.lit(None).cast("bigint"))
    return _in_blocks(rows, block_levels).select(*names, "digest").mapInArrow(log, _LOG)


def build(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of rows tree (not null), index, digest (hex) and leaves (of the tree)."""
    units = leaves.select(
        "tree", "index", F.unhex("digest").alias("digest"), F.col("leaves").alias("units"), "leaves"
    )
    layers: list[DataFrame] = []
    roots: DataFrame | None = None
    while True:
        layers.append(stored(_logged(units, block_levels), f"merkle-layer{len(layers)}"))
        of_layer = F.expr(f"shiftright(leaves - 1, {block_levels * len(layers)}) + 1").alias("units")
        tops = layers[-1].select(
            "tree", F.col("block").alias("index"), F.col("top").alias("digest"), of_layer, "leaves"
        )
        done = tops.where("units = 1").select("tree", F.col("digest").alias("root"), "leaves")
        roots = done if roots is None else roots.union(done)
        units = tops.where("units > 1")
        if units.isEmpty():
            return Manifest(layers, roots, block_levels)


def proofs(manifest: Manifest, asked: DataFrame) -> DataFrame:
    """The asked leaves with all their columns and their ``proof``, siblings lowest first.

    ``asked`` has tree and index, each leaf at most once, besides any other columns.
    """
    levels, above = manifest.block_levels, None
    for below, layer in reversed(list(zip(manifest.layers, manifest.layers[1:]))):
        each = below.select("tree", F.col("block").alias("index"))
        above = _proved(layer, above, each, levels).select("tree", "index", "proof")
    return _proved(manifest.layers[0], above, asked, levels)


def _proved(layer: DataFrame, above: DataFrame | None, asked: DataFrame, block_levels: int) -> DataFrame:
    """The asked rows with the siblings in their block and above it, one by one behind its log."""
    logs = layer.select("tree", "block", "n", "levels", "log")
    if above is None:
        logs = logs.withColumn("path", F.lit(b""))
    else:
        upper = above.select(F.col("tree").alias("_tree"), F.col("index").alias("_index"), "proof")
        same = (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_index"))
        path = F.coalesce("proof", F.lit(b"")).alias("path")
        logs = logs.join(upper, same, "left").select("tree", "block", "n", "levels", "log", path)
    named = F.struct(*[F.col(f"`{c}`") for c in asked.columns if c != "tree"])
    rows = asked.select("tree", F.col("index").cast("bigint").alias("index"), named.alias("row"))
    kind = rows.schema["row"].dataType
    mask = (1 << block_levels) - 1

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, log = None, ()
        for batch in batches:
            places, proof = [], []
            parts = [batch.column(c) for c in ("n", "levels", "log", "path")]
            keys = [batch.column(c).to_pylist() for c in ("tree", "block", "index")]
            for at, (tree, number, index) in enumerate(zip(*keys)):
                if index is None:
                    block, log = (tree, number), [part[at].as_py() for part in parts]
                elif (tree, number) == block:
                    leaves, levels, nodes, path = log
                    places.append(at)
                    proof.append(siblings(nodes, index & mask, leaves, levels) + path)
            found = batch.select(["tree", "row"]).take(pa.array(places, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*found.columns, pa.array(proof, pa.binary())], names=["tree", "row", "proof"]
            )

    together = _in_blocks(logs.unionByName(rows, allowMissingColumns=True), block_levels)
    done = together.mapInArrow(prove, f"tree string, row {kind.simpleString()}, proof binary")
    return done.select("tree", "row.*", "proof")


def tree_name(column: str) -> Column:
    """A tree's name that is never null and sorts as the column does, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


@dataclass(frozen=True)
class Dataset:
    """Proved leaves: the rows' columns, tree, index, leaves, digest, proof, and of their
    tree's root among the roots subroot, top_index, top_leaves and top_proof."""

    rows: DataFrame
    root: str | None


def dataset_manifest(rows: DataFrame, by: str, key: str, block_levels: int = BLOCK_LEVELS) -> Dataset:
    """Trees of the rows by one column, their roots as the leaves of one more tree.

    ``rows`` has ``digest``, a leaf in hex, and any columns to keep.
    """
    leaves = stored(numbered(rows.withColumn("tree", tree_name(by)), key), "merkle-leaves")
    trees = build(leaves, block_levels)
    subroots = trees.roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.lower(F.hex("root")).alias("digest")
    )
    tops = stored(numbered(subroots, "name"), "merkle-subroots")
    top = build(tops, block_levels)
    root = top.roots.select(F.lower(F.hex("root")).alias("root")).first()
    above = proofs(top, tops).select(
        F.col("name").alias("top_name"), F.col("digest").alias("subroot"), F.col("index").alias("top_index"),
        F.col("leaves").alias("top_leaves"), F.col("proof").alias("top_proof"),
    )
    found = lookup_join(proofs(trees, leaves), stored(above, "merkle-tops"), "tree", "top_name")
    return Dataset(found.drop("top_name"), root["root"] if root else None)


def with_folded_root(rows: DataFrame, leaf: str) -> DataFrame:
    """``folded_root``: the root that the hex digest in a column and the row's proofs give."""
    used = [leaf, "index", "leaves", "proof", "top_index", "top_leaves", "top_proof"]
    columns = rows.columns

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = []
            for digest, at, n, proof, top_at, top_n, top in zip(*(batch.column(c).to_pylist() for c in used)):
                subroot = folded(bytes.fromhex(digest), proof, at, n)
                roots.append(folded(subroot, top, top_at, top_n).hex())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(roots, pa.string())], names=[*columns, "folded_root"]
            )

    shape = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(fold, f"{shape}, folded_root string")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one_more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    tampered = [one_more if c == "n_chars" else F.col(c) for c in FIELDS]
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaf = row_digest([F.col(c) for c in FIELDS])
    rows = docs.select("doc_id", "lang", leaf.alias("digest"), F.when(changed, row_digest(tampered)).alias("other"))
    made = dataset_manifest(rows.withColumn("claimed", F.coalesce("other", "digest")).drop("other"), "lang", "doc_id")
    proof = F.lower(F.hex(F.concat("proof", "top_proof")))
    found = with_folded_root(made.rows, "claimed")
    return found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(made.root).cast("string").alias("root"),
        F.sha2(proof, 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.lit(made.root).cast("string")).alias("verified"),
    )


OP13_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS before,
    coalesce(strlen(text) || ':' || text, '-') AS after,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 7 = 0 AS changed
  FROM documents),
h AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS idx,
    sha256(before || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || after) AS leaf,
    CASE WHEN changed THEN
      sha256(before || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || after)
    END AS other FROM d),
low AS (
  SELECT coalesce('=' || lang, '') AS tree, 0 AS lvl, idx, leaf AS node, count(*) OVER (PARTITION BY lang) AS n FROM h
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, sha256(string_agg(node, '' ORDER BY idx)), (n + 1) // 2
  FROM low WHERE n > 1 GROUP BY tree, lvl, idx // 2, n),
subroots AS (
  SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS idx, lvl AS height FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, idx, node, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, sha256(string_agg(node, '' ORDER BY idx)), (n + 1) // 2
  FROM high WHERE n > 1 GROUP BY lvl, idx // 2, n),
nodes AS (
  SELECT tree, lvl, idx, node FROM low WHERE n > 1
  UNION ALL SELECT 'top', lvl, idx, node FROM high WHERE n > 1),
walk AS (
  SELECT doc_id, coalesce('=' || lang, '') AS own, 'low' AS part, 0 AS lvl, idx, coalesce(other, leaf) AS node,
    '' AS proof, leaf FROM h
  UNION ALL
  SELECT w.doc_id, w.own, w.part, w.lvl + 1, w.idx // 2,
    CASE WHEN s.node IS NULL THEN sha256(w.node) WHEN w.idx % 2 = 0 THEN sha256(w.node || s.node)
      ELSE sha256(s.node || w.node) END,
    w.proof || coalesce(s.node, ''), w.leaf
  FROM walk w JOIN subroots r ON r.tree = w.own AND w.lvl < r.height
    LEFT JOIN nodes s ON s.tree = w.own AND s.lvl = w.lvl AND s.idx = xor(w.idx, 1)),
upper AS (
  SELECT w.doc_id, w.leaf, r.node AS subroot, 0 AS lvl, r.idx, w.node, w.proof
  FROM walk w JOIN subroots r ON r.tree = w.own AND w.lvl = r.height
  UNION ALL
  SELECT u.doc_id, u.leaf, u.subroot, u.lvl + 1, u.idx // 2,
    CASE WHEN s.node IS NULL THEN sha256(u.node) WHEN u.idx % 2 = 0 THEN sha256(u.node || s.node)
      ELSE sha256(s.node || u.node) END,
    u.proof || coalesce(s.node, '')
  FROM upper u JOIN (SELECT max(lvl) AS height FROM high) t ON u.lvl < t.height
    LEFT JOIN nodes s ON s.tree = 'top' AND s.lvl = u.lvl AND s.idx = xor(u.idx, 1))
SELECT doc_id, leaf, subroot, root.node AS root, sha256(proof) AS proof_sha256, u.node AS folded_root,
  u.node = root.node AS verified
FROM upper u JOIN (SELECT node, lvl FROM high WHERE n = 1) root ON u.lvl = root.lvl
"""
