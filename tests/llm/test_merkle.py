import hashlib
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as driver
from bundlescope.llm import merkle

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        low = out[-1]
        out.append([sha("".join(low[n : n + 2])) for n in range(0, len(low), 2)])
    return out


def beside(levels, index):
    found = []
    for level in levels[:-1]:
        other = index ^ 1
        found += [level[other]] if other < len(level) else []
        index //= 2
    return found


def leaf_of(row, more=0):
    out = ""
    for name in merkle.FIELDS:
        value = row[name]
        if name == "n_chars" and value is not None:
            value += more
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return sha(out)


def plain(rows):
    """doc_id, leaf, subroot, root and proof of every row, in tree order."""
    trees = defaultdict(list)
    for row in rows:
        trees[(row["lang"] is not None, (row["lang"] or "").encode())].append(row)
    names = sorted(trees)
    made = []
    for name in names:
        held = sorted(trees[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        made.append((held, levels_of([leaf_of(r) for r in held])))
    top = levels_of([levels[-1][0] for _, levels in made])
    for number, (held, levels) in enumerate(made):
        for n, row in enumerate(held):
            proof = beside(levels, n) + beside(top, number)
            yield row["doc_id"], levels[0][n], levels[-1][0], top[-1][0], sha("".join(proof))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 5))
def test_log_positions_are_those_of_completion(count, block_levels):
    units = [hashlib.sha256(bytes([n % 256, n // 256])).digest() for n in range(count)]
    levels = merkle.height(count)
    log = merkle.block_log(b"".join(units), levels)
    plain_levels = levels_of([u.hex() for u in units])
    assert len(log) // 32 == sum(map(len, plain_levels))
    for level, nodes in enumerate(plain_levels):
        for n, node in enumerate(nodes):
            at = merkle.position(level, n, count) * 32
            assert log[at : at + 32].hex() == node
    for n, unit in enumerate(units):
        proof = merkle.siblings(log, n, count, levels)
        assert proof.hex() == "".join(beside(plain_levels, n))
        assert merkle.folded(unit, proof, n, count).hex() == plain_levels[-1][0]


@pytest.mark.parametrize("block_levels", [1, 2, 10])
def test_manifest_equals_plain_trees(spark, block_levels):
    rows = [
        (n, "same" if n % 4 else None, ["en", "de", None, "en", "ü", "", "en"][n % 7], "s" if n % 5 else None, None if n % 11 == 0 else n)
        for n in range(61)
    ] + [(None, "x", "en", "s", 1), (None, "y", "en", "s", 1), (3, "y", "en", "s", 1), (3, "y", "en", "s", 1), (9, "one", "fr", "s", 2)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    leaf = merkle.row_digest([F.col(c) for c in merkle.FIELDS])
    made = merkle.dataset_manifest(docs.withColumn("digest", leaf).drop("text"), "lang", "doc_id", block_levels)
    found = merkle.with_folded_root(made.rows, "digest").collect()
    got = sorted(
        ((r.doc_id, r.digest, r.subroot, made.root, sha((r.proof + r.top_proof).hex())) for r in found), key=repr
    )
    names = ("doc_id", "text", "lang", "source", "n_chars")
    assert got == sorted(plain([dict(zip(names, r)) for r in rows]), key=repr)
    assert {r.folded_root for r in found} == {made.root}


def test_rows_reach_builders_one_by_one(spark):
    """Blocks go on across batches of a few rows, and no row holds a list of a block's leaves."""
    rows = [(n, "t", ["en", "de", "en", None][n % 4], "s", n) for n in range(150)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    most = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(most)
    spark.conf.set(most, "7")
    try:
        leaf = merkle.row_digest([F.col(c) for c in merkle.FIELDS])
        made = merkle.dataset_manifest(docs.withColumn("digest", leaf), "lang", "doc_id", 4)
        found = merkle.with_folded_root(made.rows, "digest").collect()
        units = made.rows.select("tree", "index", F.unhex("digest").alias("digest"), F.col("leaves").alias("units"), "leaves")
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (made.rows, merkle._logged(units, 4))]
    finally:
        spark.conf.set(most, before)
    got = sorted(((r.doc_id, r.digest, r.subroot, made.root, sha((r.proof + r.top_proof).hex())) for r in found), key=repr)
    names = ("doc_id", "text", "lang", "source", "n_chars")
    assert got == sorted(plain([dict(zip(names, r)) for r in rows]), key=repr)
    assert {r.folded_root for r in found} == {made.root}
    for plan in plans:
        assert "MapInArrow" in plan and "collect_list" not in plan


def test_tampering_shows(spark):
    rows = [(n, "t", "en", "s", n) for n in range(30)]
    docs = spark.createDataFrame(rows, DOCS)
    leaf = merkle.row_digest([F.col(c) for c in merkle.FIELDS])
    bad = F.when(F.col("doc_id") == 7, F.sha2(F.lit("x"), 256)).otherwise(F.col("digest"))
    made = merkle.dataset_manifest(docs.withColumn("digest", leaf).withColumn("claimed", bad), "lang", "doc_id", 2)
    folded = {r.doc_id: r.folded_root for r in merkle.with_folded_root(made.rows, "claimed").collect()}
    assert {n for n, root in folded.items() if root != made.root} == {7}


def test_empty_table_has_no_root(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert merkle.op13_merkle_manifest(spark, str(tmp_path)).collect() == []


def test_query_on_odd_rows(spark, tmp_path):
    """Nulls anywhere, an empty and a long text, columns named like the operator's own."""
    rows = [(None, None, None, None, None), (1, "", "", "", 0), (2, "x" * 2_000_000, "en", "s", 5), (8, "é", "en", None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumns(
        {c: F.lit("mine") for c in ("tree", "index", "leaves", "digest", "proof", "a.b", "log", "subroot", "_row")}
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r)[:5]: (r.verified, r.doc_id) for r in merkle.op13_merkle_manifest(spark, str(tmp_path)).collect()}
    names = ("doc_id", "text", "lang", "source", "n_chars")
    assert set(got) == set(plain([dict(zip(names, r)) for r in rows]))
    for verified, doc in got.values():
        tampered = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and doc != 8
        assert verified is not tampered


def test_matches_sql(spark, duck):
    frame = driver.queries()["op13_merkle_manifest"](spark, "/root/testdata/sf0.001")
    cursor = duck.execute(driver.oracle_sql()["op13_merkle_manifest"])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    want = sorted(cursor.fetchall())
    assert len(want) == 200
    assert sorted(tuple(r) for r in frame.select(*names).collect()) == want
