from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as driver
from bundlescope.llm import whitening

VECTORS = "vec_id bigint, embedding array<float>"


def integers(vectors):
    found = []
    for vec in vectors:
        if vec and all(c is not None and np.isfinite(c) for c in vec):
            found.append([int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in vec])
    return found


def plain_covariance(listed):
    n, dims = len(listed), len(listed[0])
    means = [Fraction(sum(x[i] for x in listed), n) for i in range(dims)]
    centred = [[x[i] - means[i] for i in range(dims)] for x in listed]
    return np.array(
        [[float(sum(c[i] * c[j] for c in centred) / n) for j in range(dims)] for i in range(dims)]
    )


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**40), 2**40), min_size=3, max_size=3), min_size=1, max_size=12))
def test_polarisation_gives_the_covariance(listed):
    n, sums = len(listed), [sum(x[i] for x in listed) for i in range(3)]
    centres = [s // n for s in sums]
    found = dict(enumerate(whitening.squares(np.array(listed, np.int64) - np.array(centres))))
    got = whitening.covariance(n, sums, found, centres)
    assert np.array_equal(got, plain_covariance(listed))


def held_against_plain(rows, vectors):
    """rows of the query, vectors by id, against plain numpy and whole numbers."""
    kept = {k: x for k, v in vectors.items() for x in integers([v])}
    listed = sorted(map(list, {tuple(x) for x in kept.values()}))
    n, sums = len(listed), [sum(x[i] for x in listed) for i in range(len(listed[0]))]
    matrix = plain_covariance(listed)
    values, axes = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:16]
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == set(kept)
    signs = {}
    for vec_id, x in kept.items():
        centred = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)])
        for number, r in by[vec_id].items():
            k = order[number - 1]
            want = centred @ axes[:, k] / np.sqrt(values[k])
            if abs(want) > 1e-6:
                assert signs.setdefault(number, np.sign(want * r.whitened)) == np.sign(want * r.whitened)
            assert abs(abs(r.whitened) - abs(want)) < 1e-6
            assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(x, sums))
            assert r.explained == pytest.approx(values[k] / np.trace(matrix), rel=1e-9)
            assert r.identity_error < 1e-9
    return by


def test_query_equals_plain_whitening(spark):
    folder = "/root/testdata/sf0.001"
    rows = driver.queries()["op11_embedding_whitening"](spark, folder).collect()
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    by = held_against_plain(rows, {r.vec_id: list(r.embedding) for r in table})
    assert {len(v) for v in by.values()} == {16} and len(by) == len(table)


def test_odd_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    rows = [(n, [float(c) for c in rng.normal(size=4)]) for n in range(40)]
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [nan, 1.0, 1.0, 1.0]), (104, [1.0, -inf, 1.0, 1.0])]
    rows += [(200 + n, [0.5, 0.25, -0.5, 1.0]) for n in range(30)]
    df = spark.createDataFrame(rows, VECTORS).withColumns(
        {c: F.lit("mine") for c in ("x", "at", "total", "whitened", "component", "deviation", "a.b")}
    )
    df.union(df.where("vec_id = 3")).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = whitening.op11_embedding_whitening(spark, str(tmp_path)).collect()
    by = held_against_plain(got, dict(rows))
    assert {len(v) for v in by.values()} == {4}
    assert sum(r.vec_id == 3 for r in got) == 8 and len(got) == 4 * 71


def test_null_ids_and_no_spread(spark, tmp_path):
    rows = [(None, [1.0, 2.0]), (None, [3.0, 2.0]), (1, [2.0, 2.0])]
    spark.createDataFrame(rows, VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = whitening.op11_embedding_whitening(spark, str(tmp_path)).collect()
    assert len(got) == 3 and {r.component for r in got} == {1} and got[0].explained == 1.0
    one = integers([[1.0, 2.0]])
    model, error = whitening.fit(spark.createDataFrame([(1, one[0])] * 3, "vec_id bigint, x array<bigint>"))
    assert model.n == 1 and len(model.values) == 0 and error == 0.0


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([(1, None)], VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert whitening.op11_embedding_whitening(spark, str(tmp_path)).collect() == []


def test_several_lengths_and_large_entries_are_errors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], VECTORS)
    with pytest.raises(ValueError, match="several lengths"):
        whitening.fit(whitening.integer_vectors(df))
    large = spark.createDataFrame([(1, [1e30])], VECTORS)
    with pytest.raises(Exception, match="an entry is above"):
        whitening.integer_vectors(large).collect()


def test_exact_deviations_beyond_63_bits():
    model = whitening.Whitening(3, [7, 2**45], np.ones(2), np.eye(2), 2.0)
    x = np.array([[2**43, -(2**43)]])
    assert model.deviations(x) == [(3 * 2**43 - 7) ** 2 + (-3 * 2**43 - 2**45) ** 2]
