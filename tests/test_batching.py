import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bundlescope import schemas
from bundlescope.operators import batching


def listed(spark, rows):
    return spark.createDataFrame(rows, schemas.UNKNOWN_APPS)


def test_threshold_is_strict_and_per_country(spark):
    df = listed(spark, [("a", 20), ("a", 21), ("a", 30), ("b", 20), ("b", 15), (None, 50)])
    got = {r["bundle"]: r["unique_ifa"] for r in batching.audiences(df).collect()}
    assert got == {"a": 51, None: 50}


def test_largest_first(spark):
    df = listed(spark, [("a", 9), ("b", 100), ("c", 100)])
    assert [r["bundle"] for r in batching.largest_first(df).collect()] == ["b", "c", "a"]


def test_pending_skips_what_is_done_and_keeps_null(spark):
    df = listed(spark, [("a", 1), ("b", 2), (None, 3)])
    done = spark.createDataFrame([("a",), ("a",), (None,)], "bundle string")
    assert {r["bundle"] for r in batching.pending(df, done).collect()} == {"b", None}
    empty = done.limit(0)
    assert batching.pending(df, empty).count() == 3


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    apps=st.sets(st.text(alphabet="abcz.0", max_size=6), max_size=60),
    with_null=st.booleans(),
    parts=st.integers(1, 5),
)
def test_numbers_equal_a_global_sort(spark, apps, with_null, parts):
    values = sorted(apps) if not with_null else [None, *sorted(apps)]
    df = listed(spark, [(b, 1) for b in reversed(values)]).repartition(parts)
    got = {r["bundle"]: (r["rn"], r["grp"]) for r in batching.batched(df, 7).collect()}
    assert got == {b: (n, (n + 6) // 7) for n, b in enumerate(values, 1)}


@pytest.mark.parametrize("rows,full", [(1500, 3), (1501, 3), (0, 0)])
def test_all_batches_full_but_the_last(spark, rows, full):
    df = listed(spark, [(f"app{n:05d}", n) for n in range(rows)])
    batches = batching.batched(df)
    sizes = [r["apps"] for r in batching.batch_summary(batches).orderBy("grp").collect()]
    assert sizes == [500] * full + ([rows % 500] if rows % 500 else [])
    assert batching.batch_count(batches).first()["batches"] == len(sizes)


def test_one_batch(spark):
    df = listed(spark, [(f"app{n:02d}", n) for n in range(25)])
    second = batching.one_batch(batching.batched(df, 10), 2)
    assert sorted(r["rn"] for r in second.collect()) == list(range(11, 21))
