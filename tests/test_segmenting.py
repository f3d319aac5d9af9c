from datetime import date

import pytest

from bundlescope import schemas
from bundlescope.functions.text import platform
from bundlescope.operators import joins, segmenting

RUN = ("20200101", "20200131", date(2020, 2, 1))


def results(spark, *rows):
    """(bundle, app_cat, unique_ifa) rows."""
    return spark.createDataFrame(
        [(b, n, None, None, ("url", "name", "text", c, "", "", "")) for b, c, n in rows],
        schemas.METADATA_RESULT,
    )


@pytest.fixture(scope="module")
def references(spark):
    ref_app = spark.createDataFrame(
        [("GAMES", "G", "Games", "Gamers"), ("TOOLS", "T", "Tools", "Phone"), ("TOOLS", "T2", "Tools", "Phone")],
        schemas.CATEGORY_REFERENCE,
    )
    ref_persona = spark.createDataFrame([("Gamers", "7")], schemas.PERSONA_REFERENCE)
    return ref_app, ref_persona


def test_platform(spark):
    ids = ["123", "com.a", "", "12a", "123\n", "١٢", None]
    df = spark.createDataFrame([(b,) for b in ids], "bundle string")
    got = [r[0] for r in df.select(platform("bundle")).collect()]
    assert got == ["IOS", "ANDROID", "ANDROID", "ANDROID", "ANDROID", "ANDROID", None]


def test_segmented_list(spark, references):
    df = results(
        spark, ("a", "games", 10.0), ("a", "games", 10.0), ("a", "games", 7.0), ("b", "tools", 5.0),
        ("c", "other", 3.0), ("d", None, 2.0), (None, "games", 1.0), ("1", "Games", 4.0),
    )
    got = segmenting.segmented_list(df, *references, *RUN)
    assert got.columns == schemas.MASTER_LIST.fieldNames()
    rows = got.collect()
    brief = sorted(
        ((r["bundle"], r["store_cat"], r["segment_grp_1"], r["segment_index"], r["ifa_cnt"]) for r in rows),
        key=repr,
    )
    assert brief == sorted(
        [
            ("a", "G", "Gamers", "7", 17.0),
            ("a", "G", "Gamers", "7", 17.0),
            ("b", "T", "Phone", None, 5.0),
            ("b", "T2", "Phone", None, 5.0),
            ("c", None, None, None, 3.0),
            ("d", None, None, None, 2.0),
            (None, "G", "Gamers", "7", None),
            ("1", "G", "Gamers", "7", 4.0),
        ],
        key=repr,
    )
    assert {(r["source"], r["last_update"], r["segment"]) for r in rows} == {
        ("20200101-20200131", "01/02/2020", "")
    }


def test_salted_and_broadcast_joins_agree(spark):
    left = spark.createDataFrame(
        [(k, n) for n in range(300) for k in (["hot", None, f"k{n}"])], "k string, n int"
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k5", 3), (None, 4)], "r string, v int")
    small = sorted(map(repr, joins.lookup_join(left, right, "k", "r").collect()))
    assert len(small) == 300 * 2 + 300 + 300
    large = joins.lookup_join(left, right, "k", "r", max_rows=0)
    assert sorted(map(repr, large.collect())) == small
    for hot_rows in (1, 7, 299, 300):
        salted = joins.salted_left_join(left, right, "k", "r", hot_rows)
        assert sorted(map(repr, salted.collect())) == small


def test_null_safe_salted_join(spark):
    left = spark.createDataFrame([(None, n) for n in range(20)] + [("a", 1)], "k string, n int")
    right = spark.createDataFrame([(None, 4)], "r string, v int")
    for hot_rows in (3, 100):
        got = joins.salted_left_join(left, right, "k", "r", hot_rows, null_safe=True)
        assert sorted((r["k"] or "-", r["v"]) for r in got.collect()) == [("-", 4)] * 20 + [("a", None)]


def test_a_hot_key_is_split_and_others_are_not(spark):
    left = spark.createDataFrame(
        [("hot", n) for n in range(1000)] + [(f"k{n}", n) for n in range(100)], "k string, n int"
    )
    right = spark.createDataFrame([("hot", 1), ("k1", 2)], "r string, v int")
    plan = joins.salted_left_join(left, right, "k", "r", 100)._jdf.queryExecution()
    assert "_salt" in plan.optimizedPlan().toString()
    got = joins.salted_left_join(left, right, "k", "r", 100)
    assert got.where("k = 'hot' and v = 1").count() == 1000
    assert got.where("v = 2").count() == 1 and got.count() == 1100


def test_broadcast_is_refused_by_rows_and_by_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 10, "t string")
    assert joins.fits_broadcast(df)
    assert not joins.fits_broadcast(df, max_rows=9)
    assert not joins.fits_broadcast(df, max_bytes=9000)
    assert joins.fits_broadcast(df.limit(0), max_rows=0)


def test_duplicate_keys(spark, references):
    got = joins.duplicate_keys(references[0], ["app_cat"]).collect()
    assert [tuple(r) for r in got] == [("TOOLS", 2)]


def test_distinct_values_counts_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "g string")
    assert segmenting.distinct_values(df, "g").first()[0] == 2
    assert segmenting.distinct_values(df.limit(0), "g").first()[0] == 0
