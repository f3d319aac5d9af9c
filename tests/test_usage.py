from bundlescope import schemas
from bundlescope.functions.dates import partition_days
from bundlescope.operators import usage

SCHEMA = "country string, date string, ifa string, app array<struct<bundle: string>>"


def sightings(spark, *rows):
    return spark.createDataFrame(
        [(c, d, i, None if a is None else [(b,) for b in a]) for c, d, i, a in rows], SCHEMA
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_missing_and_empty_lists_drop_the_device(spark):
    df = sightings(
        spark, ("MY", "20200101", "a", ["x", "y"]), ("MY", "20200101", "b", []),
        ("MY", "20200101", "c", None), ("MY", "20200101", "d", [None]),
    )
    assert rows(usage.device_apps(df)) == [("a", "x"), ("a", "y"), ("d", None)]


def test_null_devices_do_not_count_but_null_apps_group(spark):
    df = sightings(
        spark, ("MY", "20200101", "a", ["x", None]), ("MY", "20200102", "a", ["x"]),
        ("TH", "20200101", "a", ["x"]), ("MY", "20200101", None, ["x", "only-null"]),
    )
    counted = usage.unique_devices(usage.device_apps(df, "country"), "country", "bundle")
    assert rows(counted) == [
        ("MY", "only-null", 0), ("MY", "x", 1), ("MY", None, 1), ("TH", "x", 1),
    ]


def test_period_is_inclusive_and_country_selected(spark):
    df = sightings(
        spark, *[(c, d, "a", ["x"]) for c in ("MY", "SG") for d in ("20191231", "20200101", "20200103")]
    )
    kept = usage.in_period(df, "20200101", "20200103").select("country", "date")
    assert rows(kept) == [("MY", "20200101"), ("MY", "20200103")]


def test_partition_days():
    assert partition_days("20200228", "20200301") == ["20200228", "20200229", "20200301"]
    assert partition_days("20200301", "20200301") == ["20200301"]
    assert partition_days("20200302", "20200301") == []


def test_missing_partitions(spark):
    df = sightings(spark, ("MY", "20200101", "a", []), ("TH", "20200102", "a", []))
    missing = usage.missing_partitions(spark, df, "20200101", "20200102", ["MY", "TH"])
    assert rows(missing) == [("MY", "20200102"), ("TH", "20200101")]
    assert rows(usage.missing_partitions(spark, df, "20200103", "20200102")) == []


def test_apps_without_a_real_category_count_as_unknown(spark):
    known = spark.createDataFrame(
        [("x", "Finance"), ("x", "Games"), ("y", "Not Found"), ("z", ""), ("w", None), (None, "Games")],
        schemas.KNOWN_APPS,
    )
    assert rows(usage.categorised(known).select("bundle")) == [("x",), ("x",), (None,)]
    df = sightings(spark, ("MY", "20200101", "a", ["x", "y", "z", "w", None]))
    for limit in (0, 1000):
        unknown = usage.unknown_apps(df, known, max_rows=limit)
        assert unknown.columns == ["country", "bundle", "unique_ifa"]
        assert rows(unknown.select("bundle")) == [("w",), ("y",), ("z",), (None,)]


def test_unknown_and_known_are_disjoint_whatever_the_way(spark):
    df = sightings(
        spark, *[("MY", "20200101", f"d{n}", [f"b{n % 7}", "hot"]) for n in range(60)]
    )
    known = spark.createDataFrame([("b1", "Games"), ("hot", "Tools")], schemas.KNOWN_APPS)
    small, large = (rows(usage.unknown_apps(df, known, max_rows=m)) for m in (1000, 0))
    assert small == large
    assert not {"b1", "hot"} & {r[1] for r in small}
