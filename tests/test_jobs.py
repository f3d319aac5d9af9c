"""The monthly steps over files, twice in a row."""

from datetime import date

import pytest

from bundlescope import schemas
from bundlescope.plans import jobs
from bundlescope.sources import device_store, files, parts, results, sightings, sinks, tables

MASTER, PERSONAS, VIEW = "jobs_master", "jobs_personas", "jobs_view"
SEEN, RESULTS, DEVICES = "jobs_seen", "jobs_results", "jobs_devices"
DAYS = ("20200101", "20200131")


@pytest.fixture
def catalog(spark, tmp_path):
    known = {"bundle": "com.known", "category": "Games", "segment_grp_1": "Gamers", "segment_index": "3"}
    row = tuple(known.get(n) for n in schemas.MASTER_LIST.fieldNames())
    master = spark.createDataFrame([row], schemas.MASTER_LIST)
    yield master
    tables.drop_view(spark, VIEW)
    for table in (MASTER, PERSONAS, SEEN, RESULTS, DEVICES):
        tables.drop_table(spark, table)


@pytest.mark.parametrize("kept", ["files", "tables"])
def test_two_months(spark, tmp_path, catalog, kept):
    """Both ways of keeping things: folders and one master list, or tables that grow."""
    growing = kept == "tables"
    if growing:
        parts.create_parts(catalog, MASTER, str(tmp_path / "master"), "0", parts=4)
    else:
        tables.publish_version(catalog, MASTER, str(tmp_path / "master"), "0")
    bucketed = {"results_table": RESULTS} if growing else {}
    place = {n: str(tmp_path / n) for n in ("seen", "unknown", "payloads", "results", "app", "persona", "list")}
    seen = spark.createDataFrame(
        [("MY", "20200105", f"d{n}", [("com.new",), ("123",), ("com.known",)]) for n in range(25)]
        + [("TH", "20200105", "d1", [("com.rare",)]), ("SG", "20200105", "d1", [("com.abroad",)])],
        "country string, date string, ifa string, app array<struct<bundle: string>>",
    )
    seen.write.partitionBy("country", "date").parquet(place["seen"])
    spark.createDataFrame(
        [
            ("com.new", None, '<h1 itemprop="name">chess</h1><a itemprop="genre" href="/c/fun">x</a>', None),
            ("123", '{"resultCount":1,"results":[{"trackName":"my bank","primaryGenreName":"Finance"}]}', None, None),
        ],
        schemas.PAYLOADS,
    ).write.json(place["payloads"])
    references = {
        "app": spark.createDataFrame(
            [("FUN", "F", "Game", "Entertainment Lover"), ("FINANCE", "M", "Finance", "Corporate Professional")],
            schemas.CATEGORY_REFERENCE,
        ),
        "persona": spark.createDataFrame([("Entertainment Lover", "5")], schemas.PERSONA_REFERENCE),
    }
    for name, df in references.items():
        sinks.write_csv(df, place[name])

    if growing:
        jobs.add_sightings(spark, SEEN, f"{place['seen']}/", [("MY", "20200105"), ("TH", "20200105")], sightings.KEYED)

    for month in (1, 2):
        seen_in = {"sightings_root": SEEN, "sightings_table": True} if growing else {"sightings_root": place["seen"]}
        jobs.list_unknown_apps(
            spark, master_table=MASTER, out=place["unknown"], start=DAYS[0], end=DAYS[1], **seen_in
        )
        listed = files.read_csv(spark, place["unknown"], schemas.UNKNOWN_APPS).collect()
        unknown = {r["bundle"]: r["unique_ifa"] for r in listed}
        # In the second month the apps found in the first one are known.
        assert unknown == ({"com.new": 25, "123": 25, "com.rare": 1} if month == 1 else {"com.rare": 1})

        for _ in range(2):
            more = bucketed | ({"buckets": 4} if growing else {})
            jobs.look_up_pending(spark, place["unknown"], place["payloads"], place["results"], **more)
        found = results.results_table(spark, RESULTS) if growing else files.read_results_so_far(spark, place["results"])
        assert found.count() == 2

        groups = jobs.segment_apps(
            spark, place["results"], place["app"], place["persona"], place["list"], *DAYS, date(2020, 2, 1), **bucketed
        )
        assert groups == 2
        if growing:
            changed = jobs.fold_list(spark, MASTER, place["list"], str(tmp_path / "master"), str(month))
            assert bool(changed) == (month == 1)
        else:
            jobs.clean_list(spark, MASTER, place["list"], str(tmp_path / "master"), str(month))
        jobs.publish_personas(spark, MASTER, PERSONAS, VIEW, str(tmp_path / "personas"), str(month))

        got = sorted(
            (r["bundle"], r["persona"], r["app_category"], str(r["ifa_cnt"])) for r in spark.table(VIEW).collect()
        )
        assert got == [
            ("123", "Budget Managers", "Finance", "25.0"),
            ("com.known", "Gamers", "Games", "None"),
            ("com.new", "Gamers", "Games", "25.0"),
        ]


def test_device_sets_of_two_months(spark, tmp_path, catalog):
    seen = spark.createDataFrame(
        [("MY", f"20200{m}05", f"d{n * m}", [("com.new",), ("123",)]) for m in (1, 2) for n in range(25)]
        + [("SG", "20200105", "d1", [("com.abroad",)])],
        "country string, date string, ifa string, app array<struct<bundle: string>>",
    )
    root, out = str(tmp_path / "seen"), str(tmp_path / "sets")
    seen.write.partitionBy("country", "date").parquet(root)
    for days in (DAYS, ("20200201", "20200229")):
        jobs.add_device_sets(spark, root, DEVICES, out, *days, buckets=2)
    both = device_store.unique_devices(spark, out, "20200101", "20200229", "country", "bundle")
    wanted = len({n * m for m in (1, 2) for n in range(25)})
    assert sorted(tuple(r) for r in both.collect()) == [("MY", "123", wanted), ("MY", "com.new", wanted)]
    one = device_store.unique_devices(spark, out, "20200201", "20200229", "bundle")
    assert sorted(tuple(r) for r in one.collect()) == [("123", 25), ("com.new", 25)]
