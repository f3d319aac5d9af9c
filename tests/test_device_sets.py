import uuid

import pytest
from pyspark.sql import functions as F

from bundlescope.functions import bitmaps
from bundlescope.operators import device_sets, usage
from bundlescope.sources import device_store

SCHEMA = "country string, date string, ifa string, app array<struct<bundle: string>>"


def made(days, devices):
    rows = []
    for day in days:
        for n in range(devices):
            listed = [("all",), (f"rare{n % 7}",)] + ([(None,)] if n % 3 else [])
            rows.append((["MY", "TH", None][n % 3], f"202001{day:02}", f"d{(n * day) % 50}", listed))
        rows += [("MY", f"202001{day:02}", None, [("nobody",), ("all",)]), ("MY", f"202001{day:02}", "d1", []), ("TH", f"202001{day:02}", "d2", None)]
    return rows


def counted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    table = f"devices_{uuid.uuid4().hex}"
    yield table, str(tmp_path / "store")
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_has_bit(spark):
    wanted = [1, 2, 8, 9, 255, 256, 4097, 32767, 32768]
    numbers = spark.createDataFrame([(n,) for n in wanted], "n bigint")
    bits = numbers.agg(F.bitmap_construct_agg(bitmaps.position(F.col("n"))).alias("bits"))
    every = spark.range(1, bitmaps.BITS + 1).join(F.broadcast(bits))
    found = every.where(bitmaps.has_bit(F.col("bits"), bitmaps.position(F.col("id"))))
    assert sorted(r.id for r in found.collect()) == wanted
    buckets = spark.createDataFrame([(n,) for n in (1, 32768, 32769, 65536)], "n bigint")
    assert [r[0] for r in buckets.select(bitmaps.bucket(F.col("n"))).collect()] == [1, 1, 2, 2]


@pytest.mark.parametrize("sparse", [0, 2, 128])
def test_periods_merge_to_the_exact_count(spark, store, sparse):
    table, root = store
    first = spark.createDataFrame(made([1, 2], 90), SCHEMA).repartition(3)
    second = spark.createDataFrame(made([3, 31], 120), SCHEMA).repartition(2)
    device_store.add_sightings(first, table, root, buckets=2, sparse=sparse)
    numbers = {r.ifa: r.device for r in spark.table(table).collect()}
    assert sorted(numbers.values()) == list(range(1, len(numbers) + 1)) and None not in numbers
    device_store.add_sightings(second, table, root, buckets=2, sparse=sparse)
    later = {r.ifa: r.device for r in spark.table(table).collect()}
    assert sorted(later.values()) == list(range(1, len(later) + 1))
    assert numbers.items() <= later.items()
    both = first.union(second)
    for start, end, rows in [("20200101", "20200131", both), ("20200102", "20200103", both.where("date between '20200102' and '20200103'"))]:
        got = device_store.unique_devices(spark, root, start, end, "country", "bundle")
        assert counted(got) == counted(usage.unique_devices(usage.device_apps(rows, "country"), "country", "bundle"))
    by_app = device_store.unique_devices(spark, root, "20200101", "20200131", "bundle")
    assert counted(by_app) == counted(usage.unique_devices(usage.device_apps(both), "bundle"))


def test_days_added_twice_and_empty_days_change_nothing(spark, store):
    table, root = store
    rows = spark.createDataFrame(made([1], 60), SCHEMA)
    device_store.add_sightings(rows, table, root, buckets=2)
    once = counted(device_store.unique_devices(spark, root, "20200101", "20200101", "country", "bundle"))
    device_store.add_sightings(rows, table, root, buckets=2)
    device_store.add_sightings(rows.limit(0), table, root, buckets=2)
    assert counted(device_store.unique_devices(spark, root, "20200101", "20200101", "country", "bundle")) == once
    assert spark.table(table).count() == spark.table(table).select("ifa").distinct().count()


def test_more_numbers_than_a_bitmap_holds(spark):
    rows = spark.range(70_000).select(
        F.lit("MY").alias("country"), F.lit("20200101").alias("date"), F.concat(F.lit("d"), "id").alias("ifa"),
        F.array(F.struct(F.lit("all").alias("bundle"))).alias("app"),
    )
    devices = spark.range(70_000).select(F.concat(F.lit("d"), "id").alias("ifa"), (F.col("id") + 1).alias("device"))
    sets = device_sets.day_sets(rows, devices)
    assert sets.where("bits is not null").count() == 3
    assert counted(device_sets.merged_devices(sets.union(sets), "bundle")) == [("all", 70_000)]


def test_stored_numbers_are_not_shuffled(spark, store):
    table, root = store
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    device_store.add_sightings(spark.createDataFrame(made([1], 60), SCHEMA), table, root, buckets=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = device_sets.day_sets(spark.createDataFrame(made([2], 60), SCHEMA), spark.table(table))
        plan = sets._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin [ifa" in plan
    for line in plan.split("SortMergeJoin [ifa")[1:]:
        right = line.split("FileScan parquet")[0]
        assert right.count("Exchange hashpartitioning(ifa") == 1
