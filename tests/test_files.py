from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bundlescope import schemas, session
from bundlescope.functions import dates
from bundlescope.operators import usage
from bundlescope.sources import files, sinks, tables
from bundlescope.sources import sightings as sightings_source
from bundlescope.streaming import incremental


@pytest.fixture
def sightings(spark):
    return spark.createDataFrame(
        [
            ("MY", "20200101", "a", [("x",)]),
            ("MY", "20200102", "a", [("y",)]),
            ("TH", "20200101", "b", [("x",)]),
            ("TH", "20200102", "b", [("z",)]),
            ("SG", "20200101", "c", [("x",)]),
        ],
        "country string, date string, ifa string, app array<struct<bundle: string>>",
    )


def test_partitioned_sightings_are_pruned(spark, sightings, tmp_path):
    root = str(tmp_path / "hive")
    sightings.write.partitionBy("country", "date").parquet(root)
    read = sightings_source.read_sightings(spark, root, "20200102", "20200103", ["MY", "SG"])
    apps = usage.device_apps(read, "country", "date")
    assert [tuple(r) for r in apps.collect()] == [("MY", "20200102", "a", "y")]
    plan = apps._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in filters and "country" in filters
    assert "ReadSchema: struct<ifa:string,app:array<struct<bundle:string>>>" in plan


def test_plain_folders(spark, sightings, tmp_path):
    root = f"{tmp_path}/plain/"
    for country, day in [("MY", "20200101"), ("MY", "20200102"), ("TH", "20200101"), ("TH", "20200102")]:
        part = sightings.where((F.col("country") == country) & (F.col("date") == day))
        part.select("ifa", "app").write.parquet(f"{root}{country}/{day}")
    read = sightings_source.read_sightings_by_path(spark, root, "20200101", "20200102", ["MY", "TH"])
    got = sorted(tuple(r) for r in usage.device_apps(read, "country", "date").collect())
    assert got == [
        ("MY", "20200101", "a", "x"), ("MY", "20200102", "a", "y"),
        ("TH", "20200101", "b", "x"), ("TH", "20200102", "b", "z"),
    ]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        sightings_source.read_sightings_by_path(spark, root, "20200101", "20200103", ["MY"])
    assert sightings_source.read_sightings_by_path(spark, root, "20200102", "20200101").count() == 0


def test_csv_blank_text_comes_back_as_null(spark, tmp_path):
    odd = ' two\nlines, "quoted" \\ '
    df = spark.createDataFrame([("a", ""), ("b,\"c\"", "x"), ("c", odd), (" d\\", '"')], schemas.KNOWN_APPS)
    path = str(tmp_path / "csv")
    sinks.write_csv(df.repartition(2), path)
    sinks.write_csv(df.repartition(2), path)
    got = sorted(tuple(r) for r in files.read_csv(spark, path, schemas.KNOWN_APPS).collect())
    assert got == [(" d\\", '"'), ("a", None), ("b,\"c\"", "x"), ("c", odd)]


def test_results_before_the_first_run_are_empty(spark, tmp_path):
    assert files.read_results_so_far(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "empty").mkdir()
    assert files.read_results_so_far(spark, str(tmp_path / "empty")).count() == 0


def test_appending_and_replacing_batches(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "bundle string, grp bigint")
    appended, replaced = str(tmp_path / "append"), str(tmp_path / "replace")
    for _ in range(2):
        sinks.append_json(df, appended)
        sinks.replace_batches(df, replaced)
    sinks.replace_batches(df.where("grp = 2"), replaced)
    assert spark.read.json(appended).count() == 6
    assert spark.read.json(replaced).count() == 3


def test_replaced_batches_share_folders_and_leave_others_alone(spark, tmp_path):
    path = str(tmp_path / "replace")
    df = spark.range(2000).selectExpr("cast(id as string) AS bundle", "nullif(id % 200, 7) AS grp")
    sinks.replace_batches(df, path)
    assert len(list((tmp_path / "replace").glob("*=*"))) <= 5
    untouched = {f.name for f in (tmp_path / "replace" / "part=2").iterdir()}
    other = spark.createDataFrame([("x", 3, None), ("y", None, 1), ("z", 500, 2)], "bundle string, grp bigint, extra int")
    for _ in range(2):
        sinks.replace_batches(other, path)
    read = spark.read.schema("bundle string, grp bigint, extra int").json(path).select("bundle", "grp", "extra")
    kept = df.where("grp <> 3").selectExpr("bundle", "grp", "cast(null AS int) AS extra")
    assert sorted(map(repr, read.collect())) == sorted(map(repr, kept.union(other).collect()))
    assert {f.name for f in (tmp_path / "replace" / "part=2").iterdir()} == untouched
    named = spark.createDataFrame([("a", "one"), ("b", "two"), ("c", None)], "bundle string, grp string")
    sinks.replace_batches(named, f"{path}-named")
    sinks.replace_batches(named.where("bundle = 'b'"), f"{path}-named")
    assert spark.read.json(f"{path}-named").count() == 3


def test_a_folder_per_batch_is_not_mixed_with_shared_ones(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "bundle string, grp bigint")
    df.write.partitionBy("grp").json(str(tmp_path / "old"))
    with pytest.raises(ValueError, match="a folder per batch"):
        sinks.replace_batches(df, str(tmp_path / "old"))


def test_appended_batches_make_few_files(spark, tmp_path):
    df = spark.range(20_000).selectExpr("cast(id as string) AS bundle", "id % 40 AS grp").repartition(40)
    sinks.append_batches(df, str(tmp_path / "batches"))
    assert len(list((tmp_path / "batches").glob("grp=*/part-*"))) <= 80
    assert spark.read.json(str(tmp_path / "batches")).count() == 20_000


def test_known_and_master_lists(spark, tmp_path):
    known = spark.createDataFrame([("a", "Games")], schemas.KNOWN_APPS)
    sinks.write_parquet(known, str(tmp_path / "known"))
    assert files.read_known_apps(spark, str(tmp_path / "known")).collect() == known.collect()
    blank = spark.createDataFrame([("a", "b")], "`bundle ` string, `category` string")
    sinks.write_parquet(blank, str(tmp_path / "blank"))
    assert files.read_master_list(spark, str(tmp_path / "blank")).columns == ["bundle", "category"]


def test_versions_replace_each_other_and_the_old_files_stay(spark, tmp_path):
    table = "versions_test"
    tables.drop_table(spark, table)
    first = spark.createDataFrame([("a", "1")], schemas.KNOWN_APPS)
    place = tables.publish_version(first, table, str(tmp_path), "1")
    own = spark.table(table)
    tables.publish_version(own.withColumn("category", F.lit("2")), table, str(tmp_path), "2")
    assert [tuple(r) for r in spark.table(table).collect()] == [("a", "2")]
    assert [tuple(r) for r in spark.read.parquet(place).collect()] == [("a", "1")]
    with pytest.raises(AnalysisException):
        tables.publish_version(first, table, str(tmp_path), "2")
    with pytest.raises(ValueError, match="columns differ"):
        tables.publish_version(first.withColumnRenamed("category", "kind"), table, str(tmp_path), "3")
    assert not (tmp_path / "version=3").exists()
    tables.drop_table(spark, table)
    tables.drop_table(spark, table)
    assert not spark.catalog.tableExists(table)


def test_persona_table_and_view(spark, tmp_path):
    values = {"bundle": "a", "category": "Sports", "segment_grp_1": "Gamers", "ifa_cnt": 3.0}
    master = spark.createDataFrame(
        [tuple(values.get(n) for n in schemas.MASTER_LIST.fieldNames())], schemas.MASTER_LIST
    )
    table, view = "personas_test", "persona_view_test"
    tables.drop_view(spark, view)
    tables.drop_table(spark, table)
    tables.publish_persona_table(master, table, str(tmp_path), "1")
    for unique in (False, True):
        tables.publish_persona_view(spark, view, table, unique)
        got = sorted((r["persona"], str(r["rank"]), r["app_category"]) for r in spark.table(view).collect())
        assert got == [("Gamers", "10.0", "Lifestyle"), ("Gamers", "10.0", "Sports")]
    tables.drop_view(spark, view)
    tables.drop_table(spark, table)


@pytest.mark.parametrize("name", ["a b", "x; DROP TABLE y", "a.b.c.d", ""])
def test_table_names_are_checked(spark, name):
    with pytest.raises(ValueError):
        tables.drop_table(spark, name)


def test_stream_appends_only_what_is_new(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    page = '<h1 itemprop="name">n</h1>'
    for bundle in ("com.a", "com.b"):
        one = spark.createDataFrame([(bundle, None, page, None)], schemas.PAYLOADS)
        one.write.mode("append").json(source)
        stream = incremental.payload_stream(spark, source, files_per_trigger=1)
        incremental.append_metadata(stream, out, state).awaitTermination(120)
    schema = "bundle string, mapped_info struct<appl_name: string>"
    got = sorted((r[0], r[1][0]) for r in spark.read.schema(schema).json(out).collect())
    assert got == [("com.a", "n"), ("com.b", "n")]


def test_dates(spark):
    day = F.col("d")
    df = spark.createDataFrame([(date(2020, 3, 31),), (date(2020, 1, 1),)], "d date")
    got = df.select(
        dates.month_start(day), dates.month_end(day), dates.run_label(day), dates.lookback(day),
        dates.update_label(day), dates.period_label("20200101", "20200131"),
    )
    assert [tuple(r) for r in got.collect()] == [
        ("20200201", "20200229", "202003", "202003", "31/03/2020", "20200101-20200131"),
        ("20191201", "20191231", "202001", "201912", "01/01/2020", "20200101-20200131"),
    ]
    days = spark.range(1).select(
        dates.day_sequence(F.lit("20200228"), F.lit("20200301")),
        dates.day_sequence(F.lit("20200302"), F.lit("20200301")),
    )
    assert tuple(days.first()) == (["20200228", "20200229", "20200301"], [])


def stand_in(master, **conf):
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder_is_the_one_the_session_names():
    named = stand_in("spark://host:7077", **{session.CHECKPOINT_DIR: "hdfs:///shared/folder/"})
    assert session.shared_dir(named) == "hdfs:///shared/folder"
    assert session.scratch_path(named, "x").startswith("hdfs:///shared/folder/x-")
    assert session.shared_dir(stand_in("local[8]")).endswith("/app-1")
    with pytest.raises(ValueError, match="shared by all executors"):
        session.shared_dir(stand_in("yarn"))


def test_scratch_is_deleted_when_nothing_needs_it(spark):
    def there(path):
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)

    rows = spark.range(3)
    outer = session.scratch_path(spark, "outer")
    with session.scratch_scope(spark):
        inner = session.stored(rows, "inner")
        [inner_path] = {path.rpartition("/")[0] for path in inner.inputFiles()}
        inner.write.parquet(outer)
    assert not there(inner_path) and spark.read.parquet(outer).count() == 3
    session.delete_scratch(spark, ["/root", outer])
    assert not there(outer) and there("/root")


def test_appended_batches_need_no_folder_each(spark, tmp_path):
    path = tmp_path / "batches"
    df = spark.range(2_000).selectExpr("cast(id as string) AS bundle", "id div 5 AS grp")
    sinks.append_batches(df, str(path))
    assert not [p for p in path.iterdir() if p.is_dir()]
    read = spark.read.schema("bundle string, grp bigint").json(str(path))
    assert read.selectExpr("*", "_metadata.file_name AS f").groupBy("grp").agg({"f": "approx_count_distinct"}).where("`approx_count_distinct(f)` > 1").count() == 0
    assert sorted(read.collect()) == sorted(df.collect())
