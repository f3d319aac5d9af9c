import pytest
from pyspark.sql import functions as F

from bundlescope import schemas
from bundlescope.operators import joins, metadata

NO_BROADCAST = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture
def large_tables(spark):
    before = {key: spark.conf.get(key, None) for key in NO_BROADCAST}
    for key in before:
        spark.conf.set(key, "-1")
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("listed_rows, max_bits", [(2000, 1 << 29), (2000, 1 << 15), (10, 1 << 29), (0, 1)])
def test_no_listed_key_is_lost(spark, listed_rows, max_bits):
    rows = spark.range(20_000).select(F.concat(F.lit("app"), "id").alias("bundle"), F.col("id").alias("n"))
    rows = rows.union(spark.createDataFrame([(None, -1), ("", -2)], "bundle string, n bigint"))
    listed = spark.range(0, listed_rows).select(F.concat(F.lit("app"), F.col("id") * 7).alias("bundle"))
    listed = listed.union(spark.createDataFrame([(None,), ("app1",), ("app1",)], "bundle string"))
    got = joins.perhaps_listed(rows, listed, "bundle", listed_rows + 3, max_bits)
    assert got.columns == rows.columns
    found = [r.n for r in got.collect()]
    wanted = {7 * k for k in range(listed_rows) if 7 * k < 20_000} | {1}
    assert wanted <= set(found) and len(found) == len(set(found)) and -1 not in found
    assert len(found) - len(wanted) < 20_000 / 16 * 1.5


def test_a_full_filter_lets_rows_through_and_loses_none(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("bundle"))
    listed = spark.range(1_000_000).select((F.col("id") + 500).cast("string").alias("bundle"))
    found = {int(r.bundle) for r in joins.perhaps_listed(rows, listed, "bundle", 1_000_000, 1 << 15).collect()}
    assert set(range(500, 1000)) <= found and len(found) > 900


def test_empty_list(spark):
    rows = spark.createDataFrame([("a",), (None,)], "bundle string")
    assert joins.perhaps_listed(rows, rows.limit(0), "bundle", 0).collect() == []


def test_page_text_is_in_no_shuffle(spark, large_tables, tmp_path):
    apps = spark.createDataFrame([("a", 1)], schemas.UNKNOWN_APPS)
    spark.createDataFrame([("a", None, "<p>", None)] * 3, schemas.PAYLOADS).write.parquet(f"{tmp_path}/pages")
    payloads = spark.read.schema(schemas.PAYLOADS).parquet(f"{tmp_path}/pages")
    for max_rows in (0, 10):
        df = metadata.look_up(apps, payloads, max_rows)
        text = plan(df)
        shuffled = [part for part in text.split("Exchange hashpartitioning(bundle")[1:] if "html" in part]
        for part in shuffled:  # what is shuffled are aggregated records
            assert part.index("Aggregate(key=") < part.index("html")
        assert "BroadcastHashJoin" in text  # where the list meets the pages
        assert [r.mapped_info.app_url for r in df.collect()] == ["https://play.google.com/store/apps/details?id=a"]


def test_records_of_apps_that_are_not_listed_go(spark):
    payloads = spark.range(3000).select(
        F.concat(F.lit("com.app"), "id").alias("bundle"), F.lit(None).cast("string").alias("lookup_json"),
        F.lit("<h1 itemprop='name'>x</h1>").alias("html"), F.lit(None).cast("string").alias("alt_html"),
    )
    apps = spark.range(0, 3000, 10).select(F.concat(F.lit("com.app"), "id").alias("bundle"), F.lit(1).cast("bigint").alias("unique_ifa"))
    few = metadata.asked_for(payloads, apps, max_rows=0)
    assert 300 <= few.count() < 700
    found = metadata.look_up(apps, payloads, max_rows=0)
    assert found.count() == 300 and found.where("mapped_info.appl_name = 'x'").count() == 300
