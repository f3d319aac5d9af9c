"""Device numbers and the device sets of each day as tables that only grow.

Adding days reads their sightings and moves none of what is stored: the numbers are
bucketed by device, the sets lie in a folder per month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.operators import device_sets
from bundlescope.sources.tables import checked_name

BUCKETS = 200
_DEVICES = "ifa string, device bigint"
_SETS = (
    "country string, bundle string, date string, bucket bigint, positions array<int>, bits binary, month string"
)


def devices_table(spark: SparkSession, table: str) -> DataFrame:
    """The devices numbered so far, none before the first run."""
    if spark.catalog.tableExists(checked_name(table)):
        return spark.table(table)
    return spark.createDataFrame([], _DEVICES)


def add_sightings(
    sightings: DataFrame, table: str, root: str, buckets: int = BUCKETS, sparse: int = device_sets.SPARSE
) -> None:
    """Number the devices that are new and add the sets of the days at hand.

    ``table`` holds the numbers in ``<root>/devices``, the sets are in ``<root>/sets``. Either
    write can be repeated after a failure: numbered devices are not numbered again, and sets
    that are there twice merge to the same.
    """
    spark = sightings.sparkSession
    root = root.rstrip("/")
    fresh = device_sets.new_devices(sightings, devices_table(spark, table))
    writer = fresh.repartition(buckets, "ifa").write.format("parquet").mode("append")
    writer.option("path", f"{root}/devices").bucketBy(buckets, "ifa").sortBy("ifa").saveAsTable(checked_name(table))
    sets = device_sets.day_sets(sightings, spark.table(table), sparse)
    placed = sets.withColumn("month", F.substring("date", 1, 6)).hint("rebalance", "month")
    placed.write.partitionBy("month").mode("append").parquet(f"{root}/sets")


def read_sets(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    """The sets of the days from start to end (``yyyyMMdd``); other months are not opened."""
    rows = spark.read.schema(_SETS).parquet(f"{root.rstrip('/')}/sets")
    months = F.col("month").between(start[:6], end[:6])
    return rows.where(months & F.col("date").between(start, end)).drop("month")


def unique_devices(spark: SparkSession, root: str, start: str, end: str, *keys: str) -> DataFrame:
    """Exact devices per key of the period, from the stored sets alone."""
    return device_sets.merged_devices(read_sets(spark, root, start, end), *keys)
