"""Device and app sightings: who was seen with which app, and which apps are new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.fixed_values import COUNTRIES, NOT_FOUND
from bundlescope.functions.dates import day_sequence
from bundlescope.operators.joins import (
    BROADCAST_MAX_BYTES,
    BROADCAST_MAX_ROWS,
    fits_broadcast,
    without,
)


def in_period(
    sightings: DataFrame, start: str, end: str, countries: Sequence[str] = COUNTRIES
) -> DataFrame:
    """Days from start to end (``yyyyMMdd``, both included) of the given countries.

    On files laid out by ``country`` and ``date`` both tests prune partitions.
    """
    return sightings.where(F.col("date").between(start, end) & F.col("country").isin(*countries))


def missing_partitions(
    spark: SparkSession,
    found: DataFrame,
    start: str | Column,
    end: str | Column,
    countries: Sequence[str] = COUNTRIES,
) -> DataFrame:
    """Country and day pairs of the period that hold no data."""
    start, end = (F.lit(d) if isinstance(d, str) else d for d in (start, end))
    expected = (
        spark.range(1)
        .select(F.explode(F.array(*[F.lit(c) for c in countries])).alias("country"))
        .select("country", F.explode(day_sequence(start, end)).alias("date"))
    )
    present = found.where(F.col("date").between(start, end) & F.col("country").isin(*countries))
    present = present.select("country", "date").distinct()
    return expected.join(present, ["country", "date"], "left_anti")


def device_apps(sightings: DataFrame, *keep: str) -> DataFrame:
    """One row per app in a device's list; devices with no list or an empty one drop out."""
    apps = sightings.select(*keep, "ifa", F.explode("app").alias("seen"))
    return apps.select(*keep, "ifa", F.col("seen.bundle").alias("bundle"))


def unique_devices(apps: DataFrame, *keys: str) -> DataFrame:
    """Exact number of devices per key; NULL devices do not count, NULL keys do group.

    Spark removes duplicates by key *and* device first, so the rows of a hot app
    are spread by device and only partial counts meet in the final task.
    """
    return apps.groupBy(*keys).agg(F.count_distinct("ifa").alias("unique_ifa"))


def categorised(known: DataFrame) -> DataFrame:
    """Known apps with a real category; all others count as unknown and come round again."""
    category = F.col("category")
    return known.where(category.isNotNull() & (category != NOT_FOUND) & (category != ""))


def unknown_apps(
    sightings: DataFrame,
    known: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Devices per country and app for apps not in the known list (NULL app kept).

    The known list is a function of the app alone, the grouping key, so it may be
    taken out before or after counting. Measured small it is broadcast and
    removes known apps in the scan stage, before anything is shuffled; otherwise
    apps are counted first and only one row per country and app meets the list.
    ``small`` is the outcome where the list has been measured already.
    """
    keys = categorised(known).select("bundle")
    apps = device_apps(sightings, "country")
    if small is None:
        small = fits_broadcast(keys, max_rows, max_bytes)
    if small:
        return unique_devices(without(apps, keys, "bundle", broadcast=True), "country", "bundle")
    counted = unique_devices(apps, "country", "bundle")
    return without(counted, keys, "bundle").select("country", "bundle", "unique_ifa")
