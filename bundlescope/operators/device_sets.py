"""Exact distinct devices over any period from sets that are stored per app and day.

Devices get dense numbers once. The devices of an app on a day are then sets of numbers,
one row per 32768 numbers: a bitmap where there are many, a short list of positions where
there are few, since a bitmap of one device would take 4096 bytes. A period's count merges
the rows of its days; sightings are read once, when their day is added, and adding a day
twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlescope.functions import bitmaps
from bundlescope.operators.batching import number_rows
from bundlescope.operators.joins import without
from bundlescope.operators.usage import device_apps

#: Positions that are kept as a list; more of them are a bitmap.
SPARSE = 128


def new_devices(sightings: DataFrame, known: DataFrame) -> DataFrame:
    """ifa and ``device`` of devices that have no number yet, from the largest known number on.

    One number reaches the driver. NULL devices get none.
    """
    seen = sightings.select("ifa").where(F.col("ifa").isNotNull()).distinct()
    before = known.agg(F.max("device").alias("most")).first()["most"] or 0
    numbered = number_rows(without(seen, known, "ifa"), "ifa", name="device")
    return numbered.select("ifa", (F.col("device") + before).alias("device"))


def day_sets(sightings: DataFrame, devices: DataFrame, sparse: int = SPARSE) -> DataFrame:
    """country, bundle, date, bucket and either ``positions`` or ``bits`` of each app's devices.

    Device lists are joined before they are unnested, so each record moves once. Records
    without a device take no part in the join; their apps keep a row with no positions.
    """
    named = sightings.where(F.col("ifa").isNotNull()).join(devices, "ifa")
    apps = named.select("country", "date", "device", F.explode("app").alias("seen"))
    apps = apps.select("country", "date", "device", F.col("seen.bundle").alias("bundle"))
    unnamed = device_apps(sightings.where(F.col("ifa").isNull()), "country", "date")
    unnamed = unnamed.select("country", "date", F.lit(None).cast("bigint").alias("device"), "bundle").distinct()
    keys = ["country", "date", "bundle", "bucket"]
    placed = apps.union(unnamed).select(
        "country", "date", "bundle", bitmaps.bucket(F.col("device")).alias("bucket"),
        bitmaps.position(F.col("device")).cast("int").alias("at"),
    )
    found = placed.groupBy(*keys).agg(F.collect_set("at").alias("positions"))
    few = found.where(F.size("positions") <= sparse).withColumn("bits", F.lit(None).cast("binary"))
    many = found.where(F.size("positions") > sparse).select(*keys, F.explode("positions").alias("at"))
    many = many.groupBy(*keys).agg(F.bitmap_construct_agg("at").alias("bits"))
    return few.unionByName(many.withColumn("positions", F.lit(None).cast("array<int>")))


def merged_devices(sets: DataFrame, *keys: str) -> DataFrame:
    """Devices per key over all days of the sets, as ``usage.unique_devices`` counts them.

    Bitmaps are merged bit by bit; listed positions count unless a bitmap has them.
    """
    groups = [*keys, "bucket"]
    dense = sets.where(F.col("bits").isNotNull()).groupBy(*groups).agg(F.bitmap_or_agg("bits").alias("bits"))
    listed = sets.where(F.col("bits").isNull()).select(*groups, F.explode_outer("positions").alias("at"))
    other = dense.select(*[F.col(c).alias(f"_{c}") for c in groups], "bits")
    same: Column = F.lit(True)
    for c in groups:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    alone = listed.distinct().join(other, same, "left").where(
        F.col("bits").isNull() | ~bitmaps.has_bit(F.col("bits"), F.col("at"))
    )
    counted = alone.groupBy(*keys).agg(F.count("at").alias("n"))
    counted = counted.union(dense.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("n")))
    return counted.groupBy(*keys).agg(F.sum("n").alias("unique_ifa"))
