"""From the unknown-app list to numbered batches of apps still to be looked up."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlescope.fixed_values import BATCH_SIZE, MIN_DEVICES
from bundlescope.operators.joins import Size, stored_and_measured, without

# monotonically_increasing_id: partition number above, position in it below this bit.
_POSITION_BITS = 33


def audiences(unknown: DataFrame, min_devices: int = MIN_DEVICES) -> DataFrame:
    """Devices per app, summed over the per-country rows with more than ``min_devices``."""
    large = unknown.where(F.col("unique_ifa") > min_devices)
    return large.groupBy("bundle").agg(F.sum("unique_ifa").alias("unique_ifa"))


def largest_first(unknown: DataFrame) -> DataFrame:
    """Largest audiences first, equal ones by app id."""
    return unknown.orderBy(F.desc("unique_ifa"), F.asc_nulls_first("bundle"))


def pending(apps: DataFrame, done: DataFrame) -> DataFrame:
    """Apps without an earlier result."""
    return without(apps, done, "bundle")


def number_rows(df: DataFrame, *order: str, name: str = "rn") -> DataFrame:
    """Row number 1..n over the whole table, NULLs first, without one task seeing it all.

    ``order`` must tell all rows apart.
    """
    return numbered_and_measured(df, *order, name=name)[0]


def numbered_and_measured(df: DataFrame, *order: str, name: str = "rn") -> tuple[DataFrame, Size]:
    """``number_rows`` and the size of the table, which is found on the way.

    Rows are range partitioned and sorted, and their place in their partition is written
    down, since a recomputed range partitioning may cut elsewhere. What reaches the driver
    is one count per partition; what is broadcast is one offset per partition.
    """
    spark = df.sparkSession
    ascending = [F.asc_nulls_first(c) for c in order]
    placed, size = stored_and_measured(
        df.repartitionByRange(*ascending)
        .sortWithinPartitions(*ascending)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_place", _POSITION_BITS).cast("int")
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    before = accumulate((size["count"] for size in sizes), initial=0)
    offsets = spark.createDataFrame(
        [(size["part"], total) for size, total in zip(sizes, before)],
        "_part int, _before bigint",
    )
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + position + 1).alias(name))
    )
    return numbered, size


def batched(apps: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Row number by app id and the batch it falls in; all batches full but the last."""
    return batched_and_measured(apps, size)[0]


def batched_and_measured(apps: DataFrame, size: int = BATCH_SIZE) -> tuple[DataFrame, Size]:
    """``batched`` and the size of the list."""
    numbered, found = numbered_and_measured(apps, "bundle")
    return numbered.withColumn("grp", F.ceil(F.col("rn") / size)), found


def batch_count(batches: DataFrame) -> DataFrame:
    """Number of batches, 0 for an empty list."""
    return batches.agg(F.coalesce(F.max("grp"), F.lit(0).cast("bigint")).alias("batches"))


def batch_summary(batches: DataFrame) -> DataFrame:
    return batches.groupBy("grp").agg(
        F.count(F.lit(1)).alias("apps"),
        F.min("bundle").alias("first_bundle"),
        F.max("bundle").alias("last_bundle"),
        F.sum("unique_ifa").alias("unique_ifa"),
    )


def one_batch(batches: DataFrame, number: int) -> DataFrame:
    """Rows of one batch; on files partitioned by ``grp`` this prunes partitions."""
    return batches.where(F.col("grp") == number)
