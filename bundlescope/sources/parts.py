"""A master list in parts by a hash of the app: a fold rewrites the parts that get new apps.

An app that the list has keeps its row, so only apps it does not have change anything.
Each part is a partition of a catalog table with a folder of its own. A fold writes the
changed parts beside the earlier ones and then points their partitions to them; the others
keep their files. Readers see each part in its old or its new version, and an app is in
one part only. A fold that fails half way can be repeated: what it added is there then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope.functions.rules import refine_segments
from bundlescope.operators import merging
from bundlescope.operators.joins import without
from bundlescope.sources.tables import checked_location, checked_name

#: So many that a part stays within some hundred MB; kept with the table.
PARTS = 256
_PROPERTY = "bundlescope.parts"


def part_of(bundle: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(bundle), F.lit(parts)).cast("int")


def create_parts(master: DataFrame, table: str, root: str, version: str, parts: int = PARTS) -> None:
    """A new table with the list's rows, one per app; ``parts`` stays with the table."""
    spark = master.sparkSession
    columns = ", ".join(f"`{name}` {kind}" for name, kind in master.dtypes)
    spark.sql(
        f"CREATE TABLE {checked_name(table)} ({columns}, part INT) USING PARQUET PARTITIONED BY (part) "
        f"LOCATION {checked_location(root)} TBLPROPERTIES ('{_PROPERTY}' = '{parts}')"
    )
    location = _write(merging.one_row_per_app(master), root, version, parts)
    added = [f"PARTITION (part = {part}) LOCATION {_folder(location, part)}" for part in range(parts)]
    spark.sql(f"ALTER TABLE {table} ADD {' '.join(added)}")


def parts_of(spark: SparkSession, table: str) -> int:
    [row] = spark.sql(f"SHOW TBLPROPERTIES {checked_name(table)} ('{_PROPERTY}')").collect()
    return int(row["value"])


def read_parts(spark: SparkSession, table: str) -> DataFrame:
    """The whole list."""
    return spark.table(checked_name(table)).drop("part")


def _folder(location: str, part: int) -> str:
    return checked_location(f"{location}/part={part}")


def _write(rows: DataFrame, root: str, version: str, parts: int) -> str:
    location = f"{root.rstrip('/')}/version={version}"
    placed = rows.withColumn("part", part_of("bundle", parts)).hint("rebalance", "part")
    placed.write.partitionBy("part").mode("errorifexists").parquet(location)
    return location


def fold(new: DataFrame, table: str, root: str, version: str, refine: bool = True) -> list[int]:
    """Fold a list into the table, as ``merging.merge_lists`` or with ``refine`` as
    ``merging.clean_master_list`` would; returns the parts that got new apps.

    Of the other parts only three columns are read, to tell new apps and to look up
    segment indexes. The driver sees the numbers of the changed parts.
    """
    spark = new.sparkSession
    parts = parts_of(spark, table)
    old = spark.table(checked_name(table))
    new = merging.trim_column_names(new)
    named = new.where(F.col("bundle").isNotNull() & (F.col("bundle") != ""))
    fresh = without(named, old, "bundle")
    number = part_of("bundle", parts).alias("part")
    changed = sorted(row["part"] for row in fresh.select(number).distinct().collect())
    if changed:
        kept = old.where(F.col("part").isin(changed)).drop("part")
        refreshed = merging.refresh_segment_index(fresh, merging.smallest_segment_index(old))
        merged = merging.one_row_per_app(kept, merging.align(refreshed, kept))
        location = _write(refine_segments(merged) if refine else merged, root, version, parts)
        for part in changed:
            spark.sql(f"ALTER TABLE {table} PARTITION (part = {part}) SET LOCATION {_folder(location, part)}")
        spark.catalog.refreshTable(table)
    return changed
