"""Sightings by country and day, listed in proportion to the days asked for.

A reader of a whole folder tree lists every file of every day ever kept before it
prunes. Here only folders of the period are looked at: by their paths, or through a
catalog table that stores where each country and day is, whatever the folders are
called. Days are added to the table as they arrive.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundlescope import schemas
from bundlescope.fixed_values import COUNTRIES
from bundlescope.functions.dates import partition_days
from bundlescope.operators.usage import in_period
from bundlescope.sources.tables import checked_location, checked_name

KEYED = "country={country}/date={day}"
PLAIN = "{country}/{day}"
#: Paths that the file system is asked for side by side.
_LOOKUPS = 16
#: Folders that one listing task takes; Spark would give most of them a task each.
_FOLDERS_PER_TASK = 64
_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: What Spark calls the folder of rows whose partition column is NULL.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Partitions that one statement names.
_ADDED_AT_ONCE = 1000
_FILE_SCHEMA = T.StructType(schemas.SIGHTINGS.fields + schemas.SIGHTING_PARTITIONS.fields)


def period(start: str, end: str, countries: Sequence[str] = COUNTRIES) -> list[tuple[str, str]]:
    """Every country and day from start to end (``yyyyMMdd``, both included)."""
    days = partition_days(start, end)
    return [(country, day) for country in countries for day in days]


def sighting_paths(
    root: str, start: str, end: str, countries: Sequence[str] = COUNTRIES, layout: str = PLAIN
) -> list[str]:
    """The folder of every country and day of the period: the root, then its place there."""
    return [root + layout.format(country=country, day=day) for country, day in period(start, end, countries)]


def _names(spark: SparkSession, folder: str) -> set[str]:
    """What lies in a folder, nothing if it is not there."""
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    location = fs.Path(folder)
    system = location.getFileSystem(conf)
    if not system.exists(location):
        return set()
    found = fs.FileUtil.stat2Paths(system.listStatus(location))
    text = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(found)  # one answer, not one per name
    return {path.rpartition("/")[2] for path in text[1:-1].split(",")}


def keyed_days(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """Every country and day that has a folder ``country=XX/date=yyyyMMdd`` below the root.

    A listing of the root and of each country, by name; no file is opened. Rows without a
    country or day are of no day.
    """
    root = root.rstrip("/")
    countries = sorted(n for n in _names(spark, root) if n.startswith("country=") and n != f"country={_NO_VALUE}")
    with ThreadPoolExecutor(_LOOKUPS) as pool:
        listed = pool.map(lambda country: _names(spark, f"{root}/{country}"), countries)
    return [
        (country.partition("=")[2], day.partition("=")[2])
        for country, days in zip(countries, listed)
        for day in sorted(days)
        if day.startswith("date=") and day != f"date={_NO_VALUE}"
    ]


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the paths that are there.

    A folder that many of them lie in is listed once, by name and not into its folders;
    other paths are asked for one by one.
    """
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        location = fs.Path(path)
        return location.getFileSystem(conf).exists(location)

    asked: dict[str, list[str]] = {}
    for path in paths:
        asked.setdefault(path.rpartition("/")[0], []).append(path)
    many = [folder for folder, inside in asked.items() if folder and len(inside) > _LOOKUPS]
    with ThreadPoolExecutor(_LOOKUPS) as pool:
        listed = dict(zip(many, pool.map(lambda folder: _names(spark, folder), many)))
        single = [path for path in paths if path.rpartition("/")[0] not in listed]
        present = {path for path, found in zip(single, pool.map(there, single)) if found}
    for folder, found in listed.items():
        present |= {path for path in asked[folder] if path.rpartition("/")[2] in found}
    return [path for path in paths if path in present]


def _read(spark: SparkSession, schema: T.StructType, paths: Sequence[str], **options: str) -> DataFrame:
    """The files of these folders; they are listed here, by tasks of many folders each."""
    before = spark.conf.get(_TASKS)
    spark.conf.set(_TASKS, min(int(before), max(1, len(paths) // _FOLDERS_PER_TASK)))
    try:
        return spark.read.schema(schema).options(**options).parquet(*paths)
    finally:
        spark.conf.set(_TASKS, before)


def read_sightings(
    spark: SparkSession, root: str, start: str, end: str, countries: Sequence[str] = COUNTRIES
) -> DataFrame:
    """Sightings laid out as ``country=XX/date=yyyyMMdd``, all countries in one scan.

    Only the period's folders are looked at and listed; days without one are skipped.
    """
    root = root.rstrip("/")
    paths = existing(spark, sighting_paths(f"{root}/", start, end, countries, KEYED))
    if not paths:
        return spark.createDataFrame([], _FILE_SCHEMA)
    return in_period(_read(spark, _FILE_SCHEMA, paths, basePath=root), start, end, countries)


def read_sightings_by_path(
    spark: SparkSession,
    root: str,
    start: str,
    end: str,
    countries: Sequence[str] = COUNTRIES,
    layout: str = PLAIN,
    skip_missing: bool = False,
) -> DataFrame:
    """Sightings in ``<root><country>/<yyyyMMdd>`` folders, all countries in one scan.

    Country and day come from the file's own path. ``layout`` says how folders are called
    below the root. A missing folder fails the read unless ``skip_missing``.
    """
    paths = sighting_paths(root, start, end, countries, layout)
    if skip_missing:
        paths = existing(spark, paths)
    if not paths:
        return spark.createDataFrame([], _FILE_SCHEMA)
    path = F.col("_metadata.file_path")
    names = [re.escape(part) for part in layout.replace("{country}", "\0").replace("{day}", "\0").split("\0")]
    pattern = f"{names[0]}([^/]*){names[1]}([^/]*){names[2]}/[^/]*$"
    places = {"country": 1, "day": 2} if layout.index("{country}") < layout.index("{day}") else {"country": 2, "day": 1}
    return _read(spark, schemas.SIGHTINGS, paths).select(
        "*",
        F.regexp_extract(path, pattern, places["country"]).alias("country"),
        F.regexp_extract(path, pattern, places["day"]).alias("date"),
    )


def create_sightings_table(spark: SparkSession, table: str, root: str) -> None:
    """An external table whose catalog entry stores its partitions, none to begin with."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {checked_name(table)} "
        "(ifa STRING, app ARRAY<STRUCT<bundle: STRING>>, country STRING, `date` STRING) "
        f"USING PARQUET PARTITIONED BY (country, `date`) LOCATION {checked_location(root)}"
    )


def add_days(
    spark: SparkSession, table: str, root: str, days: Iterable[tuple[str, str]], layout: str = PLAIN
) -> None:
    """Add countries and days with their folders below the root; those that the table has
    already stay as they are.

    Costs what the new days cost. Nothing is listed, and a folder that is not there yet is
    made, so that later writes to the table go there.
    """
    specs = [
        f"PARTITION (country = '{checked_name(country)}', `date` = '{checked_name(day)}') "
        f"LOCATION {checked_location(root + layout.format(country=country, day=day))}"
        for country, day in days
    ]
    for first in range(0, len(specs), _ADDED_AT_ONCE):
        added = " ".join(specs[first : first + _ADDED_AT_ONCE])
        spark.sql(f"ALTER TABLE {checked_name(table)} ADD IF NOT EXISTS {added}")


def stored_days(spark: SparkSession, table: str) -> DataFrame:
    """Country and day pairs that the table has, from the catalog alone."""
    listed = spark.sql(f"SHOW PARTITIONS {checked_name(table)}")
    part = F.split("partition", "/")
    return listed.select(
        F.substring_index(part[0], "=", -1).alias("country"), F.substring_index(part[1], "=", -1).alias("date")
    )


def read_sightings_table(
    spark: SparkSession, table: str, start: str, end: str, countries: Sequence[str] = COUNTRIES
) -> DataFrame:
    """The period's rows of a sightings table; the catalog names the folders to open."""
    return in_period(spark.table(table), start, end, countries)


def write_sightings(sightings: DataFrame, table: str) -> None:
    """Append all days' rows in one job, each to the folder that the table has for it.

    Rows are brought together by country and day first, else every task would open a
    file in every day.
    """
    names = [f.name for f in _FILE_SCHEMA.fields]
    sightings.select(*names).repartition("country", "date").write.insertInto(table)
