"""The monthly steps as jobs over files and tables, one function per step.

Each takes plain parameters and writes its result where the next one reads it.
The master list lives in a table, so that a new version replaces the old one at
once; everything else is passed on by path.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from bundlescope import schemas
from bundlescope.fixed_values import BATCH_SIZE, COUNTRIES, MIN_DEVICES
from bundlescope.operators import batching, merging, metadata, segmenting, usage
from bundlescope.sources import device_store, files, parts, sightings, sinks, tables
from bundlescope.sources import results as bucketed


def list_unknown_apps(
    spark: SparkSession,
    sightings_root: str,
    master_table: str,
    out: str,
    start: str,
    end: str,
    countries: Sequence[str] = COUNTRIES,
    plain_folders: bool = False,
    sightings_table: bool = False,
) -> None:
    """Apps seen in the period but without a category, as CSV with one row per country and app.

    ``plain_folders`` reads ``<root><country>/<yyyyMMdd>`` instead of
    ``country=XX/date=yyyyMMdd``; with ``sightings_table`` the root is the name of a
    sightings table.
    """
    read = sightings.read_sightings
    if sightings_table:
        read = sightings.read_sightings_table
    elif plain_folders:
        read = sightings.read_sightings_by_path
    known = spark.table(master_table).select("bundle", "category")
    unknown = usage.unknown_apps(read(spark, sightings_root, start, end, countries), known)
    sinks.write_csv(unknown.select("bundle", "unique_ifa"), out)


def add_sightings(
    spark: SparkSession, table: str, root: str, days: Sequence[tuple[str, str]], layout: str = sightings.PLAIN
) -> None:
    """Make countries and days below a root known to a sightings table, which may be new."""
    sightings.create_sightings_table(spark, table, root)
    sightings.add_days(spark, table, root, days, layout)


def add_device_sets(
    spark: SparkSession,
    sightings_root: str,
    devices_table: str,
    out: str,
    start: str,
    end: str,
    countries: Sequence[str] = COUNTRIES,
    buckets: int = device_store.BUCKETS,
) -> None:
    """Add the period's days to the stored device sets, from which any period is counted."""
    seen = sightings.read_sightings(spark, sightings_root, start, end, countries)
    device_store.add_sightings(seen, devices_table, out, buckets)


def look_up_pending(
    spark: SparkSession,
    unknown: str,
    payloads: str,
    results: str,
    min_devices: int = MIN_DEVICES,
    batch_size: int = BATCH_SIZE,
    results_table: str | None = None,
    buckets: int = bucketed.BUCKETS,
) -> None:
    """Metadata of the listed apps that have none yet, appended to the results.

    The results are JSON in the folder ``results``. With ``results_table`` they are the
    table of that name, bucketed by app, in that folder: earlier results are then not
    shuffled again by each run.
    """
    listed = files.read_csv(spark, unknown, schemas.UNKNOWN_APPS)
    if results_table:
        done = bucketed.results_table(spark, results_table)
    else:
        done = files.read_results_so_far(spark, results)
    todo = batching.pending(batching.audiences(listed, min_devices), done)
    batches = batching.batched(todo, batch_size)
    found = metadata.look_up(batches, files.read_json(spark, payloads, schemas.PAYLOADS))
    if results_table:
        bucketed.append_results(found, results_table, results, buckets)
    else:
        sinks.append_batches(found, results)


def segment_apps(
    spark: SparkSession,
    results: str,
    ref_app: str,
    ref_persona: str,
    out: str,
    start: str,
    end: str,
    run_date: date,
    results_table: str | None = None,
) -> int:
    """The segmented list as Parquet; returns how many segment groups it has.

    Counted while the list is written, so that the step is computed once and nothing is
    read back. ``results_table`` takes the results from that table and not from JSON.
    """
    if results_table:
        found = bucketed.results_table(spark, results_table)
    else:
        found = files.read_json(spark, results, schemas.METADATA_RESULT)
    segmented = segmenting.segmented_list(
        found,
        files.read_csv(spark, ref_app, schemas.CATEGORY_REFERENCE),
        files.read_csv(spark, ref_persona, schemas.PERSONA_REFERENCE),
        start,
        end,
        run_date,
    )
    counted, groups = segmenting.with_distinct_values(segmented, "segment_grp_1")
    sinks.write_parquet(counted, out)
    return groups()


def clean_list(
    spark: SparkSession, master_table: str, segmented: str, root: str, version: str
) -> str:
    """Fold the segmented list into the master list and publish it as a new version."""
    new = files.read_master_list(spark, segmented)
    cleaned = merging.clean_master_list(spark.table(master_table), new)
    return tables.publish_version(cleaned, master_table, root, version)


def fold_list(spark: SparkSession, parts_table: str, segmented: str, root: str, version: str) -> list[int]:
    """Fold the segmented list into a master list in parts; returns the parts that changed."""
    return parts.fold(files.read_master_list(spark, segmented), parts_table, root, version)


def publish_personas(
    spark: SparkSession, master_table: str, table: str, view: str, root: str, version: str
) -> None:
    """Publish the persona table from the master list, and the view over it.

    The master list has one row per app, so the view needs no shuffle.
    """
    tables.publish_persona_table(spark.table(master_table), table, root, version)
    tables.publish_persona_view(spark, view, table, unique_rows=True)
