"""Category, segment and persona index for apps with store metadata."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bundlescope.functions.dates import period_label, update_label
from bundlescope.functions.text import platform
from bundlescope.operators.joins import lookup_join, salted_left_join
from bundlescope.schemas import MASTER_LIST

SEGMENT_COLUMNS = [f.name for f in MASTER_LIST.fields if f.name not in ("segment_index", "ifa_cnt")]
INDEX_COLUMNS = [f.name for f in MASTER_LIST.fields if f.name != "ifa_cnt"]


def app_base(results: DataFrame, start: str, end: str, run_date: date) -> DataFrame:
    """Distinct metadata rows with category in upper case, period, run date and platform."""
    rows = results.select(
        "bundle",
        "mapped_info.app_url",
        F.col("mapped_info.appl_name").alias("name"),
        F.upper("mapped_info.app_cat").alias("app_cat"),
        "mapped_info.app_detail",
        "mapped_info.app_rank",
        "mapped_info.app_age_grp",
        "mapped_info.app_age_grp2",
        "unique_ifa",
    ).distinct()
    return rows.select(
        "*",
        period_label(start, end).alias("source"),
        update_label(run_date).alias("last_update"),
        platform("bundle").alias("platform"),
    )


def join_segments(base: DataFrame, ref_app: DataFrame) -> DataFrame:
    """Category and segment group per app category; apps without one keep NULLs."""
    reference = ref_app.withColumnRenamed("app_cat", "ref_app_cat")
    joined = lookup_join(base, reference, "app_cat", "ref_app_cat")
    return joined.select(
        "source",
        "bundle",
        "store_cat",
        "category",
        F.lit("").alias("segment"),
        "segment_grp",
        F.col("segment_grp").alias("segment_grp_1"),
        F.lit("").alias("segment_grp_2"),
        "last_update",
        "platform",
        F.col("name").alias("app_name"),
        F.col("app_detail").alias("details"),
        F.col("app_url").alias("link"),
        "app_rank",
        "app_age_grp",
        "app_age_grp2",
    )


def join_persona_index(segmented: DataFrame, ref_persona: DataFrame) -> DataFrame:
    """Persona index per segment group; groups without one keep NULL."""
    joined = lookup_join(segmented, ref_persona, "segment_grp_1", "ref_segment_grp_1")
    return joined.select(*INDEX_COLUMNS)


def bundle_totals(base: DataFrame) -> DataFrame:
    """Devices per app over the distinct metadata rows, before any join repeats them.

    The total of rows without an app is NULL.
    """
    total = F.sum("unique_ifa").cast("double")
    return base.groupBy("bundle").agg(
        F.when(F.col("bundle").isNotNull(), total).alias("ifa_cnt")
    )


def attach_totals(rows: DataFrame, totals: DataFrame, hot_apps: bool = True) -> DataFrame:
    """Every row of an app gets the app's total; a NULL app gets NULL.

    Salted: one app may hold a large part of all rows, and the totals, one row
    per app, are not bounded either. NULL matches NULL, because the IS NOT NULL
    that a plain equality adds to the totals would make their shuffle of distinct
    rows differ from that of the rows, and Spark could not use one for both. Where it is
    known that no app has many rows, ``hot_apps=False`` saves looking for them.
    """
    reference = totals.withColumnRenamed("bundle", "ref_bundle")
    if not hot_apps:
        same = F.col("bundle").eqNullSafe(F.col("ref_bundle"))
        return rows.join(reference, same, "left").drop("ref_bundle")
    joined = salted_left_join(rows, reference, "bundle", "ref_bundle", null_safe=True)
    return joined.drop("ref_bundle")


def segmented_list(
    results: DataFrame,
    ref_app: DataFrame,
    ref_persona: DataFrame,
    start: str,
    end: str,
    run_date: date,
    hot_apps: bool = True,
) -> DataFrame:
    """The whole step: metadata rows to the columns of the master list.

    ``hot_apps=False`` says that the results have about one row per app.
    """
    base = app_base(results, start, end, run_date)
    indexed = join_persona_index(join_segments(base, ref_app), ref_persona)
    return attach_totals(indexed, bundle_totals(base), hot_apps)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values of a column, NULL counted as one of them."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias("distinct_values"))


def with_distinct_values(df: DataFrame, column: str) -> tuple[DataFrame, Callable[[], int]]:
    """The rows, and a function that gives the column's number of distinct values, NULL
    counted as one, after an action on the rows has run to its end.

    For columns of few values: they are gathered as a set beside the action, one per
    task and then on the driver. ``distinct_values`` counts any number of them.
    """
    found = Observation()
    values = F.size(F.collect_set(F.struct(column))).alias("distinct_values")
    return df.observe(found, values), lambda: found.get["distinct_values"]
