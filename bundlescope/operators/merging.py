"""Fold a new segmented list into the master list, one row per app."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlescope.functions.rules import refine_segments
from bundlescope.operators.joins import lookup_join, stored_and_measured


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def segment_index_reference(master: DataFrame) -> DataFrame:
    """Distinct segment group and index pairs of the master list that have an index."""
    pairs = master.where(F.col("segment_index").isNotNull())
    return pairs.select("segment_grp_1", "segment_index").distinct()


def smallest_segment_index(master: DataFrame) -> DataFrame:
    """The reference with one index per group, the one that a row per app ends up with.

    Rows that a group's several indexes would make of one row differ in the index
    alone, and the smallest row is kept.
    """
    return segment_index_reference(master).groupBy("segment_grp_1").agg(
        F.min("segment_index").alias("segment_index")
    )


def refresh_segment_index(new: DataFrame, reference: DataFrame) -> DataFrame:
    """Replace a list's index by the reference's; a group with several indexes fans out.

    The reference is a small result of a pass over a whole list, so it is written once and
    measured meanwhile.
    """
    keyed, size = stored_and_measured(reference.withColumnRenamed("segment_grp_1", "_ref_group"), "segment-index")
    joined = lookup_join(new.drop("segment_index"), keyed, "segment_grp_1", "_ref_group", size=size)
    others = [c for c in new.columns if c not in ("segment_grp_1", "segment_index")]
    return joined.select("segment_grp_1", *others, "segment_index")


def align(new: DataFrame, like: DataFrame) -> DataFrame:
    """The other list's columns in its order; extra ones go, missing ones are an error."""
    aligned = new.select(*like.columns)
    different = [a for a, b in zip(aligned.dtypes, like.dtypes) if a != b]
    if different:
        raise ValueError(f"column types differ from the master list: {different}")
    return aligned


def stack(old: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both lists, aligned to the old one."""
    return old.unionByName(align(new, old))


def one_row_per_app(*lists: DataFrame) -> DataFrame:
    """One row per non-blank app: from the earliest list that has it, then the smallest row.

    A minimum over the whole row, so the choice does not depend on row order, and
    map tasks reduce repeated apps before the shuffle.
    """
    columns = lists[0].columns
    ranked = [df.select(F.lit(n).alias("_list"), *columns) for n, df in enumerate(lists)]
    rows = ranked[0]
    for other in ranked[1:]:
        rows = rows.unionByName(other)
    others = [c for c in columns if c != "bundle"]
    best = (
        rows.where(F.col("bundle").isNotNull() & (F.col("bundle") != ""))
        .groupBy("bundle")
        .agg(F.min(F.struct("_list", *others)).alias("_best"))
    )
    return best.select("bundle", *[F.col(f"_best.{c}").alias(c) for c in others]).select(*columns)


def merge_lists(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old list and re-indexed new list, one row per app, old rows first."""
    old, new = trim_column_names(old), trim_column_names(new)
    refreshed = refresh_segment_index(new, smallest_segment_index(old))
    return one_row_per_app(old, align(refreshed, old))


def clean_master_list(old: DataFrame, new: DataFrame) -> DataFrame:
    """The whole step: merge both lists and refine the segments."""
    return refine_segments(merge_lists(old, new))
