"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundlescope.operators.joins import stored_and_measured
from bundlescope.session import stored
from bundlescope.sources.sightings import existing

#: Batches that share a folder where batches are replaced.
BATCHES_PER_FOLDER = 64

# Text comes back as it was: quotes doubled, blanks kept, line breaks inside quotes.
CSV_TEXT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, replacing what is there, written in parallel."""
    df.write.mode("overwrite").options(**CSV_TEXT).csv(path)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def append_batches(df: DataFrame, path: str, batch: str = "grp") -> None:
    """All batches in one job, the rows of a batch in one file, beside what is there.

    Together with skipping apps that have a result this is a resumable load: a
    run that fails commits nothing and can simply be repeated. Files hold many batches, with
    the batch as a field: a folder for each would be committed one by one by the driver.
    """
    append_json(df.repartitionByRange(batch), path)


def _folder(df: DataFrame, batch: str) -> Column:
    """The folder of a batch: that of its neighbours if batches are numbers, else by hash."""
    if isinstance(df.schema[batch].dataType, T.IntegralType):
        return F.floor(F.col(batch) / BATCHES_PER_FOLDER)
    return F.pmod(F.xxhash64(batch), F.lit(BATCHES_PER_FOLDER))


def replace_batches(df: DataFrame, path: str, batch: str = "grp") -> None:
    """Replace the batches at hand and leave others alone, for one fixed numbered list.

    A folder ``part=N`` holds ``BATCHES_PER_FOLDER`` batches, with the batch as a field: a folder
    for each would be deleted and moved one by one by the driver. Other batches of the folders
    at hand are written again line by line as they are; other folders are not touched.
    """
    spark = df.sparkSession
    lines = df.select(F.to_json(F.struct("*")).alias("value"), F.col(batch).alias("batch"), _folder(df, batch).alias("part"))
    old = spark.read.text(path) if existing(spark, [path]) else None
    if old is not None and batch in old.columns:
        raise ValueError(f"{path} has a folder per batch; write it anew")
    if old is not None and "part" in old.columns:
        lines = stored(lines, "replacing")
        field = T.StructType([df.schema[batch]])
        old = old.select("value", F.from_json("value", field)[batch].alias("batch"), F.col("part").cast("bigint"))
        new = lines.select(F.col("batch").alias("_batch"), F.col("part").alias("_part")).distinct()
        new, size = stored_and_measured(new, "replaced")
        new = F.broadcast(new) if size.fits() else new
        old = old.join(new, F.col("part").eqNullSafe(F.col("_part")), "left_semi")
        lines = lines.unionByName(old.join(new, F.col("batch").eqNullSafe(F.col("_batch")), "left_anti"))
    writer = lines.select("value", "part").write.partitionBy("part").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").text(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
