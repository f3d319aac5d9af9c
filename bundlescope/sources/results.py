"""Metadata results bucketed by app, so that resuming moves no earlier result.

The results grow with every run, the apps of a run do not. In a table bucketed by app
the results of an app are always in the same bucket, in order, and Spark reads them as
already shuffled: a run shuffles its own apps to the buckets and nothing else.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope import schemas
from bundlescope.sources.tables import checked_name

#: So many that a bucket of all results stays within some hundred MB; fixed for a table's life.
BUCKETS = 200


def append_results(df: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> None:
    """Append results, one sorted file per bucket and run; the first run creates the table.

    A run that fails commits nothing and can be repeated, since apps with a result are
    left out. A number of buckets other than the table's is an error.
    """
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.METADATA_RESULT.fields]
    placed = df.select(*columns).repartition(buckets, "bundle")
    writer = placed.write.format("parquet").mode("append").option("path", path)
    writer.bucketBy(buckets, "bundle").sortBy("bundle").saveAsTable(checked_name(table))


def results_table(spark: SparkSession, table: str) -> DataFrame:
    """The results so far, empty before the first run."""
    if spark.catalog.tableExists(checked_name(table)):
        return spark.table(table)
    return spark.createDataFrame([], schemas.METADATA_RESULT)


def compact_results(spark: SparkSession, table: str, new_table: str, path: str, buckets: int = BUCKETS) -> None:
    """The same results in a new table with one file per bucket, after many runs.

    Read as plain files: rows that Spark takes for shuffled already would stay in many.
    """
    if spark.catalog.tableExists(checked_name(new_table)):
        raise AnalysisException(f"there is a table {new_table} already")
    described = spark.sql(f"DESCRIBE FORMATTED {checked_name(table)}").where("col_name = 'Location'")
    rows = spark.read.schema(schemas.METADATA_RESULT).parquet(described.first()["data_type"])
    append_results(rows, new_table, path, buckets)
