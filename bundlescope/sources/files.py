"""Readers of lists and results; sightings have their own module. Every one declares its schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bundlescope import schemas
from bundlescope.operators.merging import trim_column_names
from bundlescope.sources.sinks import CSV_TEXT


def read_known_apps(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.KNOWN_APPS).parquet(path)


def read_master_list(spark: SparkSession, path: str) -> DataFrame:
    """The master list with blanks trimmed off its column names.

    Parquet columns are matched by name, so names are taken from the file.
    """
    return trim_column_names(spark.read.parquet(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header. Empty text reads back as NULL, text may hold line breaks.

    A file is then read by one task; a list is written as many files.
    """
    return spark.read.schema(schema).options(**CSV_TEXT, multiLine=True).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines; a folder without files gives an empty table."""
    return spark.read.schema(schema).json(path)


def read_results_so_far(spark: SparkSession, path: str) -> DataFrame:
    """Earlier metadata results, empty before the first run."""
    try:
        return read_json(spark, path, schemas.METADATA_RESULT)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.METADATA_RESULT)
