"""Catalog tables and views: versioned publication of the master list, persona view."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from bundlescope.functions.personas import persona_view_query
from bundlescope.operators.persona_view import persona_table_rows
from bundlescope.schemas import PERSONA_TABLE


def checked_name(identifier: str) -> str:
    if not re.fullmatch(r"\w+(\.\w+){0,2}", identifier):
        raise ValueError(f"not a table name: {identifier!r}")
    return identifier


def checked_location(path: str) -> str:
    if "'" in path or "\\" in path:
        raise ValueError(f"not a usable location: {path!r}")
    return f"'{path}'"


def drop_table(spark: SparkSession, table: str) -> None:
    """Forget an external table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {checked_name(table)}")


def drop_view(spark: SparkSession, view: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {checked_name(view)}")


def external_table(spark: SparkSession, table: str, columns: str, location: str) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {checked_name(table)} ({columns}) "
        f"USING PARQUET LOCATION {checked_location(location)}"
    )


def publish_version(df: DataFrame, table: str, root: str, version: str) -> str:
    """Write a new version beside the earlier ones, then point the table at it.

    Never the folder that is being read, so the new list may be computed from the
    table itself; readers see the old version or the new one. A version that
    exists already is an error: repeat a failed write under another name. So are
    columns that are not the table's: they would read as NULL from then on.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(checked_name(table)) and df.dtypes != spark.table(table).dtypes:
        raise ValueError(f"columns differ from those of {table}: {df.dtypes}")
    location = f"{root.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(location)
    if spark.catalog.tableExists(checked_name(table)):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {checked_location(location)}")
        spark.catalog.refreshTable(table)
    else:
        columns = ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
        external_table(spark, table, columns, location)
    return location


def publish_persona_table(master: DataFrame, table: str, root: str, version: str) -> str:
    return publish_version(persona_table_rows(master), table, root, version)


def publish_persona_view(
    spark: SparkSession, view: str, table: str, unique_rows: bool = False
) -> None:
    """Create or replace the permanent persona view over a persona table."""
    query = persona_view_query(checked_name(table), PERSONA_TABLE.fieldNames(), unique_rows)
    spark.sql(f"CREATE OR REPLACE VIEW {checked_name(view)} AS {query}")
