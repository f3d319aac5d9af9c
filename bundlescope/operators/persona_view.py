"""The persona table and the view published over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlescope.functions import personas
from bundlescope.schemas import PERSONA_TABLE


def persona_table_rows(master: DataFrame) -> DataFrame:
    """The table's 15 text columns, by name."""
    return master.select(*[F.col(f.name).cast(f.dataType) for f in PERSONA_TABLE.fields])


def persona_view(table: DataFrame, unique_rows: bool = False) -> DataFrame:
    """Every app with its persona, rank and one or two app categories.

    See ``personas.persona_view_query`` for why duplicates go before the tags.
    ``unique_rows`` says the table has one row per app and saves the shuffle.
    """
    rows = table if unique_rows else table.distinct()
    tagged = rows.select("*", F.explode(F.expr(personas.persona_tags())).alias("_tag"))
    return tagged.select(
        *table.columns,
        F.col("_tag.persona").alias("persona"),
        F.expr(personas.persona_rank()).alias("rank"),
        F.col("_tag.app_category").alias("app_category"),
    )
