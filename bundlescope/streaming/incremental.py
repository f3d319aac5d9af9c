"""Metadata for payloads as they arrive.

The batch way to resume is ``batching.pending`` plus ``sinks.append_batches``. The
same as a stream: the checkpoint remembers which payload files are done, each
trigger handles the new ones and appends their results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from bundlescope.operators.metadata import store_metadata
from bundlescope.schemas import PAYLOADS


def payload_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(PAYLOADS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def append_metadata(payloads: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start one run over everything that is new, append its results and stop.

    ``checkpoint`` must outlive the run and be reachable from all executors.
    """
    return (
        store_metadata(payloads)
        .writeStream.format("json")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
