"""The monthly refresh end to end: sightings in, persona view out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlescope.fixed_values import BATCH_SIZE, COUNTRIES, MIN_DEVICES
from bundlescope.operators import batching, merging, metadata, persona_view, segmenting, usage


@dataclass(frozen=True)
class Refresh:
    """The tables a refresh produces, each a plan until it is written or read."""

    unknown: DataFrame
    batches: DataFrame
    results: DataFrame
    segmented: DataFrame
    master: DataFrame
    view: DataFrame


def monthly_refresh(
    sightings: DataFrame,
    known: DataFrame,
    done: DataFrame,
    payloads: DataFrame,
    ref_app: DataFrame,
    ref_persona: DataFrame,
    master: DataFrame,
    start: str,
    end: str,
    run_date: date,
    countries: Sequence[str] = COUNTRIES,
    min_devices: int = MIN_DEVICES,
    batch_size: int = BATCH_SIZE,
) -> Refresh:
    """Plan a refresh for one period.

    Numbering the batches runs the sightings part and writes the resulting list, so
    everything after it starts from there and not from the sightings. What a step finds out
    about the size of its result is passed on and not measured again.
    """
    unknown = usage.unknown_apps(usage.in_period(sightings, start, end, countries), known)
    todo = batching.pending(batching.audiences(unknown, min_devices), done)
    batches, size = batching.batched_and_measured(todo, batch_size)
    results = metadata.look_up(batches, payloads, size=size).withColumn(
        "unique_ifa", F.col("unique_ifa").cast("double")
    )
    # An app is in one batch once, so no app has many results.
    segmented = segmenting.segmented_list(
        results, ref_app, ref_persona, start, end, run_date, hot_apps=False
    )
    cleaned = merging.clean_master_list(master, segmented)
    table = persona_view.persona_table_rows(cleaned)
    view = persona_view.persona_view(table, unique_rows=True)
    return Refresh(unknown, batches, results, segmented, cleaned, view)
