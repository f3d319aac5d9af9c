"""Registered queries: every operator over whole tables of one data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlescope import fixed_values as fixed
from bundlescope import schemas
from bundlescope.functions import dates, html, personas
from bundlescope.functions.rules import SEGMENT_RULES, refine_segments
from bundlescope.functions.text import mentions, platform
from bundlescope.operators import batching, joins, merging, metadata, segmenting, usage
from bundlescope.operators.persona_view import persona_table_rows, persona_view
from bundlescope.plans.inputs import Inputs
from bundlescope.plans.monthly_refresh import monthly_refresh
from bundlescope.session import scratch_path
from bundlescope.sources import device_store, files, parts, results, sightings, sinks, tables

PERIOD = ("20000201", "20000229")
MIDDLE = "19990101"
WHOLE_PERIOD = ("19950101", "20021231")
RUN_DATE = date(2000, 3, 1)

_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Inputs(spark, folder))

    return {name: bind(build) for name, build in _QUERIES.items()}


# ---- usage -----------------------------------------------------------------


_LAYOUTS: dict[tuple[str, ...], str] = {}


def _once(i: Inputs, kind: str, write: Callable[[str], None]) -> str:
    """A folder that one session writes once for all queries over the same data."""
    key = (i.spark.sparkContext.applicationId, i.folder, kind)
    if key not in _LAYOUTS:
        path = scratch_path(i.spark, kind)
        write(path)
        _LAYOUTS[key] = path
    return _LAYOUTS[key]


def _by_key(i: Inputs) -> str:
    """The sightings as files by country and day."""

    def write(path: str) -> None:
        rows = i.sightings().repartition("country", "date")
        rows.write.partitionBy("country", "date").parquet(path)

    return _once(i, "sightings", write)


def _records(i: Inputs) -> DataFrame:
    """The sightings as plain files, for queries that read them several times."""
    rows = i.sightings()
    path = _once(i, "records", rows.write.parquet)
    return i.spark.read.schema(rows.schema).parquet(path)


@query
def sightings_exploded(i: Inputs) -> DataFrame:
    return usage.device_apps(i.sightings(), "country", "date")


@query
def sightings_pruned(i: Inputs) -> DataFrame:
    """One month read from files; other days and countries are neither opened nor listed."""
    chosen = sightings.read_sightings(i.spark, _by_key(i), *PERIOD)
    return usage.device_apps(chosen, "country", "date")


@query
def sightings_by_path(i: Inputs) -> DataFrame:
    """All days from their folders, where country and day are read off the path."""
    read = sightings.read_sightings_by_path(
        i.spark, f"{_by_key(i)}/", *WHOLE_PERIOD, layout=sightings.KEYED, skip_missing=True
    )
    return usage.device_apps(read, "country", "date")


@query
def sightings_from_table(i: Inputs) -> DataFrame:
    """One month through a catalog table that knows the folder of each day."""
    root, table = f"{_by_key(i)}/", f"bundlescope_sightings_{uuid.uuid4().hex}"
    sightings.create_sightings_table(i.spark, table, root)
    sightings.add_days(i.spark, table, root, sightings.keyed_days(i.spark, root), sightings.KEYED)
    return usage.device_apps(sightings.read_sightings_table(i.spark, table, *PERIOD), "country", "date")


@query
def missing_partitions(i: Inputs) -> DataFrame:
    return usage.missing_partitions(i.spark, i.sightings(), *WHOLE_PERIOD)


@query
def unique_devices(i: Inputs) -> DataFrame:
    apps = usage.device_apps(i.sightings(), "country")
    return usage.unique_devices(apps, "country", "bundle")


@query
def unique_devices_by_day(i: Inputs) -> DataFrame:
    """The same from stored device sets, the second half's days added to the first's.

    Lists of one device only, so that both forms of a set occur.
    """
    root, table = scratch_path(i.spark, "devices"), f"bundlescope_devices_{uuid.uuid4().hex}"
    first = F.col("date") < MIDDLE
    records = _records(i)
    for part in (records.where(first), records.where(~first)):
        device_store.add_sightings(part, table, root, buckets=8, sparse=1)
    return device_store.unique_devices(i.spark, root, "00000000", "99999999", "country", "bundle")


@query
def known_apps(i: Inputs) -> DataFrame:
    return usage.categorised(i.view("fx_known_apps"))


@query
def known_apps_file(i: Inputs) -> DataFrame:
    """The known list written and read back as a file."""
    path = scratch_path(i.spark, "known")
    sinks.write_parquet(i.view("fx_known_apps"), path)
    return usage.categorised(files.read_known_apps(i.spark, path))


@query
def unknown_apps(i: Inputs) -> DataFrame:
    return usage.unknown_apps(i.sightings(), i.view("fx_known_apps"))


@query
def unknown_apps_large_list(i: Inputs) -> DataFrame:
    """The other way round, for a known list too large to broadcast."""
    return usage.unknown_apps(i.sightings(), i.view("fx_known_apps"), max_rows=0)


@query
def union_of_countries(i: Inputs) -> DataFrame:
    """Separate inputs per country, each read from its own folders, appended."""
    known = i.view("fx_known_apps")
    small = joins.fits_broadcast(usage.categorised(known).select("bundle"))
    root = _by_key(i)
    countries = [
        usage.unknown_apps(
            sightings.read_sightings(i.spark, root, *WHOLE_PERIOD, [country]), known, small=small
        )
        for country in fixed.COUNTRIES
    ]
    whole = countries[0]
    for one in countries[1:]:
        whole = whole.union(one)
    return whole.select("bundle", "unique_ifa")


# ---- batching --------------------------------------------------------------


@query
def audience_threshold(i: Inputs) -> DataFrame:
    return batching.audiences(unknown_apps(i))


@query
def largest_audiences(i: Inputs) -> DataFrame:
    return batching.largest_first(unknown_apps(i))


@query
def first_audience(i: Inputs) -> DataFrame:
    """The largest audience: a top-1, planned as one and not as a full sort."""
    return batching.largest_first(batching.audiences(unknown_apps(i))).limit(1)


@query
def resume_pending(i: Inputs) -> DataFrame:
    return batching.pending(batching.audiences(unknown_apps(i)), i.view("fx_done"))


@query
def resume_pending_bucketed(i: Inputs) -> DataFrame:
    """The same against results in a table bucketed by app, filled by two runs."""
    path, table = scratch_path(i.spark, "results"), f"bundlescope_results_{uuid.uuid4().hex}"
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.METADATA_RESULT.fields[1:]]
    done = i.view("fx_done").select("bundle", *empty)
    numeric = platform("bundle") == "IOS"
    for part in (done.where(numeric), done.where(~numeric)):
        results.append_results(part, table, path, buckets=8)
    return batching.pending(batching.audiences(unknown_apps(i)), results.results_table(i.spark, table))


def _all_audiences(i: Inputs) -> DataFrame:
    return batching.audiences(unique_devices(i), 0).where(F.col("bundle").isNotNull())


@query
def batch_numbers(i: Inputs) -> DataFrame:
    return batching.batched(_all_audiences(i))


@query
def batch_summary(i: Inputs) -> DataFrame:
    return batching.batch_summary(batching.batched(_all_audiences(i), 50))


@query
def batch_count(i: Inputs) -> DataFrame:
    return batching.batch_count(batching.batched(_all_audiences(i)))


@query
def one_batch(i: Inputs) -> DataFrame:
    return batching.one_batch(batching.batched(_all_audiences(i), 50), 2)


# ---- metadata --------------------------------------------------------------


def _fields(df: DataFrame, record: str) -> DataFrame:
    return df.select("bundle", f"{record}.*")


@query
def lookup_metadata(i: Inputs) -> DataFrame:
    read = metadata.with_lookup(i.payloads())
    record = F.coalesce("lookup", metadata.not_found()).alias("lookup")
    return _fields(read.select("bundle", record), "lookup")


@query
def store_a_metadata(i: Inputs) -> DataFrame:
    return _fields(metadata.with_store_a(i.payloads()), "store_a")


@query
def store_b_metadata(i: Inputs) -> DataFrame:
    return _fields(metadata.with_store_b(i.payloads()), "store_b")


@query
def metadata_fallback(i: Inputs) -> DataFrame:
    return _fields(metadata.store_metadata(i.payloads()), "mapped_info")


@query
def batch_metadata(i: Inputs) -> DataFrame:
    """Metadata attached to numbered apps; apps without payloads are Not Found."""
    looked_up = metadata.look_up(batching.batched(_all_audiences(i)), i.payloads())
    return looked_up.select("bundle", "unique_ifa", "rn", "grp", "mapped_info.*")


@query
def batch_metadata_large_list(i: Inputs) -> DataFrame:
    """The other way round, for a list of apps too long to broadcast."""
    batches = batching.batched(_all_audiences(i))
    looked_up = metadata.look_up(batches, i.payloads(), max_rows=0)
    return looked_up.select("bundle", "unique_ifa", "rn", "grp", "mapped_info.*")


@query
def batch_append(i: Inputs) -> DataFrame:
    """Results looked up and appended by batch, read back, resumed, and appended again."""
    path = scratch_path(i.spark, "results")
    listed = _all_audiences(i)
    for todo in (listed.where(platform("bundle") == "IOS"), listed):
        pending = batching.pending(todo, files.read_results_so_far(i.spark, path))
        found = metadata.look_up(batching.batched(pending, 50), i.payloads())
        sinks.append_batches(found, path)
    return files.read_results_so_far(i.spark, path).select("bundle", "unique_ifa", "mapped_info.*")


@query
def page_titles(i: Inputs) -> DataFrame:
    page = html.visible(F.col("html"))
    pages = i.table("pages").select("page_id", page.alias("page"))
    return pages.select(
        "page_id",
        html.inner_text(F.col("page"), "title").alias("title"),
        html.inner_text(F.col("page"), "h1").alias("heading"),
        html.attribute_of(html.opening_tag(F.col("page"), "html"), "lang").alias("lang"),
    )


# ---- segmenting ------------------------------------------------------------


def _base(i: Inputs) -> DataFrame:
    return segmenting.app_base(i.metadata_results(), *PERIOD, RUN_DATE)


@query
def app_base(i: Inputs) -> DataFrame:
    return _base(i)


@query
def platforms(i: Inputs) -> DataFrame:
    return i.view("fx_new_list").select("bundle", platform("bundle").alias("platform"))


@query
def segment_join(i: Inputs) -> DataFrame:
    return segmenting.join_segments(_base(i), i.view("fx_ref_app"))


@query
def segment_join_large_reference(i: Inputs) -> DataFrame:
    """The salted way, for a reference too large to broadcast."""
    base = _base(i).select("bundle", "app_cat", "unique_ifa")
    reference = i.view("fx_ref_app").withColumnRenamed("app_cat", "ref_app_cat")
    joined = joins.lookup_join(base, reference, "app_cat", "ref_app_cat", max_rows=0)
    return joined.select("bundle", "app_cat", "unique_ifa", "store_cat", "segment_grp")


@query
def persona_index_join(i: Inputs) -> DataFrame:
    return segmenting.join_persona_index(segment_join(i), i.view("fx_ref_persona"))


@query
def bundle_totals(i: Inputs) -> DataFrame:
    base = _base(i)
    rows = base.select("bundle", "unique_ifa")
    return segmenting.attach_totals(rows, segmenting.bundle_totals(base))


@query
def segmented_list(i: Inputs) -> DataFrame:
    return segmenting.segmented_list(
        i.metadata_results(), i.view("fx_ref_app"), i.view("fx_ref_persona"), *PERIOD, RUN_DATE
    )


@query
def segment_group_count(i: Inputs) -> DataFrame:
    return segmenting.distinct_values(i.view("fx_persona_list"), "segment_grp_1")


# ---- merging and rules -----------------------------------------------------


@query
def segment_index_reference(i: Inputs) -> DataFrame:
    return merging.segment_index_reference(i.view("fx_old_list"))


@query
def repeated_reference_keys(i: Inputs) -> DataFrame:
    return joins.duplicate_keys(segment_index_reference(i), ["segment_grp_1"])


@query
def refresh_segment_index(i: Inputs) -> DataFrame:
    return merging.refresh_segment_index(i.view("fx_new_list"), segment_index_reference(i))


@query
def stacked_lists(i: Inputs) -> DataFrame:
    return merging.stack(i.view("fx_old_list"), refresh_segment_index(i))


@query
def merged_list(i: Inputs) -> DataFrame:
    return merging.merge_lists(i.view("fx_old_list"), i.view("fx_new_list"))


@query
def merged_list_in_parts(i: Inputs) -> DataFrame:
    """The same as a fold that rewrites only the parts of a list that get new apps."""
    path, table = scratch_path(i.spark, "parts"), f"bundlescope_parts_{uuid.uuid4().hex}"
    parts.create_parts(i.view("fx_old_list"), table, path, "1", parts=16)
    parts.fold(i.view("fx_new_list"), table, path, "2", refine=False)
    return parts.read_parts(i.spark, table)


def _rule_query(position: int) -> Callable[[Inputs], DataFrame]:
    def build(i: Inputs) -> DataFrame:
        """One rule on the unrefined list, each app's group being its reference group."""
        rows = i.view("fx_persona_list")
        return refine_segments(rows, SEGMENT_RULES[position : position + 1]).select(
            "bundle", "app_name", "details", "segment_grp", "segment_grp_1"
        )

    return build


for _position, _rule in enumerate(SEGMENT_RULES):
    _QUERIES[f"rule_{_rule.name}"] = _rule_query(_position)


@query
def refined_segments(i: Inputs) -> DataFrame:
    return refine_segments(i.view("fx_persona_list"))


@query
def cleaned_list(i: Inputs) -> DataFrame:
    return merging.clean_master_list(i.view("fx_old_list"), i.view("fx_new_list"))


@query
def document_keywords(i: Inputs) -> DataFrame:
    """The keyword matcher on long text."""
    lists = {
        "budget": fixed.BUDGET_WORDS,
        "wealth": fixed.WEALTH_WORDS,
        "entertainment": fixed.ENTERTAINMENT_WORDS,
        "fitness": fixed.FITNESS_WORDS,
        "phone": fixed.PHONE_WORDS,
    }
    hits = [mentions(["text", "source"], words).alias(name) for name, words in lists.items()]
    return i.table("documents").select("doc_id", *hits)


# ---- personas --------------------------------------------------------------


@query
def persona_names(i: Inputs) -> DataFrame:
    return i.view("fx_persona_list").select(
        "bundle",
        "segment_grp_1",
        F.expr(personas.persona_name()).alias("persona"),
        F.expr(personas.persona_name(primary=False)).alias("second_persona"),
    )


@query
def persona_ranks(i: Inputs) -> DataFrame:
    rank = F.expr(personas.persona_rank()).alias("rank")
    return i.view("fx_persona_list").select("bundle", "segment_grp_1", rank)


@query
def category_primary(i: Inputs) -> DataFrame:
    category = F.expr(personas.app_category()).alias("app_category")
    return i.view("fx_persona_list").select("bundle", "category", category)


@query
def category_second(i: Inputs) -> DataFrame:
    category = F.expr(personas.second_category()).alias("app_category")
    tagged = i.view("fx_persona_list").where(F.expr(personas.has_second_tag()))
    return tagged.select("bundle", "category", category)


@query
def persona_table(i: Inputs) -> DataFrame:
    return persona_table_rows(i.view("fx_persona_list"))


@query
def persona_view_rows(i: Inputs) -> DataFrame:
    return persona_view(persona_table(i))


# ---- dates -----------------------------------------------------------------


@query
def reporting_month(i: Inputs) -> DataFrame:
    day = F.col("run_date")
    days = i.table("orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()
    return days.select(
        dates.day_string(day).alias("run_day"),
        dates.month_start(day).alias("start_date"),
        dates.month_end(day).alias("end_date"),
        dates.run_label(day).alias("run_label"),
        dates.lookback(day).alias("lookback_month_id"),
        dates.lookback(day, "yyyy").alias("lookback_year"),
        dates.lookback(day, "MM").alias("lookback_month"),
        dates.update_label(day).alias("last_update"),
        dates.period_label(dates.month_start(day), dates.month_end(day)).alias("source"),
    )


# ---- sinks and tables ------------------------------------------------------


@query
def csv_roundtrip(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "csv")
    sinks.write_csv(unknown_apps(i).select("bundle", "unique_ifa"), path)
    return files.read_csv(i.spark, path, schemas.UNKNOWN_APPS)


@query
def csv_reference(i: Inputs) -> DataFrame:
    """A master list exported and read back as CSV: blank text comes back as NULL."""
    path = scratch_path(i.spark, "csv")
    sinks.write_csv(i.view("fx_persona_list"), path)
    return files.read_csv(i.spark, path, schemas.MASTER_LIST)


@query
def json_append(i: Inputs) -> DataFrame:
    """Two appends, then what is left to do against the results read back."""
    path = scratch_path(i.spark, "json")
    rows = i.metadata_results()
    numeric = platform("bundle") == "IOS"
    for part in (rows.where(numeric), rows.where(~numeric)):
        sinks.append_json(part, path)
    read = files.read_results_so_far(i.spark, path)
    return read.select("bundle", "unique_ifa", "mapped_info.*")


@query
def json_batches(i: Inputs) -> DataFrame:
    """Batches written twice, as after a failed run: each batch is there once."""
    path = scratch_path(i.spark, "batches")
    batches = batching.batched(_all_audiences(i))
    for _ in range(2):
        sinks.replace_batches(batches, path)
    schema = "bundle string, unique_ifa bigint, rn bigint, grp bigint"
    return i.spark.read.schema(schema).json(path).select("bundle", "unique_ifa", "rn", "grp")


@query
def parquet_roundtrip(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "parquet")
    sinks.write_parquet(i.view("fx_persona_list"), path)
    return files.read_master_list(i.spark, path)


@query
def sightings_by_country(i: Inputs) -> DataFrame:
    """Sightings written by country and read back with other countries pruned."""
    path = scratch_path(i.spark, "sightings")
    i.sightings().write.partitionBy("country").parquet(path)
    read = i.spark.read.schema(
        "ifa string, app array<struct<bundle: string>>, date string, country string"
    ).parquet(path)
    return usage.device_apps(usage.in_period(read, *WHOLE_PERIOD), "country", "date")


@query
def versioned_overwrite(i: Inputs) -> DataFrame:
    """The master list replaced by a version computed from itself."""
    path = scratch_path(i.spark, "master")
    table = f"bundlescope_master_{uuid.uuid4().hex}"
    tables.publish_version(i.view("fx_old_list"), table, path, "1")
    old = i.spark.table(table)
    tables.publish_version(merging.clean_master_list(old, i.view("fx_new_list")), table, path, "2")
    return i.spark.table(table)


@query
def publish_table(i: Inputs) -> DataFrame:
    """Drop, create and publish the persona table, then the view over it."""
    path = scratch_path(i.spark, "personas")
    run = uuid.uuid4().hex
    table, view = f"bundlescope_personas_{run}", f"bundlescope_persona_view_{run}"
    tables.drop_view(i.spark, view)
    tables.drop_table(i.spark, table)
    tables.publish_persona_table(i.view("fx_persona_list"), table, path, "1")
    tables.publish_persona_view(i.spark, view, table)
    return i.spark.table(view)


@query
def monthly_refresh_view(i: Inputs) -> DataFrame:
    return monthly_refresh(
        sightings=i.sightings(),
        known=i.view("fx_known_apps"),
        done=i.view("fx_done"),
        payloads=i.payloads(),
        ref_app=i.view("fx_ref_app"),
        ref_persona=i.view("fx_ref_persona"),
        master=i.view("fx_old_list"),
        start=WHOLE_PERIOD[0],
        end=WHOLE_PERIOD[1],
        run_date=RUN_DATE,
    ).view
