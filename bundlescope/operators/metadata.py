"""Store metadata from already-fetched payloads.

Input is one row per app with the payloads fetched for it: ``lookup_json``
(numeric ids), ``html`` (store A page) and ``alt_html`` (store B page). A NULL
payload is a failed fetch. Everything is built-in and map-only. Each parsed
document is a column of its own, so that it is parsed once however many fields
are taken from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlescope import fixed_values as fixed
from bundlescope.functions import html
from bundlescope.functions.text import capitalise, is_numeric_id
from bundlescope.operators.joins import BROADCAST_MAX_ROWS, Size, measured, perhaps_listed

LOOKUP_SCHEMA = "resultCount BIGINT, results ARRAY<MAP<STRING,STRING>>"


def _record(**values: str | Column) -> Column:
    """Metadata struct; fields not given are ''."""
    fields = []
    for name in fixed.METADATA_FIELDS:
        value = values.get(name, "")
        fields.append((F.lit(value) if isinstance(value, str) else value).alias(name))
    return F.struct(*fields)


def not_found() -> Column:
    return _record(app_cat=fixed.NOT_FOUND)


def with_lookup(payloads: DataFrame, name: str = "lookup", wanted: Column | None = None) -> DataFrame:
    """First result of a lookup answer; NULL when there is none or it cannot be read.

    A key the store leaves out is '', one it sends as null stays NULL, and numbers
    become text.
    """
    document = F.from_json("lookup_json", LOOKUP_SCHEMA)
    parsed = payloads.withColumn("_answer", document if wanted is None else F.when(wanted, document))
    first = F.get(F.col("_answer.results"), 0)
    answered = parsed.withColumn("_first", F.when(F.col("_answer.resultCount") > 0, first))
    fields = {
        ours: F.when(F.map_contains_key("_first", key), F.try_element_at("_first", F.lit(key))).otherwise("")
        for ours, key in zip(fixed.METADATA_FIELDS, fixed.LOOKUP_FIELDS)
    }
    record = F.when(F.col("_first").isNotNull(), _record(**fields))
    return answered.withColumn(name, record).drop("_answer", "_first")


def with_store_a(payloads: DataFrame, name: str = "store_a", wanted: Column | None = None) -> DataFrame:
    """Name, category (last part of the genre link) and age badge of a store A page.

    Elements a page lacks are ''. NULL when there is no page, or when an element
    is there without the attribute it is read for.
    """
    page = html.visible(F.col("html"))
    tagged = payloads.withColumn("_page", page if wanted is None else F.when(wanted, page)).withColumns(
        {
            "_genre": html.opening_tag(F.col("_page"), "a", "itemprop", "genre"),
            "_badge": html.opening_tag(F.col("_page"), "img", "class", fixed.AGE_BADGE_CLASS),
        }
    )
    read = tagged.withColumns(
        {
            "_link": html.attribute_of(F.col("_genre"), "href"),
            "_age": html.attribute_of(F.col("_badge"), "alt"),
        }
    )
    usable = (
        F.col("_page").isNotNull()
        & (F.col("_genre").isNull() | F.col("_link").isNotNull())
        & (F.col("_badge").isNull() | F.col("_age").isNotNull())
    )
    category = F.upper(F.element_at(F.split("_link", "/"), -1))
    record = _record(
        app_url=F.concat(F.lit(fixed.STORE_A_URL), F.col("bundle")),
        appl_name=html.inner_text(F.col("_page"), "h1", "itemprop", "name"),
        app_cat=F.coalesce(category, F.lit("")),
        app_age_grp=F.coalesce(F.col("_age"), F.lit("")),
    )
    return read.withColumn(name, F.when(usable, record)).drop(
        "_page", "_genre", "_badge", "_link", "_age"
    )


def with_store_b(payloads: DataFrame, name: str = "store_b", wanted: Column | None = None) -> DataFrame:
    """Name and category (sub-category before category) of a store B page, else NULL."""
    page = html.visible(F.col("alt_html"))
    paged = payloads.withColumn("_page", page if wanted is None else F.when(wanted, page))
    narrow = html.opening_tag(F.col("_page"), "meta", "itemprop", "applicationSubCategory")
    broad = html.opening_tag(F.col("_page"), "meta", "itemprop", "applicationCategory")
    read = paged.withColumn("_meta", F.coalesce(narrow, broad)).withColumn(
        "_content", html.attribute_of(F.col("_meta"), "content")
    )
    usable = F.col("_page").isNotNull() & (F.col("_meta").isNull() | F.col("_content").isNotNull())
    record = _record(
        app_url=F.concat(F.lit(fixed.STORE_B_URL), F.col("bundle")),
        appl_name=html.inner_text(F.col("_page"), "h1", "itemprop", "name"),
        app_cat=F.coalesce(capitalise(F.col("_content")), F.lit("")),
    )
    return read.withColumn(name, F.when(usable, record)).drop("_page", "_meta", "_content")


def store_metadata(payloads: DataFrame) -> DataFrame:
    """``bundle`` and ``mapped_info``: lookup for numeric ids, else store A, then store B.

    What cannot be found anywhere gets the Not Found record; a NULL app stays NULL.
    Only the documents a row needs are parsed, and page text ends here: later
    shuffles carry the short record, not the page.
    """
    numeric = is_numeric_id("bundle")
    rows = with_lookup(payloads, "_lookup", wanted=numeric)
    rows = with_store_a(rows, "_store_a", wanted=~numeric)
    rows = with_store_b(rows, "_store_b", wanted=~numeric & F.col("_store_a").isNull())
    found = (
        F.when(numeric, F.coalesce("_lookup", not_found()))
        .when(~numeric, F.coalesce("_store_a", "_store_b", not_found()))
    )
    return rows.select("bundle", found.alias("mapped_info"))


def one_record_per_app(found: DataFrame) -> DataFrame:
    """One record for an app fetched several times: a found one, and of those the smallest.

    A minimum, so that map tasks reduce a much-fetched app before the shuffle.
    """
    missed = F.col("mapped_info") == not_found()
    best = F.min(F.struct(missed.alias("missed"), "mapped_info"))
    chosen = found.groupBy("bundle").agg(best.alias("_best"))
    return chosen.select("bundle", F.col("_best.mapped_info").alias("mapped_info"))


def asked_for(
    payloads: DataFrame, apps: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, size: Size | None = None
) -> DataFrame:
    """The payloads of the listed apps; beyond ``max_rows`` apps a few others pass.

    Page text is never shuffled: a list that measures small is broadcast, of a longer one
    a filter of bounded size is. ``size`` is the list's where it is known.
    """
    wanted = apps.select("bundle")
    size = size or measured(wanted)
    if size.fits(max_rows):
        return payloads.join(F.broadcast(wanted), "bundle", "left_semi")
    return perhaps_listed(payloads, wanted, "bundle", size.rows)


def look_up(
    apps: DataFrame, payloads: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, size: Size | None = None
) -> DataFrame:
    """Attach ``mapped_info`` to batched apps; an app without payloads is Not Found.

    Payloads of other apps are left out before they are parsed, all of them or, with a
    long list, all but a few, whose records meet no app. What is shuffled are records.
    """
    found = one_record_per_app(store_metadata(asked_for(payloads, apps, max_rows, size)))
    found = found.withColumnRenamed("bundle", "_bundle")
    joined = apps.join(found, apps["bundle"] == found["_bundle"], "left")
    missing = F.col("mapped_info").isNull() & F.col("bundle").isNotNull()
    info = F.when(missing, not_found()).otherwise(F.col("mapped_info"))
    return joined.select(*apps.columns, info.alias("mapped_info"))
