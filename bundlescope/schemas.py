"""Declared schemas: no source in this package relies on inference."""

from pyspark.sql import types as T

from bundlescope.fixed_values import METADATA_FIELDS


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


SIGHTINGS = T.StructType(
    [
        T.StructField("ifa", T.StringType()),
        T.StructField("app", T.ArrayType(T.StructType(_strings("bundle")))),
    ]
)
SIGHTING_PARTITIONS = T.StructType(_strings("country", "date"))

KNOWN_APPS = T.StructType(_strings("bundle", "category"))

UNKNOWN_APPS = T.StructType(
    [T.StructField("bundle", T.StringType()), T.StructField("unique_ifa", T.LongType())]
)

METADATA = T.StructType(_strings(*METADATA_FIELDS))

METADATA_RESULT = T.StructType(
    [
        T.StructField("bundle", T.StringType()),
        T.StructField("unique_ifa", T.DoubleType()),
        T.StructField("rn", T.LongType()),
        T.StructField("grp", T.LongType()),
        T.StructField("mapped_info", METADATA),
    ]
)

PAYLOADS = T.StructType(_strings("bundle", "lookup_json", "html", "alt_html"))

CATEGORY_REFERENCE = T.StructType(_strings("app_cat", "store_cat", "category", "segment_grp"))

PERSONA_REFERENCE = T.StructType(_strings("ref_segment_grp_1", "segment_index"))

MASTER_LIST = T.StructType(
    _strings(
        "source",
        "bundle",
        "store_cat",
        "category",
        "segment",
        "segment_grp",
        "segment_grp_1",
        "segment_grp_2",
        "segment_index",
        "last_update",
        "platform",
        "app_name",
        "details",
        "link",
        "app_rank",
        "app_age_grp",
        "app_age_grp2",
    )
    + [T.StructField("ifa_cnt", T.DoubleType())]
)

PERSONA_TABLE = T.StructType(
    _strings(
        "source",
        "bundle",
        "store_cat",
        "category",
        "segment_grp",
        "segment_grp_1",
        "segment_index",
        "last_update",
        "platform",
        "app_name",
        "link",
        "app_rank",
        "ifa_cnt",
        "app_age_grp",
        "app_age_grp2",
    )
)
