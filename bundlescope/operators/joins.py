"""Joins that stay whole and balanced whatever the size and skew of their sides."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundlescope.functions import bitmaps
from bundlescope.session import stored

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
HOT_ROWS = 500_000
#: 64 MB of bits.
FILTER_MAX_BITS = 1 << 29


def _row_bytes(df: DataFrame) -> Column:
    """Upper estimate of a row: text and binary as long as they are, 16 for the rest."""
    sizes = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(field.name), F.lit(0)) + 16)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0)) + 64)
        else:
            sizes.append(F.lit(16))
    return sum(sizes[1:], sizes[0]).cast("bigint")


@dataclass(frozen=True)
class Size:
    """Rows of a table and an upper estimate of their bytes."""

    rows: int
    bytes: int

    def fits(self, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
        return self.rows <= max_rows and self.bytes <= max_bytes


def observed(df: DataFrame) -> tuple[DataFrame, Callable[[], Size]]:
    """The rows, and a function that gives their size after an action on them has run to its end."""
    found = Observation()
    sizes = F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes")
    return df.observe(found, *sizes), lambda: Size(found.get["rows"], found.get["bytes"] or 0)


def measured(df: DataFrame) -> Size:
    """A table's size, observed in one pass without a shuffle of its own."""
    rows, size = observed(df)
    rows.write.format("noop").mode("overwrite").save()
    return size()


def stored_and_measured(df: DataFrame, label: str) -> tuple[DataFrame, Size]:
    """The rows as a table in the shared folder, and its size observed while it is written."""
    rows, size = observed(df)
    return stored(rows, label), size()


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> bool:
    """Measure a side before it is broadcast."""
    return measured(df).fits(max_rows, max_bytes)


def perhaps_listed(
    rows: DataFrame, listed: DataFrame, key: str, listed_rows: int, max_bits: int = FILTER_MAX_BITS
) -> DataFrame:
    """The rows whose key is listed, and a few others, without shuffling any row.

    A filter of one bit per key hash, 16 bits or more a key up to ``max_bits``, is broadcast:
    its size is bounded, whatever the list's. No row of a listed key is lost; of the others
    about one in sixteen passes, and more for a list beyond ``max_bits`` / 16 keys, so a join
    that comes later has to decide. A NULL key is never listed.
    """
    bits = bitmaps.BITS
    while bits < min(16 * listed_rows, max_bits):
        bits *= 2

    def number(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits).cast("bigint")) + 1

    hashed = listed.where(F.col(key).isNotNull()).select(number(F.col(key)).alias("_number"))
    found = hashed.groupBy(bitmaps.bucket(F.col("_number")).alias("_bucket")).agg(
        F.bitmap_construct_agg(bitmaps.position(F.col("_number"))).alias("_bits")
    )
    mine = number(rows[key])
    joined = rows.join(F.broadcast(found), rows[key].isNotNull() & (bitmaps.bucket(mine) == found["_bucket"]))
    return joined.where(bitmaps.has_bit(F.col("_bits"), bitmaps.position(mine))).select(*[rows[c] for c in rows.columns])


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    hot_rows: int = HOT_ROWS,
    null_safe: bool = False,
) -> DataFrame:
    """Left equi join whose hot (or NULL) keys are spread over several tasks.

    A key with more than ``hot_rows`` left rows gets one salt per ``hot_rows`` of
    them, and its right rows are repeated once per salt; all other keys are joined
    as they are. The list of hot keys is measured before it is broadcast; where it
    is too long, a key needs more rows to be hot.

    Left rows are salted by their own content, so a recomputed task salts them
    the same way. Exact copies share a salt; a mass of them is left to the
    adaptive skew join, which can split it because both sides are plain shuffles.
    ``null_safe`` lets NULL match NULL.
    """
    counted = left.groupBy(F.col(left_key).alias("_hot")).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counted.where(F.col("_rows") > hot_rows).select(
        "_hot", F.ceil(F.col("_rows") / hot_rows).alias("_salts")
    )
    if not fits_broadcast(hot):
        return salted_left_join(left, right, left_key, right_key, 2 * hot_rows, null_safe)
    hot = F.broadcast(hot)
    salts = F.coalesce("_salts", F.lit(1).cast("bigint"))
    content = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    salted = left.join(hot, left[left_key].eqNullSafe(hot["_hot"]), "left").select(
        *left.columns, F.pmod(content, salts).alias("_salt")
    )
    repeated = right.join(hot, right[right_key].eqNullSafe(hot["_hot"]), "left").select(
        *right.columns,
        F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("_right_salt"),
    )
    left_column, right_column = salted[left_key], repeated[right_key]
    same = left_column.eqNullSafe(right_column) if null_safe else left_column == right_column
    matches = same & (salted["_salt"] == repeated["_right_salt"])
    return salted.join(repeated, matches, "left").drop("_salt", "_right_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
    size: Size | None = None,
) -> DataFrame:
    """Left join to a reference: broadcast when it measures small, else salted.

    Unmatched and NULL keys keep their row; repeated reference keys fan out. The
    two key columns must have different names, and both are kept. ``size`` is the
    reference's where it is known.
    """
    if (size or measured(right)).fits(max_rows, max_bytes):
        return left.join(F.broadcast(right), left[left_key] == right[right_key], "left")
    return salted_left_join(left, right, left_key, right_key)


def without(left: DataFrame, listed: DataFrame, key: str, broadcast: bool = False) -> DataFrame:
    """Rows whose key is not listed; a NULL key never matches and is kept.

    Not broadcast, the list is reduced to its keys before the shuffle, so that a
    key repeated often does not gather in one task.
    """
    keys = listed.select(key).where(F.col(key).isNotNull())
    return left.join(F.broadcast(keys) if broadcast else keys.distinct(), key, "left_anti")


def duplicate_keys(reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would fan out a join to this reference, with how often they occur."""
    counted = reference.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.where(F.col("occurrences") > 1)
