"""Sets of whole numbers from 1 on as Spark's bitmaps of 32768 bits, 4096 bytes each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 32768
BYTES = BITS // 8


def bucket(number: Column) -> Column:
    """The bitmap that a number from 1 on belongs to, from 1 on."""
    return F.bitmap_bucket_number(number)


def position(number: Column) -> Column:
    """A number's bit in its bitmap, from 0 on."""
    return F.bitmap_bit_position(number)


def has_bit(bitmap: Column, at: Column) -> Column:
    """Whether a bit is set. The byte is read as a Latin-1 character, whose code it is."""
    byte = F.ascii(F.decode(F.substring(bitmap, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
    mask = F.element_at(F.array(*[F.lit(1 << n) for n in range(8)]), (at % 8 + 1).cast("int"))
    return byte.bitwiseAND(mask) != 0
