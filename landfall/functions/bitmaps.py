"""Sets of whole numbers as bitmaps, which can be merged and still count each number once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a bitmap is a BIGINT, shared by 64 numbers.  Spark merges these in hash maps, a few bytes a row.
PLACE_BITS = 6


def code_number(code: Column) -> Column:
    """A code as the number that stands for it alone; one that is no plain whole number stops the job."""
    number = code.try_cast("bigint")
    plain = F.coalesce(number.cast("string") == code, F.lit(False)) & (number >= 0)
    return F.when(code.isNotNull(), F.when(plain, number).otherwise(F.raise_error(F.concat(F.lit("no plain number: "), code)).cast("bigint")))


def bitmap_place(number: Column) -> Column:
    """The bitmap a number belongs to; 64 numbers share one."""
    return F.shiftright(number, PLACE_BITS)


def bits_of(number: Column) -> Column:
    """Aggregate: the bitmap of the numbers of one place; nulls do not count."""
    position = number.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), position)
    return F.coalesce(F.bit_or(bit), F.lit(0).cast("bigint"))


def merged_bits(bits: Column) -> Column:
    """Aggregate: the union of bitmaps of one place."""
    return F.bit_or(bits)


def bits_set(bits: Column) -> Column:
    return F.bit_count(bits)
