"""Sets of row or value numbers as bitmaps of Spark's built-in kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 32_768  # bits of a built-in bitmap


def bitmap_of(number: Column) -> Column:
    """Aggregate: the numbers of one bucket (``bucket_of``), from 1."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(number))


def bucket_of(number: Column) -> Column:
    return F.bitmap_bucket_number(number)


def has_bit(bitmap: Column, position: Column) -> Column:
    """Whether the bit at ``position`` (``bitmap_bit_position`` of a number) is set."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), F.pmod(position, F.lit(8)).cast("int")) == 1


def members(bitmap: Column, bucket: Column) -> Column:
    """The numbers of a bitmap as an array; only bytes with a bit are looked into."""
    digits = F.hex(bitmap)
    each = F.transform(
        F.sequence(F.lit(0), F.lit(SPAN // 8 - 1)),
        lambda at: F.struct(at.alias("at"), F.conv(F.substring(digits, at * 2 + 1, F.lit(2)), 16, 10).cast("int").alias("byte")),
    )
    some = F.filter(each, lambda b: b.byte > 0)
    bits = F.transform(
        some,
        lambda b: F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(7)), lambda i: F.getbit(b.byte, i) == 1),
            lambda i: (bucket - 1) * SPAN + b.at * 8 + i + 1,
        ),
    )
    return F.flatten(bits)


def count_union(bitmaps: DataFrame, bucket: str = "bucket", bitmap: str = "bitmap") -> Column:
    """Scalar: how many numbers the bitmaps have together."""
    merged = bitmaps.groupBy(bucket).agg(F.bitmap_or_agg(bitmap).alias("merged"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("merged")), F.lit(0)).alias("n")).scalar()
