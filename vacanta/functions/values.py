"""Numbers and timestamps read leniently: what cannot be read becomes null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark's own string cast also takes Java suffixes such as "5d"; this does not.
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def text_to_number(c: Column) -> Column:
    """Text as a double, null when it is not a number."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def numeric_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a double; an absent column reads as all null."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return text_to_number(F.col(name))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
    return F.lit(None).cast("double")


def text_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as text; an absent column reads as all null."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    return F.col(name).cast("string")


def finite_or_null(c: Column) -> Column:
    """NaN and infinities have no JSON form, so they turn into null."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def timestamp_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a UTC timestamp, each row read by its own format.

    Deviation on purpose: rows written in a second valid format are kept, where a
    reader that fixes the format on the first row would null them.
    """
    if name not in df.columns:
        return F.lit(None).cast("timestamp")
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(F.col(name))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp")
    return F.lit(None).cast("timestamp")


BUCKETS = {"W": "WEEK", "M": "MONTH", "D": "DAY"}


def bucket_start(ts: Column, freq: str) -> Column:
    """First day of the week (Monday), month or day holding ``ts``, as a date."""
    if freq not in BUCKETS:
        raise ValueError(f"freq must be one of {', '.join(BUCKETS)}: {freq!r}")
    return F.date_trunc(BUCKETS[freq], ts).cast("date")


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def rounded_pounds(c: Column) -> Column:
    """Half-even to whole pounds."""
    return F.bround(c, 0).cast("bigint")
