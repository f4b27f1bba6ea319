"""Explicit schemas: types are never inferred, and ids are always text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacanta.fixed_values import RAW_COLUMNS, REQUIRED_COLUMNS

_TEXT = T.StringType()

# One advert as a search API returns it; every part may be missing.
ADVERT = T.StructType(
    [
        T.StructField("id", _TEXT),
        T.StructField("title", _TEXT),
        T.StructField("company", T.StructType([T.StructField("display_name", _TEXT)])),
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("display_name", _TEXT),
                    T.StructField("area", T.ArrayType(_TEXT)),
                ]
            ),
        ),
        T.StructField("description", _TEXT),
        T.StructField("salary_min", T.DoubleType()),
        T.StructField("salary_max", T.DoubleType()),
        T.StructField("salary_is_predicted", _TEXT),
        T.StructField("contract_type", _TEXT),
        T.StructField("contract_time", _TEXT),
        T.StructField("category", T.StructType([T.StructField("label", _TEXT)])),
        T.StructField("created", _TEXT),
        T.StructField("redirect_url", _TEXT),
    ]
)

# Raw postings at rest. Salaries and times stay text here and are read leniently
# by the operators, so a bad value becomes null instead of losing the row.
RAW = T.StructType([T.StructField(name, _TEXT) for name in RAW_COLUMNS])


def require_columns(df: DataFrame, source: str = "input", needed=tuple(REQUIRED_COLUMNS)):
    """Raise before any job runs when ``df`` lacks a needed column."""
    missing = [name for name in needed if name not in df.columns]
    if missing:
        raise ValueError(f"{source} lacks the column(s) {', '.join(missing)}")
    return df


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the schema's columns; absent ones are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
