"""Sinks: CSV with flattened lists, Parquet, and JSON reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacanta.fixed_values import SKILL_SEPARATOR
from vacanta.functions.values import finite_or_null


# White space at the ends of a value is data. CSV reads '' and null both as null.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with list columns joined by the separator, for raw and processed postings."""
    joined = {
        f.name: F.array_join(f.name, SKILL_SEPARATOR)
        for f in df.schema
        if isinstance(f.dataType, T.ArrayType)
    }
    flat = df.withColumns(joined) if joined else df
    flat.write.mode("errorifexists").options(**_CSV).csv(path)


def json_ready(c: Column, kind: T.DataType) -> Column:
    """``c`` with every NaN or infinity at any depth replaced by null."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return finite_or_null(c)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda item: json_ready(item, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [json_ready(c[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def as_json(df: DataFrame, output: str = "payload") -> DataFrame:
    """Each row as one valid JSON object, nulls written out."""
    fields = [json_ready(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema]
    return df.select(
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(output)
    )


def write_json_report(df: DataFrame, path: str) -> None:
    as_json(df).write.mode("overwrite").text(path)
