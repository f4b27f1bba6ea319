"""Scans: advert JSON, posting CSV, stored Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacanta.fixed_values import RAW_COLUMNS, SKILL_SEPARATOR
from vacanta.functions.text import strip
from vacanta.functions.values import numeric_column, timestamp_column
from vacanta.sources.schema import ADVERT, RAW

CORRUPT = "_corrupt"
_CSV = {"header": True, "quote": '"', "escape": '"'}


def region_of(area: Column) -> Column:
    """The broad region: the second element of the hierarchy, else its only one.

    A null in second place stays null.
    """
    return F.when(F.size(area) > 1, F.get(area, F.lit(1))).otherwise(F.get(area, F.lit(0)))


def flatten_adverts(adverts: DataFrame, query: Column, collected_at: Column) -> DataFrame:
    """Nested adverts (columns of ``ADVERT``) as raw posting rows."""

    def or_empty(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    computed = {
        "title": strip(or_empty("title")),
        "company": or_empty("company.display_name"),
        "region": region_of(F.col("location.area")),
        "location": or_empty("location.display_name"),
        "description": or_empty("description"),
        "category": or_empty("category.label"),
        "query": query,
        "collected_at": collected_at,
    }
    return adverts.select(
        *[computed.get(name, F.col(name)).alias(name) for name in RAW_COLUMNS]
    )


def parse_adverts(df: DataFrame, text: str, query: Column, collected_at: Column) -> DataFrame:
    """Raw posting rows from a column of advert JSON."""
    nested = df.select("*", F.from_json(text, ADVERT).alias("_advert"))
    kept = [name for name in df.columns if name not in ADVERT.fieldNames()]
    return flatten_adverts(nested.select(*kept, "_advert.*"), query, collected_at)


def _scan_adverts(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Lines below ``path/query=<words>/`` parsed, with the words and the file's facts.

    Lines are read as text and parsed here, so that a line that is not JSON can be
    told apart whatever columns the caller goes on to use.
    """
    source = spark.readStream if streaming else spark.read
    schema = T.StructType([*ADVERT.fields, T.StructField(CORRUPT, T.StringType())])
    lines = source.schema("value string, query string").text(path)
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    return lines.filter(F.trim("value") != "").select(
        "query",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_written"),
        parsed.alias("_advert"),
    )


def read_searches(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Every search below ``path`` as one raw table.

    Lines that are not JSON are left out and do not fail the others; see
    :func:`rejected_records`. The collection time is the file's write time.
    """
    good = _scan_adverts(spark, path, streaming).filter(F.col(f"_advert.{CORRUPT}").isNull())
    adverts = good.select("query", "_written", "_advert.*")
    return flatten_adverts(adverts, F.col("query"), F.col("_written").cast("string"))


def rejected_records(spark: SparkSession, path: str) -> DataFrame:
    """Lines below ``path`` that are not JSON: ``(query, file, record)``."""
    record = F.col(f"_advert.{CORRUPT}")
    return (
        _scan_adverts(spark, path)
        .filter(record.isNotNull())
        .select("query", F.col("_file").alias("file"), record.alias("record"))
    )


def read_raw_csv(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """Raw postings from CSV.

    Values may hold line breaks, so a file is read by one task. Where the writer is known
    to have none, ``line_breaks=False`` lets Spark split large files.
    """
    return spark.read.schema(RAW).options(**_CSV, multiLine=line_breaks).csv(path)


def split_skills(c: Column) -> Column:
    """A separated string as a list; null gives the empty list."""
    pieces = F.split(F.coalesce(c, F.lit("")), f"[{SKILL_SEPARATOR}]")
    return F.filter(pieces, lambda piece: piece != "")


def read_processed_csv(
    spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = True
) -> DataFrame:
    """Processed postings written by ``write_csv``; ``schema`` is theirs.

    ``line_breaks`` as in :func:`read_raw_csv`.
    """
    as_text = T.StructType(
        [
            T.StructField(f.name, T.StringType()) if _reads_from_text(f) else f
            for f in schema
        ]
    )
    df = spark.read.schema(as_text).options(**_CSV, multiLine=line_breaks).csv(path)
    restored = {
        f.name: timestamp_column(df, f.name)
        if isinstance(f.dataType, T.TimestampType)
        else split_skills(F.col(f.name))
        if isinstance(f.dataType, T.ArrayType)
        else numeric_column(df, f.name)
        for f in schema
        if _reads_from_text(f)
    }
    # A CSV cell cannot tell '' from null; cleaned texts are never null.
    texts = {
        name: F.coalesce(F.col(name), F.lit(""))
        for name in ("title_clean", "description_clean")
        if name in df.columns
    }
    return df.withColumns({**restored, **texts})


def _reads_from_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.TimestampType, T.ArrayType, T.DoubleType))


def with_timestamps(df: DataFrame, names=("collected_at", "created")) -> DataFrame:
    """The named columns, where present, as UTC timestamps."""
    return df.withColumns({n: timestamp_column(df, n) for n in names if n in df.columns})
