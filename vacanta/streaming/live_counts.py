"""Weekly skill mentions and postings, kept up to date while postings arrive.

Counts are of first sightings, as in the batch trend, however late a row comes. The stream
keeps the first sighting of each id in its state and tells what changes; a posting whose
earlier sighting arrives afterwards takes its mentions out of one week and into another.
Nothing is dropped for being late, rows without an id count one by one, and a micro-batch
reads nothing but its own rows and the state of their ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vacanta.functions.values import bucket_start, iso_date, timestamp_column
from vacanta.sources import commits
from vacanta.streaming.first_sightings import keep_first_sightings

Counting = Callable[..., DataFrame]


def _week(df: DataFrame, date: str) -> Column:
    return iso_date(bucket_start(timestamp_column(df, date), "W"))


def _counted(rows: DataFrame, keys: list[str], weight: str | None) -> DataFrame:
    number = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return rows.groupBy(*keys).agg(number.alias("count"))


def weekly_mentions(postings: DataFrame, date: str = "collected_at", weight: str | None = None) -> DataFrame:
    """``(period, skill, count)``; unreadable dates and empty lists give no rows.

    Rows count once, or as often as the column ``weight`` says.
    """
    rows = postings.select(
        _week(postings, date).alias("period"), F.explode("skills").alias("skill"), *([weight] if weight else [])
    ).filter(F.col("period").isNotNull() & F.col("skill").isNotNull())
    return _counted(rows, ["period", "skill"], weight)


def weekly_postings(postings: DataFrame, date: str = "created", weight: str | None = None) -> DataFrame:
    """``(period, count)``; unreadable dates give no rows. ``weight`` as above."""
    rows = postings.select(_week(postings, date).alias("period"), *([weight] if weight else []))
    return _counted(rows.filter(F.col("period").isNotNull()), ["period"], weight)


def keep_counts(
    postings: DataFrame, counting: Counting, store: str, checkpoint: str
) -> StreamingQuery:
    """Start a query that counts what is available and then ends.

    ``postings`` is a stream with ``id`` and ``collected_at`` beside what ``counting``
    needs. ``store`` holds the changes to the first sightings and, below ``counts``, those
    to the counts; one query at a time writes it. Run again, a micro-batch finds its
    commits and changes nothing. A new checkpoint takes its state from the store.
    """

    def count(changes: DataFrame, name: str) -> None:
        commits.commit(counting(changes, weight="change").filter("count <> 0"), f"{store}/counts", name)

    return keep_first_sightings(postings, store, checkpoint, after=count)


def latest_counts(spark: SparkSession, store: str, keys: list[str]) -> DataFrame:
    """The counts as of the last micro-batch: ``keys`` and ``count``."""
    schema = T.StructType(
        [*(T.StructField(k, T.StringType()) for k in keys), T.StructField("count", T.LongType())]
    )
    changes = commits.read(spark, f"{store}/counts", schema)
    return changes.groupBy(*keys).agg(F.sum("count").alias("count")).filter("count <> 0")
