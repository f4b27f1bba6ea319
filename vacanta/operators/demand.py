"""Skill demand and skill trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import (
    OTHER_CATEGORY,
    SKILL_DICTIONARY,
    SKILL_LIMIT_DEFAULT,
    SKILL_LIMIT_MAX,
    TREND_SKILLS_DEFAULT,
)
from vacanta.functions.skills import Dictionary, category_of
from vacanta.functions.values import bucket_start, iso_date, timestamp_column


def exploded(skills: str) -> Column:
    """One row per list entry, named ``skill``; drop the null ones afterwards.

    A plain explode makes the optimizer first filter on the size of the list, for
    which it would derive the list from the text a second time.
    """
    return F.explode_outer(skills).alias("skill")


def skill_demand(
    df: DataFrame,
    dictionary: Dictionary | DataFrame = SKILL_DICTIONARY,
    skills: str = "skills",
) -> DataFrame:
    """Per skill: category, postings naming it, and their percentage of all postings.

    Postings without skills count in the denominator. Categories come from the
    dictionary constant, or by a left join if the dictionary is a table with
    ``skill`` and ``category``; unknown skills are in category 'Other'.
    """
    # Every posting also counts under the null skill, so one pass gives the denominator.
    named = F.filter(skills, lambda s: s.isNotNull())
    listed = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(named, F.array()))
    counted = (
        df.select(F.explode_outer(listed).alias("skill"))
        .groupBy("skill")
        .agg(F.count(F.lit(1)).alias("postings_mentioning"), F.count("skill").alias("_named"))
    )
    total = counted.agg(F.max(F.when(F.col("_named") == 0, F.col("postings_mentioning")))).scalar()
    # Asked of the count, not of the key: a filter on the key would move below the
    # aggregation of this branch alone, and the shuffle would be made twice.
    mentions = counted.filter("_named > 0").drop("_named")
    if isinstance(dictionary, DataFrame):
        owners = dictionary.groupBy("skill").agg(F.min("category").alias("category"))
        owned = mentions.join(owners, "skill", "left")
        category = F.coalesce("category", F.lit(OTHER_CATEGORY))
    else:
        owned, category = mentions, category_of(F.col("skill"), dictionary)
    share = F.bround(F.lit(100) * F.col("postings_mentioning") / total, 1)
    return owned.select(
        "skill",
        category.alias("category"),
        "postings_mentioning",
        share.alias("pct_of_postings"),
    )


def in_category(demand: DataFrame, category: str | None) -> DataFrame:
    """Demand rows of one category; percentages stay relative to all postings."""
    return demand if category in (None, "", "All") else demand.filter(F.col("category") == category)


def most_mentioned(
    demand: DataFrame, limit: int = SKILL_LIMIT_DEFAULT, most: int | None = SKILL_LIMIT_MAX
) -> DataFrame:
    """The ``limit`` most mentioned skills; a report's ``limit`` above ``most`` is refused."""
    if limit < 1 or (most is not None and limit > most):
        raise ValueError(f"limit must be within 1..{most}: {limit}")
    return demand.orderBy(F.desc("postings_mentioning"), "skill").limit(limit)


def skill_trend(
    df: DataFrame,
    freq: str = "W",
    only: Column | Sequence[str] | None = None,
    date: str = "collected_at",
    skills: str = "skills",
) -> DataFrame:
    """``(period, skill, mentions)``; unreadable dates and empty lists give no rows.

    ``only`` keeps some skills: names thin the lists before they are exploded, an array
    column (a scalar subquery) selects afterwards.
    """
    listed = F.col(skills)
    names = None if only is None or isinstance(only, Column) else list(only)
    if names is not None:
        listed = F.filter(listed, lambda s: s.isin(names))
    mentions = (
        df.select(bucket_start(timestamp_column(df, date), freq).alias("period"), listed.alias("_s"))
        .filter(F.col("period").isNotNull())
        .select("period", exploded("_s"))
        .filter(F.col("skill").isNotNull())
    )
    if isinstance(only, Column):
        mentions = mentions.filter(F.array_contains(only, F.col("skill")))
    return (
        mentions.groupBy("period", "skill")
        .agg(F.count(F.lit(1)).alias("mentions"))
        .select(iso_date(F.col("period")).alias("period"), "skill", "mentions")
    )


def trend_choice(df: DataFrame, requested: Sequence[str] = ()) -> Column | list[str]:
    """The skills to plot: all that are requested, else the four most mentioned."""
    if requested:
        return list(dict.fromkeys(requested))
    top = most_mentioned(skill_demand(df), TREND_SKILLS_DEFAULT)
    return top.agg(F.collect_list("skill")).scalar()


def trend_series(trend: DataFrame) -> DataFrame:
    """One row per skill with its points in time order."""
    point = F.struct("period", F.col("mentions").alias("value"))
    return trend.groupBy("skill").agg(F.sort_array(F.collect_list(point)).alias("points"))


def dense_trend(trend: DataFrame) -> DataFrame:
    """``(period, skill, mentions)`` for every period and skill of ``trend``, absent = 0.

    ``trend`` is an aggregated table over a few chosen skills. The skills travel as
    one constant array, so no join is needed.
    """
    chosen = trend.agg(F.sort_array(F.collect_set("skill"))).scalar()
    by_period = trend.groupBy("period").agg(
        F.map_from_entries(F.collect_list(F.struct("skill", "mentions"))).alias("_seen")
    )
    return by_period.select("period", "_seen", F.explode(chosen).alias("skill")).select(
        "period",
        "skill",
        F.coalesce(F.try_element_at("_seen", F.col("skill")), F.lit(0)).alias("mentions"),
    )
