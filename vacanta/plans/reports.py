"""The dashboard reports: each a dict of small DataFrames, one per section.

Reports take processed postings (a stored table or :func:`process_postings` over raw
rows). Only the columns that a section needs are read or computed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import (
    POSTINGS_LIMIT_DEFAULT,
    SKILL_DICTIONARY,
    SKILL_LIMIT_DEFAULT,
    TOP_LOCATIONS,
)
from vacanta.functions.skills import Dictionary
from vacanta.operators.counts import (
    dataset_summary,
    overview_totals,
    period_counts,
    top_locations,
    value_counts,
)
from vacanta.operators.demand import (
    dense_trend,
    in_category,
    most_mentioned,
    skill_demand,
    skill_trend,
    trend_choice,
    trend_series,
)
from vacanta.operators.dictionary import dictionary_table
from vacanta.operators.filters import (
    Selections,
    active_selections,
    apply_filters,
    filter_options,
    search,
)
from vacanta.operators.recent import recent_postings
from vacanta.operators.salary import (
    pay_by_skill,
    richest_first,
    salary_distribution,
    salary_histogram,
)
from vacanta.plans.training import SalaryModel, model_card

Report = dict[str, DataFrame]
NO_SELECTION: Selections = {}


def overview(
    postings: DataFrame, selections: Selections = NO_SELECTION, locations: int = TOP_LOCATIONS
) -> Report:
    rows = apply_filters(postings, selections)
    return {
        "totals": overview_totals(rows),
        "postings_per_week": period_counts(rows).orderBy("period"),
        "by_role": value_counts(rows, "role_category"),
        "by_seniority": value_counts(rows, "seniority"),
        "top_locations": top_locations(rows, locations),
    }


def skills(
    postings: DataFrame,
    selections: Selections = NO_SELECTION,
    category: str | None = None,
    limit: int = SKILL_LIMIT_DEFAULT,
    dictionary: Dictionary = SKILL_DICTIONARY,
) -> Report:
    demand = in_category(skill_demand(apply_filters(postings, selections), dictionary), category)
    return {
        "total_distinct_skills": demand.agg(F.count("skill").alias("total_distinct_skills")),
        "skills": most_mentioned(demand, limit),
        "categories": categories(postings.sparkSession, dictionary),
    }


def trend(
    postings: DataFrame,
    selections: Selections = NO_SELECTION,
    requested: Sequence[str] = (),
    freq: str = "W",
) -> Report:
    rows = apply_filters(postings, selections)
    points = skill_trend(rows, freq, trend_choice(rows, requested))
    # The chosen skills are echoed, also those without a point.
    chosen = trend_choice(rows, requested)
    if isinstance(chosen, list):
        echoed = postings.sparkSession.createDataFrame(list(enumerate(chosen)), "place int, skill string")
    else:
        echoed = postings.sparkSession.range(1).select(F.posexplode(chosen).alias("place", "skill"))
    return {
        "skills": echoed.orderBy("place").select("skill"),
        "series": trend_series(points).orderBy("skill"),
        "dense": dense_trend(points),
    }


def salary(postings: DataFrame, selections: Selections = NO_SELECTION) -> Report:
    rows = apply_filters(postings, selections)
    return {
        "by_role": richest_first(salary_distribution(rows, "role_category")),
        "by_seniority": richest_first(salary_distribution(rows, "seniority")),
        "histogram": salary_histogram(rows).orderBy("bucket"),
        "by_skill": pay_by_skill(rows),
    }


def newest_postings(
    postings: DataFrame,
    selections: Selections = NO_SELECTION,
    limit: int = POSTINGS_LIMIT_DEFAULT,
    text: str = "",
) -> Report:
    rows = search(apply_filters(postings, selections), text)
    return {"postings": recent_postings(rows, limit)}


def categories(spark, dictionary: Dictionary = SKILL_DICTIONARY) -> DataFrame:
    """The dictionary's categories in their order."""
    rows = dictionary_table(spark, dictionary).select("category_order", "category").distinct()
    return rows.orderBy("category_order").select("category")


def meta(
    postings: DataFrame,
    model: SalaryModel | None = None,
    dictionary: Dictionary = SKILL_DICTIONARY,
    selections: Selections = NO_SELECTION,
) -> Report:
    """Facts about the whole table; selections are echoed but do not apply."""
    spark = postings.sparkSession
    active = [(n, v) for n, values in active_selections(selections).items() for v in values]
    return {
        "filters": filter_options(postings).orderBy("column_name", "value"),
        "active_filters": spark.createDataFrame(active, "column_name string, value string"),
        "total_skills": dictionary_table(spark, dictionary).agg(
            F.count_distinct("skill").alias("total_skills")
        ),
        "dictionary": dictionary_table(spark, dictionary)
        .select("category_order", "category", "skill")
        .distinct(),
        "dataset": dataset_summary(postings),
        "model": model_card(spark, model),
    }
