"""Row filters, filter options and text search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacanta.fixed_values import FILTER_COLUMNS, SALARY_CEILING, SALARY_FLOOR
from vacanta.functions.text import bind, is_blank
from vacanta.functions.values import numeric_column, text_column

Selections = Mapping[str, Sequence[str]]


def active_selections(selections: Selections) -> dict[str, list[str]]:
    return {name: list(values) for name, values in selections.items() if values}


def apply_filters(df: DataFrame, selections: Selections) -> DataFrame:
    """OR within a column, AND across columns.

    An empty selection or an unknown column is no constraint. Values compare as
    text; null matches nothing.
    """
    for name, values in active_selections(selections).items():
        if name in df.columns:
            df = df.filter(F.col(name).cast("string").isin(list(values)))
    return df


def filter_options(df: DataFrame, names: Sequence[str] = tuple(FILTER_COLUMNS)) -> DataFrame:
    """Distinct selectable values as rows ``(column_name, value)``.

    Long form and one scan: no list of values has to fit into one row.
    """
    present = [name for name in names if name in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column_name string, value string")
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), text_column(df, name).alias("value"))
            for name in present
        ]
    )
    return df.select(F.inline(pairs)).filter(~is_blank(F.col("value"))).distinct()


def searched_text(df: DataFrame) -> Column:
    """What a search looks through: title, company, location and skills, in lower case."""
    titles = F.coalesce(
        F.nullif(text_column(df, "title_clean"), F.lit("")), text_column(df, "title"), F.lit("")
    )
    texts: list[Column] = [
        titles,
        F.coalesce(text_column(df, "company"), F.lit("")),
        F.coalesce(text_column(df, "location"), F.lit("")),
    ]
    if "skills" in df.columns:
        texts.append(F.array_join("skills", " "))
    return F.lower(F.concat_ws(" ", *texts))


def search(df: DataFrame, query: str) -> DataFrame:
    """Rows whose title, company, location or skills contain ``query``, in any case.

    A blank query keeps all rows. Every row is looked at; many searches of one table are
    better asked of an index (:mod:`vacanta.operators.search_index`).
    """
    wanted = query.strip().lower()
    return df.filter(searched_text(df).contains(wanted)) if wanted else df


def plausible(salary: Column) -> Column:
    """``salary`` where it can be an annual salary, else null."""
    return bind(salary, lambda s: F.when(s.between(SALARY_FLOOR, SALARY_CEILING), s))


def plausible_salary(df: DataFrame, name: str = "salary_midpoint") -> Column:
    """The salary all salary reports are about. The row stays, only the value goes."""
    return plausible(numeric_column(df, name))


SALARY_BOUNDS = (float(SALARY_FLOOR), float(SALARY_CEILING))


def with_plausible_salary(df: DataFrame, name: str = "salary_midpoint") -> DataFrame:
    """Only the rows with a plausible salary.

    On a stored number this is a plain comparison of the column, which reaches the scan.
    """
    if name in df.columns and isinstance(df.schema[name].dataType, T.DoubleType):
        return df.filter(F.col(name).between(*SALARY_BOUNDS))
    return df.filter(plausible_salary(df, name).isNotNull())
