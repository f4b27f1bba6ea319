"""The salary report under any filter, from a table of cells instead of the postings.

A cell is one combination of the filter columns and a plausible salary, with the number of
its postings; further cells hold a skill as well. One scan and one shuffle make them. Both
box plots, the histogram and the pay by skill of a selection come from the cells, so the
postings are read once for all sections and all selections. Cells of several tables merge:
read together, their counts add up.

Cells number at most the combinations that occur. A posting adds one cell and one for each
of its skills before the partial aggregation; a hot combination leaves a task as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.fixed_values import FILTER_COLUMNS
from vacanta.functions.values import text_column
from vacanta.operators.filters import (
    SALARY_BOUNDS,
    Selections,
    apply_filters,
    plausible_salary,
    with_plausible_salary,
)
from vacanta.operators.quantiles import box_plots_of, medians_of, weighted_counts
from vacanta.operators.salary import NULL_LABEL, best_paid, histogram_of, richest_first


def salary_cells(postings: DataFrame, salary: str = "salary_midpoint") -> DataFrame:
    """``(filter columns, skill, salary, n)``; a null skill stands for the posting itself.

    Filter columns that the postings lack are left out. Null skills in a list do not count.
    """
    labels = [n for n in FILTER_COLUMNS if n in postings.columns]
    none = F.array().cast("array<string>")
    skills = F.coalesce(F.col("skills"), none) if "skills" in postings.columns else none
    entries = F.concat(F.array(F.lit(None).cast("string")), F.array_compact(skills))
    return (
        with_plausible_salary(postings, salary)
        .select(
            *(text_column(postings, n).alias(n) for n in labels),
            F.explode(entries).alias("skill"),
            plausible_salary(postings, salary).alias("salary"),
        )
        .groupBy(*labels, "skill", "salary")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def build(postings: DataFrame, path: str, salary: str = "salary_midpoint") -> None:
    """Writes the cells below ``path``, in each file those of postings before those of skills."""
    salary_cells(postings, salary).sortWithinPartitions("skill").write.parquet(path)


def report(cells: DataFrame, selections: Selections) -> dict[str, DataFrame]:
    """The sections of :func:`vacanta.plans.reports.salary` for the selected postings."""
    chosen = apply_filters(cells, selections)
    plain, listed = chosen.filter("skill IS NULL"), chosen.filter("skill IS NOT NULL")

    def boxes(group: str) -> DataFrame:
        if group in cells.columns:
            labelled = plain.withColumn("label", F.coalesce(group, F.lit(NULL_LABEL)))
        else:
            labelled = plain.withColumn("label", F.lit(NULL_LABEL)).filter(F.lit(False))
        return richest_first(box_plots_of(weighted_counts(labelled, ["label"], "salary", "n", SALARY_BOUNDS), ["label"]))

    return {
        "by_role": boxes("role_category"),
        "by_seniority": boxes("seniority"),
        "histogram": histogram_of(plain.select(F.col("salary").alias("_v"), F.col("n").alias("_n"))).orderBy("bucket"),
        "by_skill": best_paid(medians_of(weighted_counts(listed, ["skill"], "salary", "n", SALARY_BOUNDS), ["skill"])),
    }
