"""Plans are what they should be, reports work filtered and not, queries equal SQL."""

import math
import re

import duckdb
import pytest
from tests.conftest import raw_row
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from checks.queries import CHECKS, JOBS, processed
from vacanta.operators import counts, salary
from vacanta.operators.demand import skill_demand
from vacanta.operators.filters import apply_filters
from vacanta.plans import reports
from vacanta.session import scratch_path
from vacanta.streaming.live_counts import keep_counts, latest_counts, weekly_mentions

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "test-processed")
    processed(spark, FOLDER).write.parquet(path)
    return spark.read.parquet(path)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_no_python_in_processing(spark):
    plan = processed(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"EvalPython|InPandas|InArrow", plan)


def test_filters_and_columns_reach_the_scan(stored):
    rows = apply_filters(stored, {"region": ["ASIA"], "contract_type": ["permanent"]})
    plan = plan_of(salary.salary_distribution(rows, "role_category"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PushedFilters: [" in scan and "EqualTo(region,ASIA)" in scan
    read = scan.split("ReadSchema:")[1]
    assert "salary_midpoint" in read and "description" not in read and "skills" not in read


def test_box_plot_reads_the_table_once(stored):
    plan = plan_of(salary.salary_distribution(stored, "role_category"))
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") >= 2


@pytest.mark.parametrize("report", ["by_role", "histogram", "by_skill"])
def test_salary_range_reaches_the_scan(stored, report):
    plan = reports.salary(stored)[report]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(salary_midpoint,15000.0)" in plan


def test_pay_by_skill_reads_the_table_once(stored):
    assert plan_of(salary.pay_by_skill(stored)).count("FileScan") == 1


def test_median_reads_the_table_once(stored):
    from vacanta.operators.quantiles import medians

    plan = plan_of(medians(stored, [], "salary_midpoint", (15_000.0, 250_000.0)))
    assert plan.count("FileScan") == 1


def test_no_cross_joins(stored):
    whole = {**reports.overview(stored), **reports.salary(stored), **reports.skills(stored), **reports.trend(stored)}
    for name, df in whole.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_top_k_is_not_a_full_sort(stored):
    assert "TakeOrderedAndProject" in plan_of(counts.top_locations(stored))


def test_demand_reads_only_skills(stored):
    # The subquery for the denominator has a plan of its own, so look at the whole text.
    plan = skill_demand(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<skills:array<" in plan and "description" not in plan


def test_demand_reads_the_table_once(stored):
    df = skill_demand(stored)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # Only scans that ran are followed by this operator; initial plans do not have it yet.
    assert text.count("ColumnarToRow") == 1 and "ReusedExchange" in text


@pytest.mark.parametrize("selections", [{}, {"role_category": ["Data Analyst"]}, {"role_category": ["No such role"]}])
def test_reports(stored, selections):
    rows = apply_filters(stored, selections).count()
    over = reports.overview(stored, selections)
    assert over["totals"].first().postings == rows
    assert sum(r["count"] for r in over["by_role"].collect()) == rows
    assert over["top_locations"].count() <= 10
    shown = reports.skills(stored, selections, limit=5)
    assert shown["skills"].count() <= 5
    pay = {name: df.collect() for name, df in reports.salary(stored, selections).items()}
    paid = apply_filters(stored, selections).filter("salary_midpoint BETWEEN 15000 AND 250000").count()
    assert sum(r["count"] for r in pay["histogram"]) == paid == sum(r["count"] for r in pay["by_role"])
    medians = [r["median"] for r in pay["by_role"]]
    assert medians == sorted(medians, reverse=True)
    series = reports.trend(stored, selections)["series"].count()
    assert series == (0 if rows == 0 else 4)
    assert reports.newest_postings(stored, selections, 3)["postings"].count() == min(3, rows)


def test_meta(stored):
    facts = reports.meta(stored)
    assert facts["dictionary"].count() == 56 and facts["model"].count() == 0
    assert facts["dataset"].first().total_rows == stored.count()
    assert facts["filters"].filter("column_name = 'region'").count() == 5


def test_live_counts_equal_the_batch_trend(spark, raw, tmp_path):
    from vacanta.operators.demand import skill_trend
    from vacanta.operators.processing import process_postings
    from vacanta.sources.schema import RAW

    inbox, store, log = (str(tmp_path / n) for n in ("in", "store", "log"))
    days = ["2026-08-03", "2026-08-04", "2026-08-11", "2026-08-12"]
    rows = [raw_row(str(i), collected_at=f"{d}T10:00:00Z") for i, d in enumerate(days)]
    for part in (rows[:2], rows[2:] + rows[3:]):
        raw(*part).coalesce(1).write.mode("append").parquet(inbox)
        stream = process_postings(spark.readStream.schema(RAW).parquet(inbox))
        keep_counts(stream, weekly_mentions, store, log).awaitTermination()
    got = sorted(map(tuple, latest_counts(spark, store, ["period", "skill"]).collect()))
    assert got == sorted(map(tuple, skill_trend(process_postings(raw(*rows))).collect()))


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["label", "min", "q1", "median", "q3", "max", "count"] and df.count() == 6


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, duck, name):
    df = JOBS[name](spark, FOLDER)
    cursor = duck.execute(CHECKS[name])
    wanted = comparable([d[0] for d in cursor.description], cursor.fetchall())
    assert comparable(df.columns, [tuple(r) for r in df.collect()]) == wanted


def test_every_check_belongs_to_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(JOBS) <= set(entry_point.queries())


def test_null_label_is_a_parameter(spark):
    df = spark.createDataFrame([(None, 20000.0)], "region string, salary_midpoint double")
    assert salary.salary_distribution(df, "region", null_label="none").select(F.col("label")).first()[0] == "none"
