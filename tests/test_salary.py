import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vacanta.operators.counts import overview_totals, period_counts, top_locations, value_counts, value_counts_of
from vacanta.operators.filters import SALARY_BOUNDS, plausible_salary
from vacanta.operators.processing import add_salary_midpoint
from vacanta.operators import free_quantiles, overview_cells, salary_cells
from vacanta.operators.quantiles import box_plots, medians
from vacanta.operators.salary import (
    pay_by_skill,
    richest_first,
    salary_box,
    salary_distribution,
    salary_histogram,
)
from vacanta.plans import reports
from vacanta.session import scratch_path


def frame(spark, values, group=None):
    rows = [(group[i] if group else "g", None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "role string, salary_midpoint double")


def brute_box(values):
    v = pd.Series(values, dtype=float)
    q1, q2, q3 = (v.quantile(q) for q in (0.25, 0.5, 0.75))
    inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
    return [inside.min(), q1, q2, q3, inside.max(), len(v)]


def make(kind):
    rng = np.random.default_rng(3)
    return {
        "one": [20000],
        "two": [15000, 250000],
        "same": [40000] * 9,
        "outliers": [*range(50000, 50040), 15000, 250000],
        "cents": list(np.round(rng.uniform(15000, 250000, 997), 2)),
        "one slot": list(np.round(rng.uniform(60000, 60050, 301), 3)),
        "hot value": [30000] * 4000 + list(rng.integers(15000, 250000, 2000)),
    }[kind]


@pytest.mark.parametrize("kind", ["one", "two", "same", "outliers", "cents", "one slot", "hot value"])
def test_box_plot_equals_brute_force(spark, kind):
    values = make(kind)
    row = salary_distribution(frame(spark, values), "role").first()
    got = [row["min"], row["q1"], row["median"], row["q3"], row["max"], row["count"]]
    assert got == pytest.approx(brute_box(values), rel=1e-12)


def test_many_groups_one_of_them_hot(spark):
    rng = np.random.default_rng(5)
    groups = ["hot"] * 3000 + [f"g{i}" for i in rng.integers(0, 300, 6000)]
    values = list(rng.integers(14000, 260000, 9000))
    rows = salary_distribution(frame(spark, values, groups), "role").collect()
    wanted = pd.DataFrame({"g": groups, "v": values}).query("15000 <= v <= 250000").groupby("g").v
    assert len(rows) == len(wanted)
    for r in rows:
        got = [r["min"], r["q1"], r["median"], r["q3"], r["max"], r["count"]]
        assert got == pytest.approx(brute_box(wanted.get_group(r.label)), rel=1e-12)


def test_box_plots_without_broadcast_and_other_partitions(spark):
    df = frame(spark, make("cents"), [f"g{i % 3}" for i in range(997)]).withColumn("v", F.col("salary_midpoint"))
    plain = sorted(box_plots(df, ["role"], "v", SALARY_BOUNDS).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert sorted(box_plots(df.repartition(5), ["role"], "v", SALARY_BOUNDS).collect()) == plain
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_labels_and_order(spark):
    df = frame(spark, [20000, 30000, 40000, 10, None], ["b", None, "a", "c", "d"])
    rows = richest_first(salary_distribution(df, "role")).collect()
    assert [r.label for r in rows] == ["a", "nan", "b"]
    assert salary_box(df).first()["median"] == 30000
    assert salary_box(df.filter("false")).count() == 0
    assert medians(df.filter("false"), ["role"], "salary_midpoint", SALARY_BOUNDS).count() == 0


@pytest.mark.parametrize(
    "values",
    [
        make("cents"),
        [15000, 39000, 63000, 20000, 15000 + 24000 / 24, 15000 + 2 * 24000 / 24, 39000],
        [50000] * 4,
        [15000, 250000],
    ],
)
def test_histogram_equals_pandas(spark, values):
    rows = salary_histogram(frame(spark, values)).orderBy("bucket").collect()
    cut, edges = pd.cut(pd.Series(values, dtype=float), bins=24, retbins=True)
    assert [r["count"] for r in rows] == list(cut.value_counts().sort_index())
    assert [r.lower for r in rows] == [round(e) for e in edges[:-1]]
    assert [r.upper for r in rows] == [round(e) for e in edges[1:]]


def test_histogram_of_nothing(spark):
    assert salary_histogram(frame(spark, [1, None])).count() == 0


def test_midpoint_coercion(spark):
    rows = [
        ("60000", "70000"), ("60000", None), (None, "7e4"), (None, None), ("x", "5d"), ("inf", "1"), (" 10 ", "20"),
        ("NaN", "30000"),
    ]
    df = add_salary_midpoint(spark.createDataFrame(rows, "salary_min string, salary_max string"))
    got = [r.salary_midpoint for r in df.collect()]
    assert got == [65000, 60000, 70000, None, None, float("inf"), 15, 30000]
    lone = add_salary_midpoint(spark.createDataFrame([("5",)], "salary_min string"))
    assert lone.first().salary_midpoint == 5
    none = add_salary_midpoint(spark.createDataFrame([("5",)], "x string"))
    assert none.first().salary_midpoint is None


def test_plausible_bounds_are_inclusive(spark):
    df = frame(spark, [14999.99, 15000, 250000, 250000.01, float("nan"), None])
    got = [r[0] for r in df.select(plausible_salary(df)).collect()]
    assert got == [None, 15000, 250000, None, None, None]


def test_pay_by_skill(spark):
    rows = [(["Python", "SQL"], 30000.0)] * 5 + [(["Python"], 50000.0)] * 6 + [(["Rare"], 90000.0)] * 4
    rows += [(["SQL"], None), (None, 60000.0), ([], 60000.0)]
    df = spark.createDataFrame(rows, "skills array<string>, salary_midpoint double")
    got = [tuple(r) for r in pay_by_skill(df).collect()]
    assert got == [("Python", 50000, 11), ("SQL", 30000, 5)]
    assert [r.skill for r in pay_by_skill(df, limit=1).collect()] == ["Python"]
    assert pay_by_skill(df.filter("false")).count() == 0


def test_overview(spark):
    df = spark.createDataFrame(
        [("A", "L", 20000.0), ("A", None, 30001.0), (None, "M", 5.0), ("B", "L", None)],
        "company string, location string, salary_midpoint double",
    )
    assert tuple(overview_totals(df).first()) == (4, 2, 2, 0.5, 25000)
    assert tuple(overview_totals(df.filter("false")).first()) == (0, 0, 0, 0.0, None)
    assert [tuple(r) for r in value_counts(df, "location").collect()] == [("L", 2), ("M", 1)]
    assert top_locations(df, 1).first().label == "L"
    both = value_counts_of(df, ["company", "location"])
    assert both.filter("dimension = 'company' AND label = 'A'").first()["count"] == 2


def test_period_counts(spark):
    dates = ["2026-08-03T00:00:00Z", "2026-08-09", "2026-08-10T01:00:00+02:00", "2026-08-10 05:00:00.25", "x", None]
    df = spark.createDataFrame([(d,) for d in dates], "created string")
    got = {r.period: r["count"] for r in period_counts(df).collect()}
    assert got == {"2026-08-03": 3, "2026-08-10": 1}


def test_other_bounds(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (20_000.0,)], "v double")
    row = medians(df, [], "v", (0.0, 30_000.0)).first()
    assert (row["median"], row["count"]) == (2.0, 3)


def test_absent_columns_give_empty_reports(spark):
    df = spark.createDataFrame([(20_000.0,)], "salary_midpoint double")
    assert salary_distribution(df, "region").count() == 0
    assert pay_by_skill(df).count() == 0


@pytest.mark.parametrize("rounds", [6, 0])
def test_quantiles_without_bounds(spark, monkeypatch, rounds):
    """Orders of magnitude, many copies of few values, null groups, and values that are none."""
    monkeypatch.setattr(free_quantiles, "ROUNDS", rounds)
    rng = np.random.default_rng(7)
    groups = {
        "wide": np.exp(rng.normal(0, 30, 60_000)) * rng.choice([-1, 1], 60_000),
        "copies": np.concatenate([np.full(40_000, 1.5), np.full(40_000, 2.5), rng.normal(3, 1, 30_000)]),
        None: rng.normal(1e9, 1e-3, 500),
        "one": np.array([4.0]),
        "two": np.array([4.0, 5.0]),
    }
    parts = [pd.DataFrame({"g": k, "v": v}) for k, v in groups.items()]
    parts.append(pd.DataFrame({"g": ["wide", "wide", "none", "one"], "v": [np.inf, -np.inf, np.nan, None]}))
    df = spark.createDataFrame(pd.concat(parts).astype({"g": object}).where(lambda x: x.notna(), None), "g string, v double")
    wanted = {"low": 0.0, "q1": 0.25, "middle": 0.5, "rare": 0.999, "high": 1.0}
    got = {r.g: r for r in free_quantiles.quantiles(df, ["g"], "v", wanted).collect()}
    assert got.keys() == groups.keys()
    for k, v in groups.items():
        assert got[k]["count"] == len(v)
        for name, q in wanted.items():
            assert got[k][name] == pytest.approx(np.quantile(v, q), rel=1e-12)
    whole = free_quantiles.quantiles(df.filter("g in ('one', 'two')"), [], "v", {"m": 0.5}).collect()
    assert [tuple(r) for r in whole] == [(4.0, 3)]
    assert free_quantiles.quantiles(df.limit(0), ["g"], "v", {"m": 0.5}).collect() == []


def test_cells_give_totals_under_any_filter(spark, tmp_path):
    """Null companies and labels, a common company, and filters that take any cells together."""
    rng = np.random.default_rng(3)
    rows = [
        (
            *(None if rng.random() < 0.1 else f"{c}{rng.integers(0, 3)}" for c in "rslgt"),
            None if i % 11 == 0 else "big" if i % 3 == 0 else f"c{rng.integers(0, 200)}",
            None if i % 7 == 0 else float(rng.integers(5, 300) * 1000),
        )
        for i in range(1500)
    ]
    names = ["role_category", "seniority", "location", "region", "contract_type"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in [*names, "company"]) + ", salary_midpoint double")
    path = str(tmp_path / "cells")
    overview_cells.build(df, path)
    assert "company" not in spark.read.parquet(f"{path}/cells").columns
    from vacanta.operators.filters import apply_filters

    for chosen in ({}, {"region": ["g0"]}, {"seniority": ["s0", "s1"], "contract_type": ["t2"]}, {"role_category": ["none"]}):
        want = overview_totals(apply_filters(df, chosen)).first().asDict()
        assert overview_cells.totals(spark, path, chosen).first().asDict() == want


def cell_frame(spark, rows):
    return spark.createDataFrame(
        rows, "role_category string, region string, skills array<string>, salary_midpoint double, extra int"
    )


@pytest.mark.parametrize("selections", [{}, {"region": ["N"]}, {"region": ["N", "S"], "role_category": ["A"]}, {"region": ["?"]}])
def test_cells_give_the_report_of_the_postings(spark, selections):
    roles, regions = ["A", "B", None], ["N", "S", None]
    rows = [
        (roles[i % 3], regions[i % 7 % 3], ["SQL", "SQL", None, f"K{i % 4}"] if i % 5 else None, 14_000.0 + 997 * (i % 40), i)
        for i in range(300)
    ]
    rows += [rows[4]] * 150 + [("A", "N", [], None, 0), ("A", "N", ["SQL"], float("nan"), 0), ("A", "N", ["SQL"], 1e9, 0)]
    df = cell_frame(spark, rows)
    paths = [scratch_path(spark, "cells") for _ in range(2)]
    salary_cells.build(df.filter("extra % 2 = 0"), paths[0])
    salary_cells.build(df.filter("extra % 2 = 1"), paths[1])
    cells = spark.read.parquet(paths[0]).unionByName(spark.read.parquet(paths[1]))
    merged, whole = salary_cells.report(cells, selections), reports.salary(df, selections)
    for name, section in whole.items():
        assert merged[name].collect() == section.collect(), name
    assert "seniority" not in cells.columns


def test_cells_of_no_postings(spark):
    path = scratch_path(spark, "cells")
    salary_cells.build(cell_frame(spark, []), path)
    report = salary_cells.report(spark.read.parquet(path), {"region": ["N"]})
    assert [section.count() for section in report.values()] == [0, 0, 0, 0]


def test_sections_read_the_cells_once(spark):
    path = scratch_path(spark, "cells")
    salary_cells.build(cell_frame(spark, [("A", "N", ["SQL"], 20_000.0 + i, i) for i in range(20)]), path)
    report = salary_cells.report(spark.read.parquet(path), {"region": ["N"]})
    for name in ("by_role", "by_skill"):
        report[name].collect()
        plan = report[name]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan") == 1 and "EqualTo(region,N)" in plan, name
