from pyspark.sql import functions as F

from vacanta.functions.titles import label_by_rules, role_category, seniority
from vacanta.operators.processing import add_titles

CASES = [
    ("Data Analyst, Senior Grade", "Data Analyst", "Senior"),
    ("Analytics Engineer II", "Analytics Engineer", "Mid-level"),
    ("Principal Machine Learning Engineer", "Machine Learning Engineer", "Lead / Principal"),
    ("Tram Driver", "Other", "Mid-level"),
    (None, "Other", "Unspecified"),
    ("", "Other", "Unspecified"),
    ("  ", "Other", "Unspecified"),
    ("Head of Data (Interim)", "Data Manager / Lead", "Head / Director"),
    ("Junior Night-Shift Data Analyst", "Data Analyst", "Junior / Entry-level"),
    ("Graduate Data Analyst 2025", "Data Analyst", "Junior / Entry-level"),
    ("Product Analyst", "Data Analyst", "Mid-level"),
    ("Product Analysts", "Product Analyst", "Mid-level"),
    ("Data Engineering Manager", "Data Engineer", "Mid-level"),
    ("Sr. Data Scientist", "Data Scientist", "Senior"),
    ("HTML engineer", "Other", "Mid-level"),
    ("ML ENGINEER", "Machine Learning Engineer", "Mid-level"),
    ("Entry-level BI person", "BI Developer / Analyst", "Junior / Entry-level"),
    ("Internal auditor", "Other", "Mid-level"),
]


def test_titles(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, title string")
    rows = add_titles(df).orderBy("i").collect()
    assert [(r.title, r.role_category, r.seniority) for r in rows] == CASES


def test_rules_are_data(spark):
    df = spark.createDataFrame([("ab",), ("b",), ("c",), (None,)], "v string")
    label = label_by_rules(F.col("v"), [("A", ["a"]), ("none", []), ("B", ["b"])], "D", "empty")
    assert [r[0] for r in df.select(label).collect()] == ["A", "B", "D", "empty"]


def test_one_reference_to_the_title(spark):
    """A filter on a label may be moved below the cleaning: it must not multiply it."""
    text = spark.range(1).select(F.lit("x").alias("t")).select(
        role_category(F.col("t")), seniority(F.col("t"))
    )
    plan = text._jdf.queryExecution().analyzed().toString()
    assert plan.count("array(t#") == 2
