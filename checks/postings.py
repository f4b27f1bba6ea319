"""Postings derived from the supplied tables, by one SQL text for both engines.

Titles and descriptions are chosen by key so that all rules meet all reports; the
moduli 13, 17, 11, 19, 23, 29 and 31 are coprime, so the attributes are independent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vacanta.session import use_utc

TITLES = [
    "Senior Data Analyst (London, Hybrid)",
    "Junior Data Engineer",
    "Lead Machine Learning Engineer [Remote]",
    "Head of Data",
    "Product Analyst",
    "Product Analysts &amp; Reporting",
    "Analytics Engineer",
    "Sr. Data Scientist",
    "Data Engineering Manager",
    "BI Developer &#45; Graduate",
    "  Warehouse Operative  ",
    "<b>Principal</b> Data Architect (Contract) - Acme",
    "",
]

DESCRIPTIONS = [
    "<p>Strong <b>Python</b>, SQL and Power BI with AWS &amp; Azure experience.</p>",
    "We use Microsoft SQL Server, T-SQL and Looker Studio.<br/>Apply at https://example.com/job/1 today.",
    "<ul><li>•Airflow</li><li>•dbt</li><li>•PySpark</li></ul> Salary &pound;60,000",
    "JavaScript and node.js, not scripting; large language models; a/b testing",
    "Skills: R, Scala, C++ and C#. Also ML, NLP.",
    "<script>var python = 1;</script><style>.sql</style>Excel only",
    "Bachelor's degree or MSc; SC clearance * stakeholder management * communication skills",
    "Kafka/Spark/Docker; k8s, CI/CD, GitHub   and version control",
    "&lt;b&gt;Tableau&lt;/b&gt; and Qlik&nbsp;Sense, forecasting &middot; time series",
    "<!-- python --> Snowflake, BigQuery, Redshift",
    "Deep learning with PyTorch and TensorFlow; scikit-learn",
    "<div title=\"a>b\">Agile project management</div>",
    "Data modelling and dimensional modeling in Databricks, ETL, data pipelines",
    "Generative AI, GPT, LLM work. Python python PYTHON.",
    "",
    "   ",
    "Hypothesis testing &amp;amp; statistics; Google Cloud; PostgreSQL; MongoDB (Oracle database)",
]

SEARCHES = [
    "data analyst",
    "data scientist",
    "data engineer",
    "machine learning engineer",
    "business intelligence",
    "analytics engineer",
]


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def choice(key: str, texts: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN {quoted(t)}" for i, t in enumerate(texts))
    return f"CASE {key} % {len(texts)} {cases} END"


RAW_SQL = f"""
SELECT CAST(o_orderkey AS STRING) AS id,
       {choice('o_orderkey', TITLES)} AS title,
       c_name AS company,
       n_name AS location,
       CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE r_name END AS region,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL
            ELSE concat({choice('o_orderkey', DESCRIPTIONS)}, ' ', c_mktsegment) END AS description,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            WHEN o_orderkey % 31 = 0 THEN 'competitive'
            ELSE CAST(CAST(floor(o_totalprice * 0.9) AS BIGINT) AS STRING) END AS salary_min,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL
            ELSE CAST(CAST(floor(o_totalprice * 1.1) AS BIGINT) AS STRING) END AS salary_max,
       '0' AS salary_is_predicted,
       CASE o_orderstatus WHEN 'O' THEN 'permanent' WHEN 'F' THEN 'contract' END AS contract_type,
       o_orderpriority AS contract_time,
       'IT Jobs' AS category,
       CASE WHEN o_orderkey % 23 = 0 THEN 'not a date'
            WHEN o_orderkey % 29 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
            ELSE concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T09:30:00Z') END AS created,
       concat('https://example.com/jobs/', CAST(o_orderkey AS STRING)) AS redirect_url,
       {choice('o_orderkey', SEARCHES)} AS query,
       concat(CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 AS INT) AS STRING),
              'T08:00:00Z') AS collected_at
FROM {{orders}} o
JOIN {{customer}} c ON o_custkey = c_custkey
JOIN {{nation}} n ON c_nationkey = n_nationkey
JOIN {{region}} r ON n_regionkey = r_regionkey
"""

# A second sighting of every posting, up to three days before or after the first.
AGAIN_SQL = """
SELECT id, title, concat(company, ' again') AS company, location, region, description,
       salary_min, salary_max, salary_is_predicted, contract_type, contract_time, category,
       created, redirect_url, query,
       concat(CAST(CAST(substring(collected_at, 1, 10) AS DATE)
                   + CAST(CAST(id AS BIGINT) % 7 - 3 AS INT) AS STRING), 'T08:00:00Z')
           AS collected_at
FROM {raw}
"""

# The same number of postings under ids not seen before.
FRESH_SQL = """
SELECT concat('n', id) AS id, title, company, location, region, description,
       salary_min, salary_max, salary_is_predicted, contract_type, contract_time, category,
       created, redirect_url, query, collected_at
FROM {raw}
"""

# Schemas of the supplied tables: no job to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
}

_NAMES = ["orders", "customer", "nation", "region"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.schema(SCHEMAS[name]).parquet(
        f"{folder}/{name}.parquet"
    )


def raw_postings(spark: SparkSession, folder: str) -> DataFrame:
    tables = {name: table(spark, folder, name) for name in _NAMES}
    return spark.sql(RAW_SQL, **tables)


def seen_again(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(AGAIN_SQL, raw=raw_postings(spark, folder))


def fresh_postings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(FRESH_SQL, raw=raw_postings(spark, folder))


# --- the same for the checking engine ---------------------------------------------

RAW_VIEW = RAW_SQL.format(**{name: name for name in _NAMES})
AGAIN_VIEW = AGAIN_SQL.format(raw="raw")
FRESH_VIEW = FRESH_SQL.format(raw="raw")
