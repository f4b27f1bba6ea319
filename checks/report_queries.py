"""Registered queries over whole reports, by value, and over skills in real text.

A report's sections become rows ``(section, label, value)``; ``label`` keeps what a row
is about and ``value`` its number, so that one table holds a report of any shape.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import sql as S
from checks.postings import table
from checks.queries import _DEMAND, _trend_sql, processed, query
from vacanta.functions.skills import skills_in
from vacanta.operators import demand, overview_cells, salary, salary_cells
from vacanta.operators.quantiles import box_plots
from vacanta.plans import reports
from vacanta.session import scratch_path

CONTRACT = {"contract_type": ["contract"], "seniority": ["Senior", "Mid-level"], "region": []}
_CONTRACT = "contract_type = 'contract' AND seniority IN ('Senior', 'Mid-level')"


def stored(spark, folder) -> DataFrame:
    """Processed postings read back from a table, as reports find them."""
    path = scratch_path(spark, "processed")
    processed(spark, folder).write.parquet(path)
    return spark.read.parquet(path)


def section(rows: DataFrame, name: str, label, value) -> DataFrame:
    return rows.select(
        F.lit(name).alias("section"), label.cast("string").alias("label"), value.cast("double").alias("value")
    )


def stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def numbers(rows: DataFrame, name: str) -> DataFrame:
    """A one-row section: a row per column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).cast("double").alias("value")) for c in rows.columns])
    return rows.select(F.inline(pairs)).select(F.lit(name).alias("section"), "label", "value")


def _overview_sql(rows: str) -> str:
    return f"""{S.WITH_SKILLS}, chosen AS (SELECT * FROM posts WHERE {rows}),
    t AS (SELECT count(*) AS postings, count(DISTINCT company) AS companies, count(DISTINCT location) AS locations,
      {S.half_even('count(pay) / count(*)', 4)} AS salary_coverage, {S.pounds('median(pay)')} AS median_salary FROM chosen)
    SELECT 'totals' AS section, unnest(['postings', 'companies', 'locations', 'salary_coverage', 'median_salary']) AS label,
      unnest([CAST(postings AS DOUBLE), companies, locations, salary_coverage, median_salary]) AS value FROM t
    UNION ALL SELECT 'postings_per_week', {S.day("date_trunc('week', created_at)")}, count(*) FROM chosen
      WHERE created_at IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'by_role', role_category, count(*) FROM chosen GROUP BY 2
    UNION ALL SELECT 'by_seniority', seniority, count(*) FROM chosen GROUP BY 2
    UNION ALL (SELECT 'top_locations', location, count(*) AS n FROM chosen GROUP BY 2 ORDER BY n DESC, location LIMIT 10)"""


def _overview(spark, folder, selections):
    report = reports.overview(stored(spark, folder), selections)
    label, count = F.col("label"), F.col("count")
    return stacked(
        [
            numbers(report["totals"], "totals"),
            section(report["postings_per_week"], "postings_per_week", F.col("period"), count),
            *(section(report[n], n, label, count) for n in ("by_role", "by_seniority", "top_locations")),
        ]
    )


@query("report_overview", _overview_sql("true"))
def _(spark, folder):
    return _overview(spark, folder, {})


@query("report_overview_filtered", _overview_sql(_CONTRACT))
def _(spark, folder):
    return _overview(spark, folder, CONTRACT)


def _salary_sql(rows: str) -> str:
    def boxes(name: str, label: str) -> str:
        return f"""SELECT '{name}' AS section, label, m AS value FROM (
          SELECT {label} AS label, median(pay) AS m FROM chosen WHERE pay IS NOT NULL GROUP BY 1)"""

    return f"""{S.WITH_SKILLS}, chosen AS (SELECT * FROM posts WHERE {rows}),
    b AS (SELECT min(pay) AS mn, max(pay) AS mx FROM chosen),
    e AS (SELECT CAST(i AS INT) AS i, CASE WHEN i = 0 THEN mn - 0.001 * (mx - mn) WHEN i = 24 THEN mx
                 ELSE mn + i * ((mx - mn) / 24) END AS edge FROM b, range(25) AS r(i)),
    k AS (SELECT lo.i AS bucket, lo.edge AS low, hi.edge AS high FROM e lo JOIN e hi ON hi.i = lo.i + 1),
    sized AS (SELECT skill, median(pay) AS m, count(*) AS n FROM (SELECT unnest(skills) AS skill, pay FROM chosen)
              WHERE pay IS NOT NULL GROUP BY 1 HAVING count(*) >= 5 ORDER BY n DESC, skill LIMIT 12)
    {boxes('by_role', 'role_category')} UNION ALL {boxes('by_seniority', 'seniority')}
    UNION ALL SELECT 'histogram', CAST(bucket AS VARCHAR), count(pay) FROM k LEFT JOIN chosen ON pay > low AND pay <= high GROUP BY 2
    UNION ALL SELECT 'by_skill', skill, {S.pounds('m')} FROM sized"""


def _salary(spark, folder, selections):
    return _salary_sections(reports.salary(stored(spark, folder), selections))


def _salary_sections(report):
    return stacked(
        [
            *(section(report[n], n, F.col("label"), F.col("median")) for n in ("by_role", "by_seniority")),
            section(report["histogram"], "histogram", F.col("bucket"), F.col("count")),
            section(report["by_skill"], "by_skill", F.col("skill"), F.col("median_salary")),
        ]
    )


@query("report_salary", _salary_sql("true"))
def _(spark, folder):
    return _salary(spark, folder, {})


@query("report_salary_filtered", _salary_sql(_CONTRACT))
def _(spark, folder):
    return _salary(spark, folder, CONTRACT)


_CATEGORIES = ", ".join(dict.fromkeys(owner.strip("()").split(", '")[0] for owner in S.OWNERS.split("), (")))


@query(
    "report_skills",
    f"""{_DEMAND}, named AS (SELECT unnest([{_CATEGORIES}]) AS category)
    SELECT 'total_distinct_skills' AS section, 'total_distinct_skills' AS label, CAST(count(*) AS DOUBLE) AS value FROM demand
    UNION ALL (SELECT 'skills', skill, pct_of_postings FROM demand ORDER BY postings_mentioning DESC, skill LIMIT 20)
    UNION ALL SELECT 'categories', category, 1 FROM named""",
)
def _(spark, folder):
    report = reports.skills(stored(spark, folder))
    return stacked(
        [
            numbers(report["total_distinct_skills"], "total_distinct_skills"),
            section(report["skills"], "skills", F.col("skill"), F.col("pct_of_postings")),
            section(report["categories"], "categories", F.col("category"), F.lit(1)),
        ]
    )


NINE = ["Python", "SQL", "Airflow", "AWS", "Azure", "Excel", "Tableau", "dbt", "Scala"]
_NINE = "skill IN (" + ", ".join(f"'{s}'" for s in NINE) + ")"


@query("skill_trend_nine", f"{S.WITH_SKILLS}, {_trend_sql('week', _NINE)} SELECT * FROM trend")
def _(spark, folder):
    rows = processed(spark, folder)
    return demand.skill_trend(rows, "W", demand.trend_choice(rows, NINE))


@query(
    "report_trend",
    f"""{S.WITH_SKILLS}, {_trend_sql('week', _NINE)}
    SELECT 'series' AS section, concat(skill, ' ', period) AS label, CAST(mentions AS DOUBLE) AS value FROM trend
    UNION ALL SELECT 'skills', skill, 1 FROM (SELECT unnest([{_NINE[10:-1]}]) AS skill)""",
)
def _(spark, folder):
    report = reports.trend(stored(spark, folder), requested=NINE)
    points = report["series"].select("skill", F.inline("points"))
    return stacked(
        [
            section(points, "series", F.concat_ws(" ", "skill", "period"), F.col("value")),
            section(report["skills"], "skills", F.col("skill"), F.lit(1)),
        ]
    )


@query(
    "report_postings",
    f"""{S.WITH_SKILLS} SELECT coalesce(nullif(title_clean, ''), title, '') AS title, coalesce(company, '') AS company,
      coalesce(location, '') AS location, role_category, seniority, {S.pounds('pay')} AS salary,
      array_to_string(skills[1:8], '|') AS skills, {S.day('created_at')} AS created, redirect_url AS url
    FROM (SELECT * FROM posts WHERE created_at IS NOT NULL AND {_CONTRACT} ORDER BY created_at DESC, id LIMIT 50)""",
)
def _(spark, folder):
    cards = reports.newest_postings(stored(spark, folder), CONTRACT)["postings"]
    return cards.withColumn("skills", F.array_join("skills", "|"))


_FILTERS = " UNION ALL ".join(
    f"SELECT DISTINCT 'filters' AS section, concat('{n} ', {n}) AS label, 1.0 AS value FROM posts WHERE trim({n}) <> ''"
    for n in ("role_category", "seniority", "location", "region", "contract_type")
)


@query(
    "report_meta",
    f"""{S.WITH_SKILLS} {_FILTERS}
    UNION ALL SELECT 'active_filters', unnest(['contract_type contract', 'seniority Senior', 'seniority Mid-level']), 1
    UNION ALL SELECT 'total_skills', 'total_skills', 56
    UNION ALL SELECT 'dataset', concat_ws(' ', {S.day('min(seen_at)')}, {S.day('max(seen_at)')}), count(*) FROM posts""",
)
def _(spark, folder):
    report = reports.meta(stored(spark, folder), selections=CONTRACT)
    pair = F.concat_ws(" ", "column_name", "value")
    return stacked(
        [
            section(report["filters"], "filters", pair, F.lit(1)),
            section(report["active_filters"], "active_filters", pair, F.lit(1)),
            numbers(report["total_skills"], "total_skills"),
            section(
                report["dataset"], "dataset", F.concat_ws(" ", "collected_from", "collected_to"), F.col("total_rows")
            ),
        ]
    )


# --- quantiles of values that lie close together ------------------------------------------

_CLOSE = "50000 + l_extendedprice / 1000"


@query(
    "boxplot_one_slot",
    f"WITH close AS (SELECT l_returnflag AS label, {_CLOSE} AS v FROM lineitem), {S.box('close', 'label', 'v')}",
)
def _(spark, folder):
    """Many distinct values in one of the slots."""
    rows = table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("label"), F.expr(_CLOSE).alias("v"))
    return box_plots(rows, ["label"], "v", (15_000.0, 250_000.0))


# --- skills in real text ---------------------------------------------------------------------

# The supplied prose is invented and names no technology; these occur in it.
TERMS = {
    "Licences": {
        "GPL": ["GNU General Public License"],
        "CC BY-NC": ["CC BY-NC", "creative commons"],
        "Apache": ["Apache License", "apache 2.0"],
    },
    "Languages": {
        "English": ["the", "and"],
        "German": ["der", "und"],
        "French": ["le", "que"],
        "Spanish": ["los", "de la"],
    },
    "Marks": {"Accounts": ["password"], "Rude": ["idiot", "loser"]},
}
_TERMS = ", ".join(f"('{s}', '{a}')" for skills in TERMS.values() for s, names in skills.items() for a in names)
_TEXTS = f"""WITH spelled AS (SELECT DISTINCT skill, {S.form('alias')} AS phrase FROM (VALUES {_TERMS}) AS d(skill, alias)),
  formed AS (SELECT doc_id, o_orderdate AS seen, o_totalprice AS pay, {S.form('text')} AS f
             FROM documents JOIN orders ON doc_id = o_orderkey),
  hits AS (SELECT DISTINCT doc_id, seen, pay, skill FROM formed JOIN spelled ON contains(f, phrase))"""


def tagged_documents(spark, folder) -> DataFrame:
    """Documents with the date and price of the order of the same number, and their skills."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.col("o_orderdate").alias("collected_at"),
        F.col("o_totalprice").alias("salary_midpoint"),
    )
    texts = table(spark, folder, "documents").select("doc_id", skills_in(F.col("text"), TERMS).alias("skills"))
    return texts.join(orders, "doc_id")


@query(
    "demand_in_documents",
    f"""{_TEXTS} SELECT skill, count(*) AS postings_mentioning,
    {S.half_even('100 * count(*) / (SELECT count(*) FROM formed)', 1)} AS pct_of_postings FROM hits GROUP BY 1""",
)
def _(spark, folder):
    return demand.skill_demand(tagged_documents(spark, folder), TERMS).drop("category")


@query(
    "trend_in_documents",
    f"""{_TEXTS} SELECT {S.day("date_trunc('month', seen)")} AS period, skill, count(*) AS mentions FROM hits GROUP BY 1, 2""",
)
def _(spark, folder):
    return demand.skill_trend(tagged_documents(spark, folder), "M")


@query(
    "pay_in_documents",
    f"""{_TEXTS} SELECT skill, {S.pounds('median(pay)')} AS median_salary, count(*) AS postings FROM hits
    WHERE pay BETWEEN 15000 AND 250000 GROUP BY 1 HAVING count(*) >= 5 ORDER BY 3 DESC, 1 LIMIT 12""",
)
def _(spark, folder):
    return salary.pay_by_skill(tagged_documents(spark, folder))


_CHOSEN = {"region": ["EUROPE", "ASIA"], "seniority": ["Senior", "Lead / Manager", "Mid-level"], "contract_type": ["contract"]}
_CHOSEN_SQL = " AND ".join(f"{c} IN ({', '.join(f"'{v}'" for v in values)})" for c, values in _CHOSEN.items())


def _totals_sql(kind: str, rows: str) -> str:
    return f"""SELECT '{kind}' AS rows_of, count(*) AS postings, count(DISTINCT company) AS companies,
      count(DISTINCT location) AS locations, {S.half_even('count(pay) / count(*)', 4)} AS salary_coverage,
      {S.pounds('median(pay)')} AS median_salary FROM paid WHERE {rows}"""


@query("overview_from_cells", f"{S.WITH_PAY} {_totals_sql('all', 'true')} UNION ALL {_totals_sql('chosen', _CHOSEN_SQL)}")
def _(spark, folder):
    """Headline totals of all postings and of a selection, from one table of cells."""
    path = scratch_path(spark, "overview-cells")
    overview_cells.build(processed(spark, folder), path)
    every = overview_cells.totals(spark, path, {}).withColumn("rows_of", F.lit("all"))
    return every.unionByName(overview_cells.totals(spark, path, _CHOSEN).withColumn("rows_of", F.lit("chosen")))


@query(
    "salary_from_cells",
    f"""SELECT 'all' AS rows_of, * FROM ({_salary_sql('true')})
    UNION ALL SELECT 'contract', * FROM ({_salary_sql(_CONTRACT)})
    UNION ALL SELECT 'chosen', * FROM ({_salary_sql(_CHOSEN_SQL)})""",
)
def _(spark, folder):
    """The salary report of all postings and of two selections, from one table of cells."""
    path = scratch_path(spark, "salary-cells")
    salary_cells.build(processed(spark, folder), path)
    cells = spark.read.parquet(path)
    kinds = {"all": {}, "contract": CONTRACT, "chosen": _CHOSEN}
    return stacked(
        [
            _salary_sections(salary_cells.report(cells, chosen)).withColumn("rows_of", F.lit(kind))
            for kind, chosen in kinds.items()
        ]
    )
