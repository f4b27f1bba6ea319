"""The registered queries: each name with its Spark job and, where SQL can, its check."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sql as S
from checks.postings import (
    fresh_postings,
    quoted,
    raw_postings,
    seen_again,
    table,
)
from vacanta.fixed_values import (
    CATEGORICAL_FEATURES,
    FILTER_COLUMNS,
    SKILL_DICTIONARY,
)
from vacanta.functions.skills import count_columns, ignored, recognised, skills_in
from vacanta.functions.text import clean_description, clean_title, strip_html
from vacanta.functions.titles import role_category, seniority
from vacanta.functions.values import iso_date, numeric_column, rounded_pounds, timestamp_column
from vacanta.operators import counts, demand, free_quantiles, salary, search_index
from vacanta.operators.dedupe import first_seen, merge_counts, merge_postings, new_ids
from vacanta.operators.dictionary import (
    dictionary_problems,
    dictionary_table,
    match_dictionary,
)
from vacanta.operators.features import FEATURES, feature_table, model_rows
from vacanta.operators.filters import apply_filters, filter_options, plausible_salary, search
from vacanta.operators.metrics import regression_metrics
from vacanta.operators.processing import (
    add_salary_midpoint,
    add_titles,
    process_postings,
)
from vacanta.operators.recent import newest, recent_postings
from vacanta.session import scratch_path
from vacanta.sources.readers import parse_adverts

Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Job], Job]:
    def register(job: Job) -> Job:
        JOBS[name] = job
        if check is not None:
            CHECKS[name] = check
        return job

    return register


def processed(spark: SparkSession, folder: str) -> DataFrame:
    return process_postings(raw_postings(spark, folder))


def priced(spark: SparkSession, folder: str) -> DataFrame:
    return add_salary_midpoint(raw_postings(spark, folder))


def titled(spark: SparkSession, folder: str) -> DataFrame:
    """What the reports need that do not look into descriptions."""
    cleaned = priced(spark, folder).withColumn("title_clean", clean_title(F.col("title")))
    return add_titles(cleaned, "title_clean")


def joined(name: str = "skills"):
    return F.array_join(name, "|").alias(name)


def longs(*names: str):
    return [F.col(n).cast("bigint").alias(n) for n in names]


# --- numbers, salaries, filters -------------------------------------------------------


@query(
    "numeric_coercion",
    f"{S.BASE} SELECT id, {S.number('salary_min')} AS salary_min, {S.number('salary_max')} AS salary_max, "
    "CAST(NULL AS DOUBLE) AS absent FROM raw",
)
def _(spark, folder):
    raw = raw_postings(spark, folder)
    names = ["salary_min", "salary_max", "absent"]
    return raw.select("id", *[numeric_column(raw, n).alias(n) for n in names])


@query("salary_midpoint", f"{S.WITH_PAY} SELECT id, salary_min, salary_max, salary_midpoint FROM paid")
def _(spark, folder):
    rows = priced(spark, folder)
    return rows.select("id", "salary_min", "salary_max", "salary_midpoint")


@query("plausible_salary", f"{S.WITH_PAY} SELECT id, pay AS salary FROM paid")
def _(spark, folder):
    rows = priced(spark, folder)
    return rows.select("id", plausible_salary(rows).alias("salary"))


SELECTION = {
    "role_category": ["Data Analyst", "Data Engineer"],
    "region": ["REGION_1", "REGION_2", "EUROPE", "ASIA"],
    "contract_type": ["permanent"],
    "seniority": [],
    "no_such_column": ["x"],
}


@query(
    "apply_filters",
    f"""{S.WITH_TITLES} SELECT id, role_category, region, contract_type FROM titled
    WHERE role_category IN ('Data Analyst', 'Data Engineer') AND contract_type = 'permanent'
      AND region IN ('REGION_1', 'REGION_2', 'EUROPE', 'ASIA')""",
)
def _(spark, folder):
    rows = apply_filters(titled(spark, folder), SELECTION)
    return rows.select("id", "role_category", "region", "contract_type")


@query(
    "filter_options",
    S.WITH_TITLES
    + " UNION ALL ".join(
        f" SELECT DISTINCT '{n}' AS column_name, {n} AS value FROM titled WHERE trim({n}) <> ''"
        for n in FILTER_COLUMNS
    ),
)
def _(spark, folder):
    return filter_options(titled(spark, folder))


@query(
    "model_rows",
    f"{S.WITH_PAY} SELECT id, {S.CATEGORICALS}, pay AS salary_midpoint FROM paid WHERE pay IS NOT NULL",
)
def _(spark, folder):
    return model_rows(titled(spark, folder)).select("id", *CATEGORICAL_FEATURES, "salary_midpoint")


@query(
    "search_postings",
    f"""{S.WITH_SKILLS} SELECT id FROM posts WHERE contains(lower(concat_ws(' ',
        CASE WHEN title_clean <> '' THEN title_clean ELSE coalesce(title, '') END,
        coalesce(company, ''), coalesce(location, ''), array_to_string(skills, ' '))), 'power bi')""",
)
def _(spark, folder):
    return search(processed(spark, folder), " Power BI ").select("id")


# --- text -------------------------------------------------------------------------------


@query("clean_title", f"{S.BASE} SELECT id, {S.clean_title('title')} AS title_clean FROM raw")
def _(spark, folder):
    return raw_postings(spark, folder).select("id", clean_title(F.col("title")).alias("title_clean"))


@query(
    "clean_description",
    f"""SELECT id, d AS description_clean, CAST(length(d) AS BIGINT) AS description_length
    FROM ({S.BASE} SELECT id, {S.clean_description('description')} AS d FROM raw)""",
)
def _(spark, folder):
    rows = raw_postings(spark, folder)
    cleaned = rows.select("id", clean_description(F.col("description")).alias("description_clean"))
    return cleaned.withColumn("description_length", F.length("description_clean").cast("bigint"))


@query("strip_html_pages", f"SELECT page_id, {S.strip_html('html')} AS text FROM pages")
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", strip_html(F.col("html")).alias("text"))


@query("clean_pages", f"SELECT page_id, {S.clean_description('html')} AS text FROM pages")
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", clean_description(F.col("html")).alias("text"))


@query("clean_documents", f"SELECT doc_id, {S.clean_description('text')} AS text FROM documents")
def _(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", clean_description(F.col("text")).alias("text")
    )


@query("classify_role", f"{S.WITH_TITLES} SELECT id, title_clean, role_category FROM titled")
def _(spark, folder):
    rows = raw_postings(spark, folder).withColumn("title_clean", clean_title(F.col("title")))
    return rows.select("id", "title_clean", role_category(F.col("title_clean")).alias("role_category"))


@query("classify_seniority", f"{S.WITH_TITLES} SELECT id, title_clean, seniority FROM titled")
def _(spark, folder):
    rows = raw_postings(spark, folder).withColumn("title_clean", clean_title(F.col("title")))
    return rows.select("id", "title_clean", seniority(F.col("title_clean")).alias("seniority"))


_PART_TITLE = "concat(p_type, ' ', p_name, ' analyst')"


@query(
    "classify_custom_rules",
    f"""SELECT l_orderkey, l_linenumber, CASE
      WHEN regexp_matches(t, '(?i)\\bring\\b|\\bbolt\\b') THEN 'Fastener'
      WHEN regexp_matches(t, '(?i)wid.et') THEN 'Widget' ELSE 'Part' END AS label
    FROM lineitem JOIN (SELECT p_partkey, {_PART_TITLE} AS t FROM part) ON l_partkey = p_partkey""",
)
def _(spark, folder):
    from vacanta.functions.titles import label_by_rules

    parts = table(spark, folder, "part").select("p_partkey", F.expr(_PART_TITLE).alias("t"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    rules = [("Fastener", [r"\bring\b", r"\bbolt\b"]), ("Widget", ["wid.et"])]
    labelled = parts.select("p_partkey", label_by_rules(F.col("t"), rules, "Part").alias("label"))
    return lines.join(labelled, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "label"
    )


# --- skills -------------------------------------------------------------------------------


@query(
    "skills_extracted",
    f"{S.WITH_SKILLS} SELECT id, array_to_string(skills, '|') AS skills FROM posts",
)
def _(spark, folder):
    return processed(spark, folder).select("id", joined())


@query(
    "skills_in_documents",
    f"""WITH spelled AS (SELECT DISTINCT skill, {S.form('alias')} AS phrase
            FROM (VALUES {S.DICTIONARY}) AS d(category, skill, alias)),
    formed AS (SELECT doc_id, {S.form('text')} AS f FROM documents),
    hits AS (SELECT DISTINCT doc_id, skill FROM formed JOIN spelled ON contains(f, phrase))
    SELECT d.doc_id, coalesce(string_agg(skill, '|' ORDER BY skill), '') AS skills
    FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY 1""",
)
def _(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return documents.select("doc_id", skills_in(F.col("text")).alias("skills")).select("doc_id", joined())


def phrase_dictionary(spark, folder):
    """A dictionary that grows with the data: whole benchmark items as spellings."""
    return table(spark, folder, "benchmark").select(
        F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("skill"),
        F.col("text").alias("alias"),
    )


@query(
    "skills_ngram_join",
    f"""WITH spelled AS (SELECT DISTINCT concat('item ', CAST(item_id AS VARCHAR)) AS skill,
        {S.form("text")} AS phrase FROM benchmark),
    formed AS (SELECT doc_id, {S.form('text')} AS f FROM documents),
    hits AS (SELECT DISTINCT doc_id, skill FROM formed JOIN spelled ON contains(f, phrase)
             WHERE trim(phrase) <> '')
    SELECT d.doc_id, coalesce(string_agg(skill, '|' ORDER BY skill), '') AS skills
    FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY 1""",
)
def _(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return match_dictionary(documents, phrase_dictionary(spark, folder), "doc_id").select("doc_id", joined())


@query(
    "skills_ngram_postings",
    f"{S.WITH_SKILLS} SELECT id, array_to_string(skills, '|') AS skills FROM posts",
)
def _(spark, folder):
    rows = raw_postings(spark, folder).select(
        "id", clean_description(F.col("description")).alias("text")
    )
    return match_dictionary(rows, dictionary_table(spark)).select("id", joined())


@query(
    "skill_category_counts",
    f"{S.WITH_SKILLS} SELECT id, {S.COUNTS}, CAST(len(skills) AS BIGINT) AS n_skills_total FROM posts",
)
def _(spark, folder):
    rows = processed(spark, folder)
    return rows.select("id", *longs(*count_columns(), "n_skills_total"))


@query(
    "recognised_skills",
    f"""{S.WITH_SKILLS}, wanted AS (SELECT id, list_concat(skills, [company, 'Python']) AS w FROM posts)
    SELECT id, array_to_string(list_filter(w, lambda s: s IN (SELECT skill FROM (VALUES {S.OWNERS}) o(c, skill))), '|')
             AS recognised,
           array_to_string(list_filter(w, lambda s: s NOT IN (SELECT skill FROM (VALUES {S.OWNERS}) o(c, skill))), '|')
             AS ignored FROM wanted""".replace(
        f"(SELECT skill FROM (VALUES {S.OWNERS}) o(c, skill))",
        "(" + ", ".join(quoted(s) for g in SKILL_DICTIONARY.values() for s in g) + ")",
    ),
)
def _(spark, folder):
    rows = processed(spark, folder)
    wanted = rows.select("id", F.concat("skills", F.array(F.col("company"), F.lit("Python"))).alias("w"))
    return wanted.select(
        "id",
        F.array_join(recognised(F.col("w")), "|").alias("recognised"),
        F.array_join(ignored(F.col("w")), "|").alias("ignored"),
    )


_DEMAND = f"""{S.WITH_SKILLS}, owners AS (SELECT * FROM (VALUES {S.OWNERS}) AS o(category, skill)),
mentions AS (SELECT skill, count(*) AS n FROM (SELECT unnest(skills) AS skill FROM posts) GROUP BY 1),
demand AS (SELECT m.skill, coalesce(o.category, 'Other') AS category, n AS postings_mentioning,
    {S.half_even('100.0 * n / (SELECT count(*) FROM posts)', 1)} AS pct_of_postings
    FROM mentions m LEFT JOIN owners o ON m.skill = o.skill)"""


@query("skill_demand", f"{_DEMAND} SELECT * FROM demand")
def _(spark, folder):
    return demand.skill_demand(processed(spark, folder))


@query(
    "skill_demand_top",
    f"{_DEMAND} SELECT * FROM demand ORDER BY postings_mentioning DESC, skill LIMIT 20",
)
def _(spark, folder):
    return demand.most_mentioned(demand.skill_demand(processed(spark, folder)))


@query("skill_demand_category", f"{_DEMAND} SELECT * FROM demand WHERE category = 'Data Engineering'")
def _(spark, folder):
    return demand.in_category(demand.skill_demand(processed(spark, folder)), "Data Engineering")


@query(
    "distinct_skills",
    f"{_DEMAND} SELECT count(*) AS total_distinct_skills FROM demand WHERE category = 'Cloud Platforms'",
)
def _(spark, folder):
    rows = demand.in_category(demand.skill_demand(processed(spark, folder)), "Cloud Platforms")
    return rows.agg(F.count("skill").alias("total_distinct_skills"))


@query(
    "part_type_demand",
    """WITH lists AS (SELECT l_orderkey, list(DISTINCT p_type) AS skills
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
    m AS (SELECT skill, count(*) AS n FROM (SELECT unnest(skills) AS skill FROM lists) GROUP BY 1)
    SELECT m.skill, coalesce(o.category, 'Other') AS category, n AS postings_mentioning,
      CAST(round_even(100.0 * n / (SELECT count(*) FROM lists), 1) AS DOUBLE) AS pct_of_postings
    FROM m LEFT JOIN (SELECT p_type AS skill, min(p_brand) AS category FROM part
                      WHERE p_type <> 'SMALL' GROUP BY 1) o ON m.skill = o.skill""",
)
def _(spark, folder):
    part = table(spark, folder, "part")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    lists = (
        lines.join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.collect_set("p_type").alias("skills"))
    )
    owners = part.filter("p_type <> 'SMALL'").select(
        F.col("p_type").alias("skill"), F.col("p_brand").alias("category")
    )
    return demand.skill_demand(lists, owners)


def _trend_sql(unit: str, only: str = "true") -> str:
    return f"""trend AS (SELECT {S.day(f"date_trunc('{unit}', seen_at)")} AS period, skill, count(*) AS mentions
      FROM (SELECT seen_at, unnest(skills) AS skill FROM posts) WHERE seen_at IS NOT NULL AND {only} GROUP BY 1, 2)"""


@query("skill_trend_week", f"{S.WITH_SKILLS}, {_trend_sql('week')} SELECT * FROM trend")
def _(spark, folder):
    return demand.skill_trend(processed(spark, folder), "W")


@query("skill_trend_month", f"{S.WITH_SKILLS}, {_trend_sql('month')} SELECT * FROM trend")
def _(spark, folder):
    return demand.skill_trend(processed(spark, folder), "M")


@query("skill_trend_day", f"{S.WITH_SKILLS}, {_trend_sql('day')} SELECT * FROM trend")
def _(spark, folder):
    return demand.skill_trend(processed(spark, folder), "D")


_CHOSEN = ["Python", "SQL", "Airflow"]
_ONLY = "skill IN ('Python', 'SQL', 'Airflow')"


@query("skill_trend_selected", f"{S.WITH_SKILLS}, {_trend_sql('week', _ONLY)} SELECT * FROM trend")
def _(spark, folder):
    rows = processed(spark, folder)
    return demand.skill_trend(rows, "W", demand.trend_choice(rows, _CHOSEN))


_TOP4 = "skill IN (SELECT skill FROM demand ORDER BY postings_mentioning DESC, skill LIMIT 4)"


@query(
    "skill_trend_top4",
    f"""{_DEMAND}, {_trend_sql('month', _TOP4)}
    SELECT skill, string_agg(concat(period, '=', CAST(mentions AS VARCHAR)), ',' ORDER BY period) AS points
    FROM trend GROUP BY 1""",
)
def _(spark, folder):
    rows = processed(spark, folder)
    series = demand.trend_series(demand.skill_trend(rows, "M", demand.trend_choice(rows)))
    shown = F.transform("points", lambda p: F.concat(p["period"], F.lit("="), p["value"].cast("string")))
    return series.select("skill", F.array_join(shown, ",").alias("points"))


@query(
    "skill_trend_dense",
    f"""{S.WITH_SKILLS}, {_trend_sql('week', _ONLY)},
    grid AS (SELECT p.period, s.skill FROM (SELECT DISTINCT period FROM trend) p,
                                           (SELECT DISTINCT skill FROM trend) s)
    SELECT g.period, g.skill, coalesce(t.mentions, 0) AS mentions
    FROM grid g LEFT JOIN trend t ON g.period = t.period AND g.skill = t.skill""",
)
def _(spark, folder):
    rows = processed(spark, folder)
    return demand.dense_trend(demand.skill_trend(rows, "W", _CHOSEN))


@query(
    "dictionary_problems",
    """WITH d AS (SELECT p_type AS category, p_brand AS skill, p_name AS alias FROM part),
    named AS (SELECT DISTINCT category, concat('n_', replace(replace(category, ' ', '_'), '&', 'and')) AS name FROM d)
    SELECT 'skill in several categories' AS problem, skill AS subject FROM d GROUP BY skill
      HAVING count(DISTINCT category) > 1
    UNION ALL SELECT 'skill without category', skill FROM d GROUP BY skill HAVING count(*) > count(category)
    UNION ALL SELECT 'blank spelling', skill FROM d WHERE alias IS NULL OR trim(alias) = ''
    UNION ALL SELECT 'count column not unique', category FROM named
      WHERE name IN (SELECT name FROM named GROUP BY name HAVING count(*) > 1)
    UNION ALL SELECT 'count column name not safe', category FROM named WHERE NOT regexp_full_match(name, '[^ &]+')""",
)
def _(spark, folder):
    return dictionary_problems(
        table(spark, folder, "part").select(
            F.col("p_type").alias("category"), F.col("p_brand").alias("skill"), F.col("p_name").alias("alias")
        )
    )


# --- counts over the table -------------------------------------------------------------------


@query(
    "overview_totals",
    f"""{S.WITH_PAY} SELECT count(*) AS postings, count(DISTINCT company) AS companies,
    count(DISTINCT location) AS locations, {S.half_even('count(pay) / count(*)', 4)} AS salary_coverage,
    {S.pounds('median(pay)')} AS median_salary FROM paid""",
)
def _(spark, folder):
    return counts.overview_totals(priced(spark, folder))


def _counts_sql(column: str) -> str:
    return f"SELECT {column} AS label, count(*) AS count FROM titled WHERE {column} IS NOT NULL GROUP BY 1"


@query("top_counts_role", f"{S.WITH_TITLES} {_counts_sql('role_category')}")
def _(spark, folder):
    return counts.value_counts(titled(spark, folder), "role_category")


@query("top_counts_seniority", f"{S.WITH_TITLES} {_counts_sql('seniority')}")
def _(spark, folder):
    return counts.value_counts(titled(spark, folder), "seniority")


@query("top_locations", f"{S.WITH_TITLES} {_counts_sql('location')} ORDER BY count DESC, label LIMIT 10")
def _(spark, folder):
    return counts.top_locations(titled(spark, folder))


_DIMENSIONS = ["role_category", "seniority", "location"]


@query(
    "value_counts_one_scan",
    S.WITH_TITLES
    + " UNION ALL ".join(
        f" SELECT '{n}' AS dimension, {n} AS label, count(*) AS count FROM titled GROUP BY 2" for n in _DIMENSIONS
    ),
)
def _(spark, folder):
    return counts.value_counts_of(titled(spark, folder), _DIMENSIONS)


def _period_sql(unit: str) -> str:
    return f"""{S.WITH_PAY} SELECT {S.day(f"date_trunc('{unit}', created_at)")} AS period, count(*) AS count
    FROM paid WHERE created_at IS NOT NULL GROUP BY 1"""


@query("postings_per_week", _period_sql("week"))
def _(spark, folder):
    return counts.period_counts(priced(spark, folder), "created", "W")


@query("postings_per_month", _period_sql("month"))
def _(spark, folder):
    return counts.period_counts(priced(spark, folder), "created", "M")


@query("postings_per_day", _period_sql("day"))
def _(spark, folder):
    return counts.period_counts(priced(spark, folder), "created", "D")


@query(
    "events_per_week",
    """SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS period, count(*) AS count
    FROM events WHERE ts IS NOT NULL GROUP BY 1""",
)
def _(spark, folder):
    return counts.period_counts(table(spark, folder, "events"), "ts", "W")


@query(
    "timestamps_normalised",
    f"""{S.WITH_PAY} SELECT id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created,
    strftime(seen_at, '%Y-%m-%d %H:%M:%S') AS collected_at FROM paid""",
)
def _(spark, folder):
    raw = raw_postings(spark, folder)
    shown = {
        n: F.date_format(timestamp_column(raw, n), "yyyy-MM-dd HH:mm:ss") for n in ("created", "collected_at")
    }
    return raw.select("id", *[c.alias(n) for n, c in shown.items()])


@query(
    "dataset_summary",
    f"""{S.WITH_PAY} SELECT count(*) AS total_rows, {S.day('min(seen_at)')} AS collected_from,
    {S.day('max(seen_at)')} AS collected_to FROM paid""",
)
def _(spark, folder):
    return counts.dataset_summary(priced(spark, folder))


@query(
    "processing_summary",
    f"""{S.WITH_PAY} SELECT count(*) AS rows, count(salary_midpoint) AS with_salary,
    {S.half_even('count(salary_midpoint) / count(*)', 4)} AS salary_share FROM paid""",
)
def _(spark, folder):
    return counts.processing_summary(priced(spark, folder))


@query(
    "health_report",
    f"""{S.BASE} SELECT 'ok' AS status, CAST(NULL AS VARCHAR) AS detail, count(*) AS dataset_rows, false AS model_loaded, """
    + ", ".join(
        f"{S.half_even(f'count(*) FILTER ({n} IS NULL) / count(*)', 4)} AS null_share_{n}"
        for n in ("id", "company", "region", "contract_type", "created")
    )
    + " FROM raw",
)
def _(spark, folder):
    return counts.health(priced(spark, folder))


# --- salary reports ------------------------------------------------------------------------------


@query("boxplot_by_role", f"{S.WITH_PAY}, {S.box('paid', 'role_category', 'pay')}")
def _(spark, folder):
    return salary.salary_distribution(titled(spark, folder), "role_category")


@query("boxplot_by_seniority", f"{S.WITH_PAY}, {S.box('paid', 'seniority', 'pay')}")
def _(spark, folder):
    return salary.salary_distribution(titled(spark, folder), "seniority")


_REGION = "coalesce(region, 'nan')"


@query(
    "boxplot_by_region_permanent",
    f"""{S.WITH_PAY}, chosen AS (SELECT * FROM paid WHERE contract_type = 'permanent'),
    {S.box('chosen', _REGION, 'pay')}""",
)
def salary_by_region(spark, folder):
    rows = apply_filters(priced(spark, folder), {"contract_type": ["permanent"]})
    return salary.salary_distribution(rows, "region")


@query("boxplot_by_company", f"{S.WITH_PAY}, {S.box('paid', 'company', 'pay')}")
def _(spark, folder):
    return salary.salary_distribution(priced(spark, folder), "company")


_ALL = "'all'"


@query(
    "boxplot_overall",
    f'{S.WITH_PAY}, {S.box("paid", _ALL, "pay")}'.replace('SELECT q.label, w.min AS "min"', 'SELECT w.min AS "min"'),
)
def _(spark, folder):
    return salary.salary_box(priced(spark, folder))


@query(
    "salary_histogram",
    f"""{S.WITH_PAY}, b AS (SELECT min(pay) AS mn, max(pay) AS mx FROM paid),
    e AS (SELECT CAST(i AS INT) AS i, CASE WHEN i = 0 THEN mn - 0.001 * (mx - mn) WHEN i = 24 THEN mx
                 ELSE mn + i * ((mx - mn) / 24) END AS edge FROM b, range(25) AS r(i)),
    k AS (SELECT lo.i AS bucket, lo.edge AS low, hi.edge AS high FROM e lo JOIN e hi ON hi.i = lo.i + 1)
    SELECT bucket, {S.pounds('low')} AS lower, {S.pounds('high')} AS upper, count(pay) AS count
    FROM k LEFT JOIN paid ON pay > low AND pay <= high GROUP BY 1, 2, 3""",
)
def _(spark, folder):
    return salary.salary_histogram(priced(spark, folder))


@query(
    "pay_by_skill",
    f"""{S.WITH_SKILLS}, pairs AS (SELECT unnest(skills) AS skill, pay FROM posts),
    sized AS (SELECT skill, median(pay) AS m, count(*) AS n FROM pairs WHERE pay IS NOT NULL GROUP BY 1),
    top AS (SELECT * FROM sized WHERE n >= 5 ORDER BY n DESC, skill LIMIT 12)
    SELECT skill, {S.pounds('m')} AS median_salary, n AS postings FROM top""",
)
def _(spark, folder):
    return salary.pay_by_skill(processed(spark, folder))


# --- postings and merges -----------------------------------------------------------------------------


@query(
    "recent_postings",
    f"""{S.WITH_SKILLS}, top AS (SELECT * FROM posts WHERE created_at IS NOT NULL
        ORDER BY created_at DESC, id LIMIT 50)
    SELECT CASE WHEN title_clean <> '' THEN title_clean ELSE coalesce(title, '') END AS title,
      company, location, role_category, seniority, {S.pounds('pay')} AS salary,
      array_to_string(skills[1:8], '|') AS skills, {S.day('created_at')} AS created, redirect_url AS url FROM top""",
)
def _(spark, folder):
    # The newest rows are chosen before their texts are worked on.
    cards = recent_postings(process_postings(newest(raw_postings(spark, folder))))
    return cards.withColumn("skills", F.array_join("skills", "|"))


_SEEN = f"{S.BASE}, {S.AGAIN}, {S.FRESH}"
_FIRST = """ranked AS (SELECT *, row_number() OVER (PARTITION BY id
    ORDER BY TRY_CAST(collected_at AS TIMESTAMP), source_rank) AS place FROM sightings)"""


@query(
    "dedupe_first_seen",
    f"""{_SEEN}, sightings AS (SELECT *, 0 AS source_rank FROM raw UNION ALL SELECT *, 1 FROM again), {_FIRST}
    SELECT id, company, collected_at FROM ranked WHERE place = 1""",
)
def _(spark, folder):
    first, again = raw_postings(spark, folder), seen_again(spark, folder)
    rows = first.withColumn("rank", F.lit(0)).unionByName(again.withColumn("rank", F.lit(1)))
    return first_seen(rows, "rank").select("id", "company", "collected_at")


@query(
    "merge_postings",
    f"""{_SEEN}, sightings AS (SELECT *, 0 AS source_rank FROM raw UNION ALL SELECT *, 1 FROM again
                               UNION ALL SELECT *, 1 FROM fresh), {_FIRST}
    SELECT id, company, title, collected_at FROM ranked WHERE place = 1""",
)
def _(spark, folder):
    new = seen_again(spark, folder).unionByName(fresh_postings(spark, folder))
    return merge_postings(raw_postings(spark, folder), new).select("id", "company", "title", "collected_at")


@query(
    "merge_added_total",
    f"""{_SEEN} SELECT (SELECT count(DISTINCT id) FROM fresh) AS added,
    (SELECT count(DISTINCT id) FROM (SELECT id FROM raw UNION ALL SELECT id FROM again
                                     UNION ALL SELECT id FROM fresh)) AS total""",
)
def _(spark, folder):
    new = seen_again(spark, folder).unionByName(fresh_postings(spark, folder))
    return merge_counts(raw_postings(spark, folder), new)


@query(
    "new_ids_anti",
    f"""{_SEEN} SELECT DISTINCT id FROM (SELECT id FROM again UNION ALL SELECT id FROM fresh)
    WHERE id NOT IN (SELECT id FROM raw)""",
)
def _(spark, folder):
    new = seen_again(spark, folder).unionByName(fresh_postings(spark, folder))
    return new_ids(raw_postings(spark, folder), new)


# --- nested adverts --------------------------------------------------------------------------------------

# JSON texts built in both engines; every nested part is missing for some rows.
_ADVERT_SQL = """SELECT CAST(o_orderkey AS STRING) AS key, concat('{{"id": ', CAST(o_orderkey AS STRING),
  ', "title": "  Role ', o_orderpriority, ' "',
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat(', "company": {{"display_name": "C', CAST(o_custkey AS STRING), '"}}') END,
  CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN ', "location": {{"display_name": "L", "area": []}}'
    WHEN 2 THEN ', "location": {{"area": ["UK"]}}' WHEN 3 THEN ', "location": {{"display_name": "L", "area": ["UK", null]}}'
    ELSE concat(', "location": {{"display_name": "L", "area": ["UK", "R', CAST(o_orderkey % 7 AS STRING), '", "X"]}}') END,
  ', "salary_min": ', CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING),
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE ', "category": {{"label": "IT"}}' END,
  ', "created": "', CAST(CAST(o_orderdate AS DATE) AS STRING), 'T00:00:00Z"}}') AS advert FROM {orders}"""


@query(
    "flatten_json",
    f"""WITH a AS ({_ADVERT_SQL.format(orders='orders')}),
    j AS (SELECT CAST(advert AS JSON) AS v FROM a)
    SELECT v->>'$.id' AS id, trim(v->>'$.title') AS title,
      coalesce(v->>'$.company.display_name', '') AS company, coalesce(v->>'$.location.display_name', '') AS location,
      CASE WHEN json_array_length(v->'$.location.area') > 1 THEN v->>'$.location.area[1]'
           ELSE v->>'$.location.area[0]' END AS region,
      '' AS description, CAST(v->>'$.salary_min' AS DOUBLE) AS salary_min,
      coalesce(v->>'$.category.label', '') AS category, v->>'$.created' AS created, 'all' AS query FROM j""",
)
def _(spark, folder):
    adverts = spark.sql(_ADVERT_SQL, orders=table(spark, folder, "orders"))
    flat = parse_adverts(adverts, "advert", F.lit("all"), F.lit(None).cast("string"))
    return flat.select(
        "id", "title", "company", "location", "region", "description", "salary_min", "category", "created", "query"
    )


# --- model --------------------------------------------------------------------------------------------------


@query(
    "model_features",
    f"""{S.WITH_SKILLS} SELECT id, {S.CATEGORICALS}, CAST(len(skills) AS DOUBLE) AS n_skills_total,
    CAST(length(description_clean) AS DOUBLE) AS description_length,
    {S.COUNTS.replace('AS BIGINT', 'AS DOUBLE')}, round(ln(pay), 6) AS log_salary
    FROM posts WHERE pay IS NOT NULL""",
)
def _(spark, folder):
    rows = feature_table(processed(spark, folder), ("id",))
    return rows.select("id", *FEATURES, F.round("log_salary", 6).alias("log_salary"))


_GUESS = "ln(pay * (0.9 + (CAST(id AS BIGINT) % 5) * 0.05))"


@query(
    "regression_metrics",
    f"""{S.WITH_PAY}, p AS (SELECT ln(pay) AS y, {_GUESS} AS p FROM paid WHERE pay IS NOT NULL)
    SELECT round(avg(abs(exp(p) - exp(y))), 2) AS mae_gbp, round(sqrt(avg((exp(p) - exp(y)) * (exp(p) - exp(y)))), 2)
      AS rmse_gbp, round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(y)), 6) AS r2,
      round(avg(abs(p - y)), 6) AS mae_log FROM p""",
)
def _(spark, folder):
    rows = priced(spark, folder)
    paid = rows.select("id", plausible_salary(rows).alias("pay")).filter("pay IS NOT NULL")
    pairs = paid.select(F.ln("pay").alias("log_salary"), F.expr(_GUESS).alias("prediction"))
    digits = {"mae_gbp": 2, "rmse_gbp": 2, "r2": 6, "mae_log": 6}
    return regression_metrics(pairs).select(*[F.round(n, d).alias(n) for n, d in digits.items()])


_CUBED = """SELECT l_returnflag, l_linestatus, 'price' AS measure, l_extendedprice AS v FROM {lineitem}
  UNION ALL SELECT l_returnflag, l_linestatus, 'cube', l_extendedprice * l_extendedprice * l_extendedprice / 1000000 FROM {lineitem}"""


@query(
    "quantiles_without_bounds",
    f"""SELECT l_returnflag, l_linestatus, measure, {S.half_even('quantile_cont(v, 0.25)', 2)} AS q1, {S.half_even('median(v)', 2)} AS middle,
    {S.half_even('quantile_cont(v, 0.99)', 2)} AS top, count(v) AS count FROM ({_CUBED.format(lineitem='lineitem')}) GROUP BY 1, 2, 3""",
)
def _(spark, folder):
    """Quantiles of prices and of their cubes, which lie orders of magnitude apart."""
    rows = spark.sql(_CUBED, lineitem=table(spark, folder, "lineitem"))
    keys = ["l_returnflag", "l_linestatus", "measure"]
    found = free_quantiles.quantiles(rows, keys, "v", {"q1": 0.25, "middle": 0.5, "top": 0.99})
    return found.select(*keys, *(F.bround(c, 2).alias(c) for c in ("q1", "middle", "top")), "count")


_WORDS = ("power bi", " Customer#00000001 ", "ENGINEER", "united", "qz", "no such words")


@query(
    "search_index",
    f"""{S.WITH_SKILLS}, texts AS (SELECT id, lower(concat_ws(' ', CASE WHEN title_clean <> '' THEN title_clean ELSE coalesce(title, '') END,
        coalesce(company, ''), coalesce(location, ''), array_to_string(skills, ' '))) AS t FROM posts)
    SELECT word, id FROM texts, (SELECT unnest([{', '.join(f"'{w}'" for w in _WORDS)}]) AS word) WHERE contains(t, lower(trim(word)))""",
)
def _(spark, folder):
    """Several searches of one index of trigrams."""
    path = scratch_path(spark, "search-index")
    search_index.build(processed(spark, folder).select("id", "title", "title_clean", "company", "location", "skills"), path)
    found = [search_index.search(spark, path, w).select(F.lit(w).alias("word"), "id") for w in _WORDS]
    return reduce(DataFrame.unionByName, found)
