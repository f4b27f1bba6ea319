"""Registered queries that write, stream or train before they answer.

Everything they write goes below the shared folder, to a path no other run uses.
"""

from __future__ import annotations

from functools import partial

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import model_sql
from checks import sql as S
from checks.postings import (
    RAW_SQL,
    SCHEMAS,
    fresh_postings,
    raw_postings,
    seen_again,
    table,
)
from checks.queries import (
    _SEEN,
    _FIRST,
    _trend_sql,
    joined,
    longs,
    priced,
    processed,
    query,
)
from vacanta.fixed_values import INTERVAL_LOG_SPREAD
from vacanta.functions.skills import count_columns
from vacanta.functions.values import timestamp_column
from vacanta.operators.counts import value_counts
from vacanta.operators.features import feature_table, fill_features, fold_of, is_holdout
from vacanta.operators.metrics import regression_metrics
from vacanta.operators.processing import process_postings
from vacanta.plans import boosted_trees, model_choice, refresh, scoring, training
from vacanta.plans.linear_models import Sums
from vacanta.session import scratch_path, use_utc
from vacanta.sources.readers import (
    read_processed_csv,
    read_raw_csv,
    read_searches,
    rejected_records,
)
from vacanta.sources.searches import failed_records, found_postings, load_searches
from vacanta.sources.writers import as_json, write_csv
from vacanta.streaming.first_sightings import first_sightings, keep_first_sightings
from vacanta.streaming.ingest import ingest
from vacanta.streaming.live_counts import (
    keep_counts,
    latest_counts,
    weekly_mentions,
    weekly_postings,
)

# --- files -------------------------------------------------------------------------


@query(
    "raw_csv_roundtrip",
    f"{S.BASE} SELECT id, nullif(title, '') AS title, company, region, description, salary_min, created FROM raw",
)
def _(spark, folder):
    path = scratch_path(spark, "raw-csv")
    write_csv(raw_postings(spark, folder), path)
    return read_raw_csv(spark, path).select(
        "id", "title", "company", "region", "description", "salary_min", "created"
    )


@query(
    "skills_csv_roundtrip",
    f"""{S.WITH_SKILLS} SELECT id, array_to_string(skills, '|') AS skills, CAST(len(skills) AS BIGINT) AS n_skills_total,
    description_clean, salary_midpoint FROM posts""",
)
def _(spark, folder):
    path = scratch_path(spark, "processed-csv")
    rows = processed(spark, folder)
    write_csv(rows, path)
    back = read_processed_csv(spark, path, rows.schema)
    return back.select("id", joined(), *longs("n_skills_total"), "description_clean", "salary_midpoint")


_SEARCH_FILES = """SELECT CASE o_orderstatus WHEN 'O' THEN 'data analyst' WHEN 'F' THEN 'data engineer'
    ELSE 'data scientist' END AS query,
  CASE WHEN o_orderkey % 101 = 0 THEN '{{"id": broken' ELSE
    concat('{{"id": "', CAST(o_orderkey AS STRING), '", "title": " T', o_orderpriority, ' "}}') END AS value
  FROM {orders}"""


def _search_folder(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "searches")
    files = spark.sql(_SEARCH_FILES, orders=table(spark, folder, "orders"))
    files.write.partitionBy("query").text(path)
    return path


@query(
    "collect_searches",
    f"""WITH f AS ({_SEARCH_FILES.format(orders='orders')})
    SELECT query, value::JSON->>'$.id' AS id, trim(value::JSON->>'$.title') AS title, '' AS company
    FROM f WHERE json_valid(value)""",
)
def _(spark, folder):
    path = _search_folder(spark, folder)
    return read_searches(spark, path).select("query", "id", "title", "company")


@query(
    "collect_rejects",
    f"""WITH f AS ({_SEARCH_FILES.format(orders='orders')})
    SELECT query, count(*) AS rejected FROM f WHERE NOT json_valid(value) GROUP BY 1""",
)
def _(spark, folder):
    return rejected_records(spark, _search_folder(spark, folder)).groupBy("query").agg(
        F.count(F.lit(1)).alias("rejected")
    )


@query(
    "source_searches",
    f"""WITH f AS ({_SEARCH_FILES.format(orders='orders')})
    SELECT query, value::JSON->>'$.id' AS id, trim(value::JSON->>'$.title') AS title, '' AS company
    FROM f WHERE json_valid(value)""",
)
def _(spark, folder):
    """The same searches by the data source, in pieces smaller than a page."""
    records = load_searches(spark, _search_folder(spark, folder), piece_bytes="65536")
    return found_postings(records).select("query", "id", "title", "company")


@query(
    "source_failures",
    f"""WITH f AS ({_SEARCH_FILES.format(orders='orders')})
    SELECT query, 'not JSON' AS failure, count(*) AS failed FROM f WHERE NOT json_valid(value) GROUP BY 1""",
)
def _(spark, folder):
    failed = failed_records(load_searches(spark, _search_folder(spark, folder)))
    return failed.groupBy("query", "failure").agg(F.count(F.lit(1)).alias("failed"))


@query(
    "json_report",
    f"""{S.WITH_PAY} SELECT concat('{{"id":"', id, '","share":',
      CASE WHEN salary_midpoint IS NULL OR CAST(id AS BIGINT) % 3 = 0 THEN 'null' ELSE '0.5' END,
      ',"points":[{{"v":', CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN 'null' ELSE '1.5' END, '}}]}}') AS payload FROM paid""",
)
def _(spark, folder):
    ratio = F.when(F.col("id").cast("bigint") % 3 == 0, F.lit(float("nan")))
    rows = priced(spark, folder).select(
        "id",
        ratio.when(F.col("salary_midpoint").isNotNull(), 0.5).alias("share"),
        F.array(F.struct(F.when(F.col("id").cast("bigint") % 3 == 0, F.lit(float("inf"))).otherwise(1.5).alias("v"))).alias(
            "points"
        ),
    )
    return as_json(rows)


# --- refresh and streams ------------------------------------------------------------


@query(
    "refresh_added_total",
    f"""{_SEEN} SELECT (SELECT count(*) FROM fresh) AS added,
    (SELECT count(*) FROM raw) + (SELECT count(*) FROM fresh) AS total""",
)
def _(spark, folder):
    store = scratch_path(spark, "store")
    refresh.refresh(raw_postings(spark, folder), store)
    new = seen_again(spark, folder).unionByName(fresh_postings(spark, folder))
    return refresh.refresh(new, store)


@query(
    "refresh_current",
    f"""{_SEEN}, sightings AS (SELECT *, 0 AS source_rank FROM raw UNION ALL SELECT *, 1 FROM again), {_FIRST},
    raw_first AS (SELECT id, company, title, collected_at FROM ranked WHERE place = 1)
    SELECT id, company, {S.clean_title('title')} AS title_clean, collected_at FROM raw_first""",
)
def _(spark, folder):
    store = scratch_path(spark, "store")
    refresh.refresh(raw_postings(spark, folder), store)
    refresh.refresh(seen_again(spark, folder), store)
    refresh.compact(spark, store)
    return refresh.current(spark, store).select("id", "company", "title_clean", "collected_at")


@query(
    "refresh_then_stream",
    f"""{_SEEN} SELECT id, company, collected_at FROM raw
    UNION ALL SELECT id, company, collected_at FROM fresh""",
)
def _(spark, folder):
    """A refresh and a stream with a checkpoint of its own, on one store."""
    store = scratch_path(spark, "store")
    refresh.refresh(fresh_postings(spark, folder), store)
    ingest(streamed_postings(spark, folder), store, scratch_path(spark, "stream-log")).awaitTermination()
    return refresh.current(spark, store).select("id", "company", "collected_at")


@query(
    "two_writers",
    f"""{_SEEN} SELECT id, collected_at FROM raw UNION ALL SELECT id, collected_at FROM fresh""",
)
def _(spark, folder):
    """Two refreshes at the same time, then a compaction: no row is lost."""
    from concurrent.futures import ThreadPoolExecutor

    store = scratch_path(spark, "store")
    rows = [process_postings(x) for x in (raw_postings(spark, folder), fresh_postings(spark, folder))]
    with ThreadPoolExecutor(2) as threads:
        list(threads.map(lambda r: refresh.write_batch(r, store), rows))
    refresh.compact(spark, store)
    return refresh.current(spark, store).select("id", "collected_at")


@query(
    "report_over_store",
    f"""{_SEEN}, sightings AS (SELECT *, 0 AS source_rank FROM raw UNION ALL SELECT *, 1 FROM again), {_FIRST}
    SELECT location AS label, count(*) AS count FROM ranked WHERE place = 1 GROUP BY 1""",
)
def _(spark, folder):
    store = scratch_path(spark, "store")
    refresh.refresh(raw_postings(spark, folder), store)
    refresh.refresh(seen_again(spark, folder), store)
    return value_counts(refresh.current(spark, store), "location")


def streamed_postings(spark: SparkSession, folder: str) -> DataFrame:
    """The postings with their orders read as a stream of files."""
    orders = (
        use_utc(spark)
        .readStream.schema(SCHEMAS["orders"])
        .option("pathGlobFilter", "orders.parquet")
        .parquet(folder)
    )
    fixed = {name: table(spark, folder, name) for name in ("customer", "nation", "region")}
    return spark.sql(RAW_SQL, orders=orders, **fixed)


@query(
    "stream_ingest",
    f"""{S.WITH_SKILLS} SELECT id, company, title_clean, role_category, array_to_string(skills, '|') AS skills,
    salary_midpoint FROM posts""",
)
def _(spark, folder):
    store = scratch_path(spark, "stream-store")
    ingest(streamed_postings(spark, folder), store, scratch_path(spark, "stream-log")).awaitTermination()
    return refresh.current(spark, store).select(
        "id", "company", "title_clean", "role_category", joined(), "salary_midpoint"
    )


@query(
    "stream_searches",
    f"""WITH f AS ({_SEARCH_FILES.format(orders='orders')})
    SELECT query, value::JSON->>'$.id' AS id, trim(value::JSON->>'$.title') AS title FROM f WHERE json_valid(value)""",
)
def _(spark, folder):
    """Pages arrive in three deliveries; the store takes them from the source's stream."""
    path, log, store = (scratch_path(spark, name) for name in ("pages", "pages-log", "pages-store"))
    files = spark.sql(_SEARCH_FILES, orders=table(spark, folder, "orders"))
    for number in range(3):
        delivery = files.filter(F.pmod(F.xxhash64("value"), F.lit(3)) == number)
        delivery.write.mode("append").partitionBy("query").text(path)
        ingest(found_postings(load_searches(spark, path, streaming=True)), store, log).awaitTermination()
    return refresh.current(spark, store).select("query", "id", "title")


def _deliver(spark: SparkSession, rows: DataFrame, by, run) -> None:
    """Three deliveries, the latest first; ``run`` takes the stream on after each."""
    path = scratch_path(spark, "deliveries")
    for number in (2, 0, 1):
        rows.filter(by == number).write.mode("append").parquet(path)
        run(spark.readStream.schema(rows.schema).parquet(path)).awaitTermination()


@query("stream_skill_counts", f"{S.WITH_SKILLS}, {_trend_sql('week')} SELECT * FROM trend")
def _(spark, folder):
    """Every posting twice: a later sighting is counted first and gives way to the first one."""
    store = scratch_path(spark, "stream-counts")
    rows = processed(spark, folder).select("id", "collected_at", "skills")
    later = F.date_format(timestamp_column(rows, "collected_at") + F.expr("INTERVAL 20 DAYS"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    both = rows.withColumn("again", F.lit(False)).unionByName(
        rows.withColumn("collected_at", later).withColumn("again", F.lit(True))
    )
    turn = F.when(F.col("again"), 2).otherwise(F.pmod(F.xxhash64("id"), F.lit(2)))
    log = scratch_path(spark, "stream-log")
    _deliver(spark, both, turn, lambda stream: keep_counts(stream.drop("again"), weekly_mentions, store, log))
    return latest_counts(spark, store, ["period", "skill"]).withColumnRenamed("count", "mentions")


@query(
    "stream_weekly_events",
    """SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS period, count(*) AS count FROM events GROUP BY 1""",
)
def _(spark, folder):
    """A third of the events without an id; weeks are spread over three deliveries."""
    rows = table(spark, folder, "events").select(
        F.when(F.col("event_id") % 3 > 0, F.col("event_id").cast("string")).alias("id"),
        F.col("ts").cast("timestamp").alias("collected_at"),
        F.pmod(F.dayofyear("ts"), F.lit(3)).alias("turn"),
    )
    store = scratch_path(spark, "stream-counts")
    log, counting = scratch_path(spark, "stream-log"), partial(weekly_postings, date="collected_at")
    _deliver(spark, rows, F.col("turn"), lambda stream: keep_counts(stream.drop("turn"), counting, store, log))
    return latest_counts(spark, store, ["period"])


@query(
    "stream_first_seen",
    """WITH e AS (SELECT CASE WHEN event_id % 5 > 0 THEN CAST(user_id AS VARCHAR) END AS id, event_id, event_type, ts FROM events)
    SELECT id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen FROM e
    QUALIFY id IS NULL OR row_number() OVER (PARTITION BY id ORDER BY ts, event_id) = 1""",
)
def _(spark, folder):
    """The first event of each user, and all without a user, from three deliveries out of order."""
    rows = table(spark, folder, "events").select(
        F.when(F.col("event_id") % 5 > 0, F.col("user_id").cast("string")).alias("id"),
        F.col("ts").cast("timestamp").alias("collected_at"),
        "event_id",
        "event_type",
    )
    store, log = scratch_path(spark, "stream-first"), scratch_path(spark, "stream-log")
    _deliver(
        spark,
        rows,
        F.pmod("event_id", F.lit(3)),
        lambda stream: keep_first_sightings(stream, store, log, tie=F.col("event_id")),
    )
    return first_sightings(spark, store, rows.schema).select(
        "id", "event_id", "event_type", F.date_format("collected_at", "yyyy-MM-dd HH:mm:ss").alias("seen")
    )


@query(
    "two_compactions",
    f"""{_SEEN} SELECT CASE WHEN o.nr % 3 > 0 THEN id END AS id, company FROM (SELECT *, CAST(id AS BIGINT) AS nr FROM raw) o
    UNION ALL SELECT NULL, company FROM again WHERE CAST(id AS BIGINT) % 3 = 0""",
)
def _(spark, folder):
    """Two compactions at a time of a store with rows without id: none is lost, none doubled."""
    from concurrent.futures import ThreadPoolExecutor

    store = scratch_path(spark, "store")

    def some(rows: DataFrame, later: bool) -> DataFrame:
        number = F.col("id").cast("bigint")
        moved = F.lit("2999-01-01T08:00:00Z") if later else F.col("collected_at")
        return rows.select(F.when(number % 3 > 0, F.col("id")).alias("id"), "company", moved.alias("collected_at"))

    first, again = some(raw_postings(spark, folder), False), some(seen_again(spark, folder), True)
    for rows in (first, again):
        refresh.write_batch(rows, store)
    with ThreadPoolExecutor(2) as threads:
        list(threads.map(lambda _: refresh.compact(spark, store, first.schema), range(2)))
    return refresh.current(spark, store, first.schema).select("id", "company")


# --- model ---------------------------------------------------------------------------------


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """Processed postings from a file: training reads them many times."""
    path = scratch_path(spark, "processed")
    processed(spark, folder).write.parquet(path)
    return spark.read.schema(refresh.processed_schema(spark)).parquet(path)


_LINEAR = {name: training.CANDIDATES[name] for name in ("linear_regression", "ridge")}


def _bucket(seed: int, parts: int) -> str:
    return f"('0x' || substr(md5(concat_ws('|', id, '', '{seed}')), 1, 8))::BIGINT % {parts}"


@query(
    "fold_sizes",
    f"""{S.WITH_PAY} SELECT {_bucket(42, 100)} < 20 AS holdout, {_bucket(43, 5)} AS fold, count(*) AS rows
    FROM paid WHERE pay IS NOT NULL GROUP BY 1, 2""",
)
def _(spark, folder):
    rows = feature_table(priced(spark, folder), ("id",))
    holdout, fold = is_holdout(["id"], spare=training.SPARE), fold_of(["id"], 5, spare=training.SPARE)
    return rows.groupBy(holdout.alias("holdout"), fold.alias("fold")).agg(F.count(F.lit(1)).alias("rows"))


def _one_feature(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with the description's length as the only feature."""
    rows = feature_table(_stored(spark, folder), ("id",)).withColumn(
        "features", array_to_vector(F.array(F.col("description_length") / 100))
    )
    path = scratch_path(spark, "one-feature")
    rows.withColumn("holdout", is_holdout(["id"], spare=training.SPARE)).write.parquet(path)
    back = spark.read.parquet(path)
    return back.filter("NOT holdout"), back.filter("holdout")


_FIT = f"""{S.WITH_SKILLS}, rows AS (SELECT id, len(description_clean) / 100 AS x, ln(pay) AS y, {_bucket(42, 100)} < 20 AS holdout
      FROM posts WHERE pay IS NOT NULL),
  fit AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM rows WHERE NOT holdout)"""
_RIDGE = f"""{_FIT}, sums AS (SELECT regr_sxy(y, x) / (regr_sxx(y, x) + 1) AS slope, avg(x) AS mx, avg(y) AS my FROM rows WHERE NOT holdout)"""


@query(
    "linear_fit",
    f"""{_RIDGE} SELECT 'linear_regression' AS model, round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM fit
    UNION ALL SELECT 'ridge', round(slope, 6), round(my - slope * mx, 6) FROM sums""",
)
def _(spark, folder):
    """Coefficients of both linear candidates on one feature."""
    known, _ = _one_feature(spark, folder)
    fits = [(name, _LINEAR[name](known).fit(known)) for name in _LINEAR]
    rows = [(name, float(f.coefficients[0]), float(f.intercept)) for name, f in fits]
    made = spark.createDataFrame(rows, "model string, slope double, intercept double")
    return made.select("model", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query(
    "linear_scores",
    f"""{_FIT} SELECT id, round(y, 6) AS actual, round(intercept + slope * x, 6) AS predicted FROM rows, fit WHERE holdout""",
)
def _(spark, folder):
    """Held-out rows scored by the fitted line."""
    known, held = _one_feature(spark, folder)
    model = training.linear_regression(known).fit(known)
    scored = model.transform(held)
    return scored.select("id", F.round("log_salary", 6).alias("actual"), F.round("prediction", 6).alias("predicted"))


@query(
    "linear_metrics",
    f"""{_FIT}, scored AS (SELECT y, intercept + slope * x AS p FROM rows, fit WHERE holdout)
    SELECT {S.half_even('avg(abs(exp(y) - exp(p)))', 2)} AS mae_gbp, {S.half_even('sqrt(avg((exp(y) - exp(p)) ^ 2))', 2)} AS rmse_gbp,
      {S.half_even('1 - sum((y - p) ^ 2) / sum((y - m) ^ 2)', 6)} AS r2, {S.half_even('avg(abs(y - p))', 6)} AS mae_log
    FROM scored, (SELECT avg(y) AS m FROM rows WHERE holdout)""",
)
def _(spark, folder):
    known, held = _one_feature(spark, folder)
    found = regression_metrics(training.linear_regression(known).fit(known).transform(held))
    return found.select(
        F.bround("mae_gbp", 2).alias("mae_gbp"),
        F.bround("rmse_gbp", 2).alias("rmse_gbp"),
        F.bround("r2", 6).alias("r2"),
        F.bround("mae_log", 6).alias("mae_log"),
    )


@query("salary_model_comparison")
def _(spark, folder):
    """Cross-validated comparison of the linear candidates over all salaried rows."""
    comparison = training.train(_stored(spark, folder), _LINEAR).comparison
    return comparison.select("model", *[F.round(n, 3).alias(n) for n in comparison.columns[1:]])


@query("salary_model_scores")
def _(spark, folder):
    """Every posting taken as a request and priced by the model that a comparison chose and stored."""
    rows = _stored(spark, folder)
    path = scratch_path(spark, "model")
    training.save(training.train(rows, _LINEAR), path)
    # Missing labels are named, as a request has to name them.
    requests = fill_features(rows).select(
        "id", "role_category", "seniority", "region", "contract_type", "contract_time", "skills",
        F.col("description_length").cast("bigint").alias("description_length"),
    )
    sound, _rejected = scoring.split_requests(requests)
    scored = scoring.score(sound, training.load(spark, path))
    return scored.select("id", "predicted_salary", "lower_bound", "upper_bound", "n_training_rows")


@query(
    "score_requests_checked",
    f"""{S.WITH_PAY} SELECT id, concat_ws('; ',
      CASE WHEN region IS NULL THEN 'region must have 1 to 120 characters' END,
      CASE WHEN contract_type IS NULL THEN 'contract_type must have 1 to 60 characters' END) AS problems FROM paid""",
)
def _(spark, folder):
    rows = processed(spark, folder)
    checked = scoring.request_problems(rows.drop("description_length", "skills"))
    return checked.select("id", F.array_join("problems", "; ").alias("problems"))


@query(
    "request_skill_counts",
    f"""{S.WITH_SKILLS} SELECT id, {S.COUNTS.replace('list_filter(skills', 'list_filter(list_concat(skills, skills)')},
    CAST(2 * len(skills) AS BIGINT) AS n_skills_total FROM posts""",
)
def _(spark, folder):
    doubled = processed(spark, folder).select("id", F.concat("skills", "skills", F.array("company")).alias("skills"))
    return scoring.request_features(doubled).select("id", *longs(*count_columns(), "n_skills_total"))


@query("predicted_versus_actual")
def _(spark, folder):
    """Pairs in pounds of the held-out rows, by the chosen model."""
    from vacanta.operators.metrics import actual_and_predicted

    done = training.train(_stored(spark, folder), _LINEAR)
    pairs = actual_and_predicted(done.holdout_predictions)
    return pairs.select(*[F.round(n, 0).alias(n) for n in pairs.columns])


# --- model choice ----------------------------------------------------------------------

_ONE_OF_EACH = model_choice.Features(labels=("role_category",), numbers=("description_length",))
_TREES = {"rounds": 3, "depth": 2, "rate": 0.3}


def _parted(spark: SparkSession, folder: str, features: model_choice.Features) -> tuple[DataFrame, int]:
    return model_choice.parted(feature_table(_stored(spark, folder), ("id",)), features, spare=training.SPARE)


def _predicted(spark: SparkSession, folder: str) -> DataFrame:
    """The written long table of both linear candidates and boosted trees, over all folds."""
    rows, folds = _parted(spark, folder, _ONE_OF_EACH)
    candidates = (
        model_choice.linear_candidates({"linear_regression": 0.0, "ridge": 1.0}),
        model_choice.boosted_candidate(**_TREES),
    )
    long, _ = model_choice.predicted(rows, folds, _ONE_OF_EACH, candidates)
    path = scratch_path(spark, "model-predictions")
    long.write.parquet(path)
    return spark.read.parquet(path)


_BOTH = f"""{model_sql.boosted(['role_category'], ['description_length'], 3, 2, 0.3, before=model_sql.LINEAR)},
predictions AS (SELECT * FROM linear UNION ALL SELECT * FROM boosted), {model_sql.scores('predictions')},
compared AS (
  SELECT model, avg(r2) FILTER (k >= 0) AS cv_r2_mean, stddev_pop(r2) FILTER (k >= 0) AS cv_r2_std, any_value(r2) FILTER (k = -1) AS r2
  FROM fits GROUP BY 1),
held AS (
  SELECT model, avg(abs(exp(p) - exp(y))) AS mae_gbp, sqrt(avg((exp(p) - exp(y)) ^ 2)) AS rmse_gbp, avg(abs(p - y)) AS mae_log
  FROM predictions WHERE k = -1 GROUP BY 1),
best AS (SELECT model FROM compared ORDER BY r2 DESC, model LIMIT 1)"""
_COMPARED = f"""SELECT model, {S.half_even('cv_r2_mean', 5)} AS cv_r2_mean, {S.half_even('cv_r2_std', 5)} AS cv_r2_std,
  {S.half_even('mae_gbp', 1)} AS mae_gbp, {S.half_even('rmse_gbp', 1)} AS rmse_gbp, {S.half_even('r2', 5)} AS r2, {S.half_even('mae_log', 5)} AS mae_log
  FROM compared JOIN held USING (model)"""


def _rounded(compared: DataFrame) -> DataFrame:
    digits = {"mae_gbp": 1, "rmse_gbp": 1}
    return compared.select("model", *(F.bround(c, digits.get(c, 5)).alias(c) for c in compared.columns if c != "model"))


@query(
    "cv_linear",
    f"""{model_sql.LINEAR}, {model_sql.scores('linear')}
    SELECT model, CAST(k AS INT) AS fold, {S.half_even('r2', 6)} AS r2 FROM fits WHERE k >= 0""",
)
def _(spark, folder):
    """Scores of all folds of both linear candidates from one table of sums."""
    rows, folds = _parted(spark, folder, _ONE_OF_EACH)
    f = _ONE_OF_EACH
    sums = Sums.of(rows, F.col("part"), f.labels, f.numbers, f.target)
    scores = [
        (name, fold, sums.r2(sums.fit([p for p in range(folds) if p != fold], alpha), [fold]))
        for name, alpha in (("linear_regression", 0.0), ("ridge", 1.0))
        for fold in range(folds)
    ]
    return spark.createDataFrame(scores, "model string, fold int, r2 double").withColumn("r2", F.bround("r2", 6))


@query(
    "boosted_fit",
    f"""{model_sql.boosted(['role_category'], ['description_length', 'n_skills_total'], 2, 2, 0.05)}
    SELECT id, {S.half_even('p', 7)} AS predicted FROM boosted WHERE k = -1""",
)
def _(spark, folder):
    """Held-out rows priced by two trees of two levels."""
    features = model_choice.Features(labels=("role_category",), numbers=("description_length", "n_skills_total"))
    rows, _ = _parted(spark, folder, features)
    model = boosted_trees.fit(
        rows.filter(F.col("part") >= 0), features.labels, features.numbers, features.target, "id", rounds=2, depth=2
    )
    held = rows.filter(F.col("part") == model_choice.HELD_OUT)
    return held.select("id", F.bround(model.prediction(), 7).alias("predicted"))


@query("model_comparison", f"{_BOTH} {_COMPARED}")
def _(spark, folder):
    """Fold scores and held-out metrics of three candidates, from the long table."""
    return _rounded(model_choice.comparison(_predicted(spark, folder)))


@query("best_model", f"{_BOTH} {_COMPARED} JOIN best USING (model)")
def _(spark, folder):
    return _rounded(model_choice.best_model(model_choice.comparison(_predicted(spark, folder))))


@query(
    "best_model_pairs",
    f"""{_BOTH} SELECT id AS key, {S.half_even('exp(y)', 1)} AS actual, {S.half_even('exp(p)', 1)} AS predicted
    FROM predictions JOIN best USING (model) WHERE k = -1""",
)
def _(spark, folder):
    """Actual and predicted pounds of the held-out rows, by the chosen model."""
    long = _predicted(spark, folder)
    pairs = model_choice.held_out_pairs(long, model_choice.best_model(model_choice.comparison(long)))
    return pairs.select("key", F.bround("actual", 1).alias("actual"), F.bround("predicted", 1).alias("predicted"))


@query(
    "best_model_prices",
    f"""{_BOTH} SELECT id, {S.pounds('exp(p)')} AS predicted_salary, {S.pounds('exp(p - 0.35)')} AS lower_bound,
      {S.pounds('exp(p + 0.35)')} AS upper_bound FROM predictions JOIN best USING (model) WHERE k = -1""",
)
def _(spark, folder):
    """Held-out postings as requests, priced by the chosen model, with intervals."""
    long = _predicted(spark, folder)
    best = model_choice.best_model(model_choice.comparison(long)).select("model")
    chosen = long.filter("fold IS NULL").join(F.broadcast(best), "model", "left_semi")
    return model_choice.priced(chosen, F.col("predicted"), INTERVAL_LOG_SPREAD).select(
        F.col("key").alias("id"), *longs("predicted_salary", "lower_bound", "upper_bound")
    )
