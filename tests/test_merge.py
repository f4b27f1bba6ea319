import json
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from tests.conftest import raw_row
from pyspark.sql import functions as F

from vacanta.operators.counts import (
    dataset_summary,
    health,
    processing_summary,
    value_counts,
)
from vacanta.operators.dedupe import first_seen, merge_counts, merge_postings, new_ids
from vacanta.operators.processing import process_postings
from vacanta.plans import refresh as store_jobs
from vacanta.session import scratch_path
from vacanta.sources import commits
from vacanta.sources.readers import (
    parse_adverts,
    read_processed_csv,
    read_raw_csv,
    read_searches,
    rejected_records,
    with_timestamps,
)
from vacanta.sources.schema import require_columns
from vacanta.sources.writers import as_json, write_csv
from vacanta.streaming.first_sightings import BUCKETS, first_sightings, keep_first_sightings
from vacanta.streaming.ingest import ingest
from vacanta.streaming.live_counts import keep_counts, latest_counts, weekly_mentions


def test_earliest_sighting_wins(spark):
    df = spark.createDataFrame(
        [("a", "2025-02-11T18:00:00Z"), ("a", "2025-02-10T21:30:00Z"), ("a", None), ("b", "bad")],
        "id string, collected_at string",
    )
    assert sorted((r.id, r.collected_at) for r in first_seen(df).collect()) == [
        ("a", "2025-02-10T21:30:00Z"), ("b", "bad"),
    ]


def test_offsets_compare_as_times(spark):
    df = spark.createDataFrame(
        [("a", "2026-08-01T09:00:00+09:00"), ("a", "2026-08-01T01:00:00Z")], "id string, collected_at string"
    )
    assert first_seen(df).first().collected_at.endswith("+09:00")


def test_number_and_text_ids_are_the_same(spark):
    old = spark.createDataFrame([(7310000042, "2025-06-09T05:00:00Z")], "id bigint, collected_at string")
    new = spark.createDataFrame([("7310000042", "2025-06-09T11:00:00Z")], "id string, collected_at string")
    old = old.withColumn("id", F.col("id").cast("string"))
    assert merge_postings(old, new).collect()[0].collected_at == "2025-06-09T05:00:00Z"
    assert tuple(merge_counts(old, new).first()) == (0, 1)
    assert first_seen(spark.createDataFrame([(1,), (1,)], "id bigint")).count() == 1


def test_without_ids(spark):
    assert first_seen(spark.createDataFrame([("x",), ("x",)], "title string")).count() == 2
    df = spark.createDataFrame([(None, "t"), (None, "t"), ("1", "t")], "id string, collected_at string")
    assert first_seen(df).count() == 3
    assert tuple(merge_counts(df, df).first()) == (2, 5)
    assert merge_postings(df, df).count() == 5


def test_stored_row_wins_a_tie(spark):
    a = spark.createDataFrame([("1", "2026-01-01", "old")], "id string, collected_at string, v string")
    b = spark.createDataFrame([("1", "2026-01-01", "new"), ("2", "2026-01-01", "new")], a.schema)
    assert sorted((r.id, r.v) for r in merge_postings(a, b).collect()) == [("1", "old"), ("2", "new")]
    assert [r.id for r in new_ids(a, b).collect()] == ["2"]


def test_hot_id_moves_one_row_per_partition(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.timestamp_seconds(F.col("id")).alias("collected_at"),
    )
    kept = first_seen(df)
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 20001
    assert kept.filter("id = 'hot'").first().collected_at.timestamp() == 0


@pytest.fixture()
def store(spark, raw):
    path = scratch_path(spark, "test-store")
    first = store_jobs.refresh(raw(raw_row("kept")), path)
    assert tuple(first.first()) == (1, 1)
    return path


def test_refresh(spark, raw, store):
    assert tuple(store_jobs.refresh(raw(raw_row("added")), store).first()) == (1, 2)
    again = raw_row("kept", collected_at="2025-11-20T12:00:00Z")
    assert tuple(store_jobs.refresh(raw(again), store).first()) == (0, 2)
    assert tuple(store_jobs.refresh(raw(), store).first()) == (0, 2)
    rows = {r.id: r for r in store_jobs.current(spark, store).collect()}
    assert rows["kept"].collected_at.startswith("2025-03-05")
    new = rows["added"]
    assert (new.role_category, new.salary_midpoint, new.skills) == ("BI Developer / Analyst", 45000, ["Kafka", "Snowflake", "Tableau"])
    store_jobs.compact(spark, store)
    assert len(commits.committed(spark, store)) == 1
    assert {r.id: r for r in store_jobs.current(spark, store).collect()} == rows
    assert tuple(store_jobs.refresh(raw(raw_row("later")), store).first()) == (1, 3)


def test_an_earlier_sighting_replaces_a_later_one(spark, raw, store):
    early = raw_row("kept", collected_at="2025-01-07T10:00:00Z", company="First")
    assert tuple(store_jobs.refresh(raw(early), store).first()) == (0, 1)
    assert store_jobs.current(spark, store).first().company == "First"


def test_batch_written_twice_counts_once(spark, raw, store):
    rows = process_postings(raw(raw_row("x"), raw_row("y")))
    for _ in range(2):
        store_jobs.write_batch(rows, store, "w-7")
    assert tuple(store_jobs.batch_counts(spark, store, "w-7").first()) == (2, 3)
    assert store_jobs.sightings(spark, store).count() == 3


def test_a_dead_try_is_not_read_and_is_replaced(spark, raw, store):
    rows = process_postings(raw(raw_row("x")))
    rows.write.parquet(f"{store}/rows/w-1")  # no commit followed
    assert store_jobs.current(spark, store).count() == 1
    store_jobs.write_batch(process_postings(raw(raw_row("y"))), store, "w-1")
    assert {r.id for r in store_jobs.current(spark, store).collect()} == {"kept", "y"}


def test_writers_do_not_overwrite_each_other(spark, raw, store):
    with ThreadPoolExecutor(4) as threads:
        batches = [process_postings(raw(raw_row(f"w{n}"))) for n in range(4)]
        list(threads.map(lambda rows: store_jobs.write_batch(rows, store), batches))
    assert store_jobs.current(spark, store).count() == 5


def test_batch_committed_during_a_compaction_stays(spark, raw, store):
    store_jobs.refresh(raw(raw_row("a")), store)
    listed = commits.committed(spark, store)
    store_jobs.refresh(raw(raw_row("b")), store)
    old = store_jobs.sightings(spark, store, batches=listed).drop(commits.ORDER, commits.BATCH)
    commits.commit(old, store, "c", order=listed[0].order, replaces=tuple(b.name for b in listed))
    assert {r.id for r in store_jobs.current(spark, store).collect()} == {"kept", "a", "b"}


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_a_batch_is_written_without_a_shuffle_and_holds_an_id_once(spark, raw, store, monkeypatch):
    seen, commit = [], commits.commit
    monkeypatch.setattr(commits, "commit", lambda rows, *a, **k: (seen.append(plan_of(rows)), commit(rows, *a, **k)))
    twice = [
        raw_row("x", collected_at="2025-03-07T10:00:00Z"),
        raw_row("x", company="First", collected_at="2025-03-06T10:00:00Z"),
        *(raw_row("tied", company=c) for c in "abc"),
        raw_row("once"),
        raw_row(None),
        raw_row(None),
    ]
    rows = process_postings(raw(*twice))
    wanted = sorted(map(str, first_seen(rows).collect()))
    for most in (store_jobs.BROADCAST_IDS, 1):
        monkeypatch.setattr(store_jobs, "BROADCAST_IDS", most)
        name = store_jobs.write_batch(rows, store)
        got = store_jobs.sightings(spark, store).filter(F.col(commits.BATCH) == name)
        assert sorted(map(str, got.select(rows.columns).collect())) == wanted and len(wanted) == 5
    assert len(seen) == 2 and not any("Exchange" in plan for plan in seen)


def test_report_over_the_store_reads_few_columns_once(spark, raw, store):
    store_jobs.refresh(raw(raw_row("a"), raw_row(None)), store)
    plan = value_counts(store_jobs.current(spark, store), "company")
    text = plan._jdf.queryExecution().executedPlan().toString()
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert {x.split(":")[0] for x in schema.split(",")} == {"id", "company", "collected_at", commits.ORDER, commits.BATCH}


def test_empty_store(spark):
    path = scratch_path(spark, "nothing")
    assert store_jobs.current(spark, path).count() == 0
    assert commits.committed(spark, path) == []


def live(spark, rows, folder, number):
    """One delivery; ids, times and skills."""
    kind = "id string, collected_at string, skills array<string>"
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(kind).parquet(f"{folder}/in")
    keep_counts(stream, weekly_mentions, f"{folder}/store", f"{folder}/log{number}").awaitTermination()
    return {(r.period, r.skill): r["count"] for r in latest_counts(spark, f"{folder}/store", ["period", "skill"]).collect()}


def test_live_counts_are_exact(spark, tmp_path):
    """Late rows, rows without id, an earlier sighting that comes last, and a new checkpoint."""
    folder = str(tmp_path)
    first = [("1", "2026-08-12T00:00:00Z", ["SQL"]), (None, "2026-08-12T00:00:00Z", ["SQL"]), (None, "2026-08-12T00:00:00Z", ["SQL"]), ("2", "no date", ["SQL"])]
    assert live(spark, first, folder, 0) == {("2026-08-10", "SQL"): 3}
    late = [("3", "2025-01-01T00:00:00Z", ["SQL", "AWS"]), ("1", "2026-08-05T00:00:00Z", ["SQL"])]
    want = {("2026-08-10", "SQL"): 2, ("2026-08-03", "SQL"): 1, ("2024-12-30", "SQL"): 1, ("2024-12-30", "AWS"): 1}
    assert live(spark, late, folder, 0) == want
    assert live(spark, [("1", "2026-08-20T00:00:00Z", ["SQL"])], folder, 0) == want
    # A lost checkpoint delivers all files again: known ids change nothing.
    again = live(spark, [("4", "2026-08-20T00:00:00Z", ["AWS"])], folder, 1)
    assert again[("2026-08-17", "AWS")] == 1 and again[("2026-08-03", "SQL")] == 1


def test_restart_keeps_the_state_and_reads_nothing_stored(spark, tmp_path):
    """A stopped stream goes on where it was; a micro-batch opens its own rows only."""
    folder = str(tmp_path)
    kind = "id string, collected_at string, n int, tags array<string>, at timestamp"
    turns = [
        [("a", "2026-05-02", 1, ["x"]), ("b", "2026-05-02", 2, None), (None, "2026-05-02", 3, []), (None, "2026-05-02", 3, [])],
        [("a", "2026-05-01", 4, ["y", "z"]), ("b", "2026-05-03", 5, None), ("c", "no date", 6, None)],
        [("c", "2026-05-09", 7, None), ("a", None, 8, None), (None, None, 9, None)],
    ]
    import datetime

    at = datetime.datetime(2026, 1, 2, 3, 4, 5, 678901)
    read = []
    for rows in turns:
        spark.createDataFrame([(*r, at) for r in rows], kind).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(kind).parquet(f"{folder}/in")
        query = keep_first_sightings(stream, f"{folder}/store", f"{folder}/log", tie=F.col("n"))
        query.awaitTermination()
        read += [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(read) == sum(map(len, turns))
    schema = spark.createDataFrame([], kind).schema
    got = first_sightings(spark, f"{folder}/store", schema).collect()
    assert sorted((r.id or "", r.n) for r in got) == [("", 3), ("", 3), ("", 9), ("a", 4), ("b", 2), ("c", 7)]
    assert {r.at for r in got} == {at} and [r.tags for r in got if r.id == "a"] == [["y", "z"]]
    # A new checkpoint begins with what is stored: files delivered again change no id.
    keep_first_sightings(stream, f"{folder}/store", f"{folder}/other", tie=F.col("n")).awaitTermination()
    again = first_sightings(spark, f"{folder}/store", schema).filter("id is not null").collect()
    assert sorted((r.id, r.n) for r in again) == [("a", 4), ("b", 2), ("c", 7)]


def test_hot_id_moves_one_row_per_batch(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("id"),
        F.timestamp_seconds(F.col("id")).alias("collected_at"),
    )
    rows.write.parquet(f"{folder}/in")
    query = keep_first_sightings(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"), f"{folder}/store", f"{folder}/log")
    query.awaitTermination()
    got = {r.id: r.collected_at.timestamp() for r in first_sightings(spark, f"{folder}/store", rows.schema).collect()}
    assert got["hot"] == 0 and len(got) == 51
    plan = query._jsq.explainInternal(False)
    assert plan.index("TransformWithState") < plan.index("Exchange hashpartitioning") < plan.index("MapInPandas")


def overlapping(spark, raw, store):
    """Two compactions that listed the store before either of them committed."""
    for n in range(3):
        store_jobs.refresh(raw(raw_row(None, company=f"c{n}")), store)
    plans = [commits.committed(spark, store)[:3], commits.committed(spark, store)[1:]]
    for n, batches in enumerate(plans):
        rows = store_jobs.sightings(spark, store, batches=batches)
        commits.commit(rows, store, f"compact-{n}", replaces=tuple(b.name for b in batches))


def test_overlapping_compactions_count_rows_once(spark, raw, store):
    overlapping(spark, raw, store)
    assert [b.name for b in commits.committed(spark, store)][-1] == "compact-0"
    assert sorted(r.company for r in store_jobs.current(spark, store).filter("id is null").collect()) == ["c0", "c1", "c2"]
    assert commits.vacuum(spark, store) == []  # too fresh
    gone = commits.vacuum(spark, store, hours=0)
    assert "compact-1" in gone and len(gone) == 4
    assert store_jobs.current(spark, store).count() == 4
    assert store_jobs.compact(spark, store) and len(commits.committed(spark, store)) == 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_compacted_store_is_read_without_a_shuffle(spark, raw, store):
    for n in range(3):
        store_jobs.refresh(raw(*(raw_row(f"{n}-{i}") for i in range(12)), raw_row(None)), store)
    assert store_jobs.compact(spark, store)
    plan = plan_of(store_jobs.current(spark, store).filter("region = 'Yorkshire'").select("id", "company"))
    assert "Exchange" not in plan and "Window" not in plan
    # Beside it, only rows of the ids that came since are shuffled.
    early = raw_row("1-3", collected_at="2025-01-01T00:00:00Z", company="Earlier")
    store_jobs.refresh(raw(early, raw_row("new"), raw_row(None)), store)
    rows = store_jobs.current(spark, store)
    plan = plan_of(rows.select("id", "company"))
    assert "LeftAnti, BuildRight" in plan and "LeftSemi, BuildRight" in plan
    got = rows.collect()
    assert len(got) == 42 and {r.company for r in got if r.id == "1-3"} == {"Earlier"}
    assert sum(r.id is None for r in got) == 4


def test_streams_compact_a_store_of_many_batches(spark, tmp_path):
    inbox, store, log = (str(tmp_path / n) for n in ("in", "store", "log"))
    for n in range(4):
        folder = tmp_path / "in" / "query=a"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{n}.json").write_text(json.dumps({"id": str(n % 3), "title": "Data Analyst", "description": "SQL"}))
        ingest(read_searches(spark, inbox, streaming=True), store, log, most_batches=2).awaitTermination()
    assert len(commits.committed(spark, store)) <= 2
    assert store_jobs.current(spark, store).count() == 3


def test_stream_equals_batch(spark, raw, tmp_path):
    """Files delivered over three runs, one posting seen twice: same rows as one batch."""
    inbox, store, log = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "log")
    batches = [
        [("1", "Data Analyst", "data analyst"), ("2", "Head of Data", "data analyst")],
        [("2", "Head of Data", "bi"), ("3", "BI Lead", "bi")],
        [],
    ]
    for number, adverts in enumerate(batches):
        for i, (job, title, words) in enumerate(adverts):
            folder = inbox / f"query={words}"
            folder.mkdir(parents=True, exist_ok=True)
            text = json.dumps({"id": job, "title": title, "salary_min": 30000, "description": "Python"})
            (folder / f"{number}-{i}.json").write_text(text + "\nnot json\n")
        ingest(read_searches(spark, str(inbox), streaming=True), store, log).awaitTermination()
    rows = {r.id: r for r in store_jobs.current(spark, store).collect()}
    whole = {r.id: r for r in first_seen(process_postings(read_searches(spark, str(inbox)))).collect()}
    assert rows.keys() == whole.keys() == {"1", "2", "3"}
    for job, row in rows.items():
        assert (row.role_category, row.skills, row.query) == (
            whole[job].role_category, ["Python"], whole[job].query,
        )
    assert rejected_records(spark, str(inbox)).filter("record = 'not json'").count() == 4
    assert read_searches(spark, str(inbox)).count() == 4


def test_flatten(spark):
    adverts = [
        {"id": "1", "title": " Data Analyst "},
        {"id": 2, "company": {"display_name": "C"}, "location": {"display_name": "L", "area": ["UK", "London", "City"]}},
        {"id": "3", "location": {"area": ["UK"]}, "category": {"label": "IT"}},
        {"id": "4", "location": {"area": ["UK", None]}, "salary_min": 1.5},
        {"id": "5", "location": {"area": []}, "company": None},
    ]
    df = spark.createDataFrame([(json.dumps(a),) for a in adverts], "advert string")
    rows = parse_adverts(df, "advert", F.lit("q"), F.lit("now")).orderBy("id").collect()
    assert [r.region for r in rows] == [None, "London", "UK", None, None]
    assert (rows[0].title, rows[0].company, rows[0].location, rows[0].description) == ("Data Analyst", "", "", "")
    assert rows[1].id == "2" and rows[2].category == "IT" and rows[3].salary_min == 1.5


def test_csv_round_trip(spark, raw, tmp_path):
    tricky = 'He said "hi",\nthen left  '
    rows = raw(raw_row("007", description=tricky), raw_row("8", description=None, salary_max="n/a"))
    write_csv(rows, str(tmp_path / "raw"))
    back = {r.id: r for r in read_raw_csv(spark, str(tmp_path / "raw")).collect()}
    assert back["007"].description == tricky and back["8"].description is None
    done = process_postings(rows)
    write_csv(done, str(tmp_path / "done"))
    again = read_processed_csv(spark, str(tmp_path / "done"), done.schema)
    assert again.schema.simpleString() == done.schema.simpleString()
    assert sorted(map(str, again.collect())) == sorted(map(str, done.collect()))


def test_large_csv_files_are_split_without_line_breaks(spark, raw, tmp_path):
    rows = raw(*[raw_row(str(i), description="plain, \"quoted\" text " * 40) for i in range(200)])
    write_csv(rows.coalesce(1), str(tmp_path / "raw"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        whole = read_raw_csv(spark, str(tmp_path / "raw"))
        split = read_raw_csv(spark, str(tmp_path / "raw"), line_breaks=False)
        parts = [x.select(F.spark_partition_id()).distinct().count() for x in (whole, split)]
        assert parts[0] == 1 and parts[1] > 4
        assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_required_columns(spark):
    with pytest.raises(ValueError, match="description"):
        process_postings(spark.createDataFrame([("x",)], "title string"))
    with pytest.raises(ValueError, match="upload.*title, description"):
        require_columns(spark.createDataFrame([("x",)], "id string"), "upload")


def test_timestamps_and_summaries(spark, raw):
    df = with_timestamps(raw(raw_row("1", created="2025-03-02"), raw_row("2", created="nope", salary_min=None, salary_max=None)))
    assert [r.created is None for r in df.orderBy("id").collect()] == [False, True]
    assert tuple(dataset_summary(df).first()) == (2, "2025-03-05", "2025-03-05")
    assert tuple(processing_summary(process_postings(df)).first()) == (2, 1, 0.5)
    assert health(df).first().status == "ok" and health(df).first().null_share_created == 0.5
    assert health(df).first().detail is None
    assert health(None, spark=spark, detail="no table").first().asDict()["detail"] == "no table"
    assert health(None, spark=spark).first().status == "degraded"


def test_json_has_no_nan(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame(
        [(1, nan, [(inf,), (2.0,)]), (2, 1.5, None)], "id int, a double, b array<struct<c: double>>"
    )
    texts = [r.payload for r in as_json(df).collect()]
    assert [json.loads(x) for x in texts] == [
        {"id": 1, "a": None, "b": [{"c": None}, {"c": 2.0}]}, {"id": 2, "a": 1.5, "b": None},
    ]


def test_ids_share_calls_into_python(spark, tmp_path):
    """Ids of one bucket are handled together: no more state rows than buckets, and all ids right."""
    folder, n = str(tmp_path), 3 * BUCKETS
    for again in (1, 0):
        rows = spark.range(n).select(
            F.col("id").cast("string").alias("id"), F.timestamp_seconds(F.col("id") + again).alias("collected_at")
        )
        rows.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        query = keep_first_sightings(stream, f"{folder}/store", f"{folder}/log")
        query.awaitTermination()
    states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert 0 < max(states) <= BUCKETS
    got = first_sightings(spark, f"{folder}/store", rows.schema)
    assert got.filter(F.unix_timestamp("collected_at") == F.col("id").cast("long")).count() == got.count() == n
    # A new checkpoint takes all ids of a bucket over.
    keep_first_sightings(stream, f"{folder}/store", f"{folder}/other").awaitTermination()
    assert first_sightings(spark, f"{folder}/store", rows.schema).count() == n
