import pytest
from pyspark.sql import functions as F

from vacanta.fixed_values import SKILL_DICTIONARY
from vacanta.functions.skills import (
    _SPELLING_TOKEN,
    category_counts,
    count_column,
    count_columns,
    ignored,
    known_skills,
    recognised,
    skills_in,
    tokens,
)
from vacanta.operators.demand import (
    dense_trend,
    in_category,
    most_mentioned,
    skill_demand,
    skill_trend,
    trend_choice,
    trend_series,
)
from vacanta.operators.dictionary import dictionary_problems, dictionary_table, match_dictionary

TEXTS = {
    "our stack: azure; tableau, kafka and a little scala": ["Azure", "Kafka", "Scala", "Tableau"],
    "": [],
    "docker, docker - git git git": ["Docker", "Git"],
    "javascript but no other": ["JavaScript"],
    "Microsoft SQL Server": ["SQL", "SQL Server"],
    "looker studio": ["Google Data Studio", "Looker"],
    "T-SQL": ["SQL"],
    "node.js": [],
    "c++ / c#": ["C#", "C++"],
    "a/b testing": ["A/B Testing"],
    "large language models": [],
    "R, ML.": ["Machine Learning", "R"],
    "pyspark": ["Spark"],
    "Bachelor's degree": ["Degree Required"],
    "PL/SQL and CI/CD": ["CI/CD", "SQL"],
    "R&D": [],
    "hyper-sql": ["SQL"],
    "data\npipelines": ["ETL/ELT"],
}


def texts(spark):
    rows = [(str(i), t) for i, t in enumerate([*TEXTS, None])]
    return spark.createDataFrame(rows, "id string, text string")


def expected():
    return {str(i): s for i, s in enumerate([*TEXTS.values(), []])}


def test_skills_in_text(spark):
    rows = texts(spark).select("id", skills_in(F.col("text")).alias("s")).collect()
    assert {r.id: r.s for r in rows} == expected()


def test_dictionary_join_finds_the_same(spark):
    rows = match_dictionary(texts(spark), dictionary_table(spark)).collect()
    assert {r.id: r.skills for r in rows} == expected()


def test_join_form_when_nothing_is_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rows = match_dictionary(texts(spark), dictionary_table(spark)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert {r.id: r.skills for r in rows} == expected()


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dictionary_join_evaluates_texts_once(spark):
    """A broadcast dictionary and one pass, unless it has spellings of more than eight words."""
    turned = texts(spark).select("id", F.reverse("text").alias("text"))
    plan = optimised(match_dictionary(turned, dictionary_table(spark)))
    assert plan.count("reverse(") == 1 and plan.count("broadcast") == 1


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_spellings_of_every_length(spark, threshold):
    words = [f"w{i}" for i in range(1, 13)]
    spellings = {f"first {n}": " ".join(words[:n]) for n in (1, 2, 3, 4, 8, 9, 11)}
    spellings |= {f"last {n}": " ".join(words[-n:]) for n in (1, 2, 3, 8, 9)} | {"broken": "w1 w2 w4", "past the end": "w11 w12 w13"}
    rows = [("whole", " ".join(words)), ("start", "w1 w2 w3"), ("twice", "w1 w1 w2 w1 w2 w3 w4"), ("none", "x"), ("null", None), (None, "w1 w2 w3")]
    dictionary = spark.createDataFrame(list(spellings.items()), "skill string, alias string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = match_dictionary(spark.createDataFrame(rows, "id string, text string"), dictionary).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.id: r.skills for r in found} == {
        "whole": sorted(set(spellings) - {"broken", "past the end"}),
        "start": ["first 1", "first 2", "first 3"],
        "twice": ["first 1", "first 2", "first 3", "first 4"],
        "none": [],
        "null": [],
        None: ["first 1", "first 2"],
    }


def test_no_dictionary_rows(spark):
    empty = spark.createDataFrame([], "skill string, alias string")
    assert {r.id: r.skills for r in match_dictionary(texts(spark), empty).collect()} == {i: [] for i in expected()}


def test_spelling_tokens_equal_text_tokens(spark):
    spellings = [w for g in SKILL_DICTIONARY.values() for ws in g.values() for w in ws]
    df = spark.createDataFrame([(w,) for w in spellings], "w string").select("w", tokens(F.col("w")).alias("t"))
    assert all(r.t == _SPELLING_TOKEN.findall(r.w.lower()) for r in df.collect())


def test_empty_dictionary(spark):
    assert texts(spark).select(skills_in(F.col("text"), {})).first()[0] == []


def test_dictionary_is_sound(spark):
    table = dictionary_table(spark)
    assert dictionary_problems(table).count() == 0
    assert len(known_skills()) == len(set(known_skills())) == 56
    assert table.count() == 112
    assert count_column("Machine Learning & AI") == "n_Machine_Learning_and_AI"
    assert len(set(count_columns())) == 9


def test_dictionary_problems_are_found(spark):
    bad = spark.createDataFrame(
        [("A B", "x", "x"), ("A_B", "x", "y"), ("C\tD", "z", " "), (None, "w", "w")],
        "category string, skill string, alias string",
    )
    found = {(r.problem, r.subject) for r in dictionary_problems(bad).collect()}
    assert found == {
        ("skill in several categories", "x"),
        ("skill without category", "w"),
        ("blank spelling", "z"),
        ("count column not unique", "A B"),
        ("count column not unique", "A_B"),
        ("count column name not safe", "C\tD"),
    }


def test_counts_and_recognition(spark):
    df = spark.createDataFrame([(["Python", "Python", "SQL", "AWS", "Nope"],), (None,)], "s array<string>")
    counts = category_counts(F.col("s"))
    row, empty = df.select(*[c.alias(n) for n, c in counts.items()]).collect()
    assert (row.n_Programming_Languages, row.n_Cloud_Platforms, row.n_skills_total) == (3, 1, 5)
    assert sum(empty) == 0
    known, rest = df.select(recognised(F.col("s")), ignored(F.col("s"))).first()
    assert known == ["Python", "Python", "SQL", "AWS"] and rest == ["Nope"]


@pytest.fixture()
def lists(spark):
    return spark.createDataFrame(
        [
            ("2026-08-03T00:00:00Z", ["Python", "SQL"]),
            ("2026-08-09T23:59:59Z", ["Python"]),
            ("2026-08-10T00:00:00Z", ["SQL", "AWS", "Nope"]),
            ("bad", ["Python"]),
            (None, ["SQL"]),
            ("2026-08-10T00:00:00Z", []),
        ],
        "collected_at string, skills array<string>",
    )


def test_demand(spark, lists):
    rows = {r.skill: r for r in skill_demand(lists).collect()}
    assert rows["Python"].postings_mentioning == 3 and rows["Python"].pct_of_postings == 50.0
    assert rows["AWS"].pct_of_postings == 16.7
    assert rows["Nope"].category == "Other"
    assert [r.skill for r in most_mentioned(skill_demand(lists), 2).collect()] == ["Python", "SQL"]
    assert [r.skill for r in in_category(skill_demand(lists), "Cloud Platforms").collect()] == ["AWS"]
    by_table = skill_demand(lists, dictionary_table(spark))
    assert sorted(by_table.collect()) == sorted(skill_demand(lists).collect())
    with pytest.raises(ValueError):
        most_mentioned(skill_demand(lists), 9999)


def test_demand_of_nothing(spark, lists):
    assert skill_demand(lists.filter("false")).count() == 0
    assert skill_trend(lists.filter("false")).count() == 0


def test_trend(lists):
    rows = {(r.period, r.skill): r.mentions for r in skill_trend(lists).collect()}
    assert rows == {
        ("2026-08-03", "Python"): 2,
        ("2026-08-03", "SQL"): 1,
        ("2026-08-10", "SQL"): 1,
        ("2026-08-10", "AWS"): 1,
        ("2026-08-10", "Nope"): 1,
    }
    assert skill_trend(lists, "M").filter("skill = 'SQL'").collect()[0].mentions == 2
    assert skill_trend(lists, "D", ["SQL"]).count() == 2
    with pytest.raises(ValueError):
        skill_trend(lists, "Q")


def test_trend_of_chosen_skills(lists):
    chosen = skill_trend(lists, "W", trend_choice(lists))
    assert {r.skill for r in chosen.collect()} == {"Python", "SQL", "AWS", "Nope"}
    dense = {(r.period, r.skill): r.mentions for r in dense_trend(skill_trend(lists, "W", ["Python", "SQL"])).collect()}
    assert dense[("2026-08-10", "Python")] == 0 and len(dense) == 4
    series = {r.skill: r.points for r in trend_series(chosen).collect()}
    assert [(p.period, p.value) for p in series["SQL"]] == [("2026-08-03", 1), ("2026-08-10", 1)]
    assert len(trend_choice(lists, [str(i) for i in range(20)])) == 20
