import random
import re

import pytest
from pyspark.sql import functions as F

from vacanta.operators import bitmaps, search_index
from vacanta.operators.filters import search


@pytest.fixture(scope="module")
def postings(spark):
    rng = random.Random(2)
    words = ["data", "analyst", "lead", "büro", "c++", "a/b", "power", "bi", "Ärzte", "x"]
    rows = [
        (str(i), " ".join(rng.choice(words) for _ in range(4)), rng.choice(["Acme", None, "Powers & Co"]), "Leeds", [rng.choice(["SQL", "Power BI"])])
        for i in range(900)
    ]
    rows += [(None, None, None, None, None), ("e", "", "", "", []), ("e", "ab", None, None, None)]
    return spark.createDataFrame(rows, "id string, title string, company string, location string, skills array<string>").repartition(5)


@pytest.fixture(scope="module")
def index(spark, postings, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "i")
    search_index.build(postings, path)
    return path


@pytest.mark.parametrize("named", [2_000, 0])
@pytest.mark.parametrize("query", [" Power BI ", "büro", "c++ a/b", "ärzte", "x", "", "no such text", "data data data", "leeds", "o b"])
def test_index_equals_a_scan(spark, postings, index, monkeypatch, query, named):
    monkeypatch.setattr(search_index, "NAMED", named)
    got = search_index.search(spark, index, query)
    assert got.columns == postings.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, search(postings, query).collect()))


def test_ranges():
    assert search_index.ranges([]) == []
    assert search_index.ranges([3, 4, 9, 30, 31], 3) == [(3, 4), (9, 9), (30, 31)]
    assert search_index.ranges([1, 5, 6], 1) == [(1, 6)]


def test_only_candidates_are_read(spark, postings, index):
    text = postings.filter("id = '7'").first().title
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = search_index.search(spark, index, text)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: .*(GreaterThanOrEqual|EqualTo)\(search_row", plan)
    lists = search_index.candidates(spark, index, "power bi")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "In(gram" in lists and "search_text" not in lists


def test_bitmap_members(spark):
    numbers = sorted({1, 2, 8, 9, 32_768, 32_769, 65_536, 65_537, (5 << 33) + 7, *range(40_000, 40_020)})
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    built = df.groupBy(bitmaps.bucket_of(F.col("n")).alias("bucket")).agg(bitmaps.bitmap_of(F.col("n")).alias("bitmap"))
    back = built.select(F.explode(bitmaps.members(F.col("bitmap"), F.col("bucket")))).collect()
    assert sorted(r[0] for r in back) == numbers
    assert spark.range(1).select(bitmaps.count_union(built.unionByName(built))).first()[0] == len(numbers)
