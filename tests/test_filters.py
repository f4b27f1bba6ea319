import pytest

from vacanta.operators.filters import active_selections, apply_filters, filter_options, search
from vacanta.operators.recent import newest, posting_cards, recent_postings


@pytest.fixture(scope="module")
def postings(spark):
    return spark.createDataFrame(
        [
            ("1", "Data Analyst", "A", "London", ["SQL"], "2026-08-02T00:00:00Z", 30000.5),
            ("2", "Data Engineer", "B", "Leeds", ["Spark", "Power BI"], "2026-08-03T00:00:00Z", 5.0),
            ("3", "Data Analyst", "A", None, [], "2026-08-03T00:00:00Z", None),
            ("4", " ", None, "Leeds", None, "bad", 40000.0),
        ],
        "id string, role_category string, company string, location string, skills array<string>, "
        "created string, salary_midpoint double",
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def test_or_within_and_across(postings):
    assert ids(apply_filters(postings, {"role_category": ["Data Analyst", "Data Engineer"]})) == ["1", "2", "3"]
    both = {"role_category": ["Data Analyst"], "location": ["London"]}
    assert ids(apply_filters(postings, both)) == ["1"]
    assert ids(apply_filters(postings, {"role_category": [], "nope": ["x"]})) == ["1", "2", "3", "4"]
    assert ids(apply_filters(postings, {"location": ["Not a place", "nan"]})) == []
    assert ids(apply_filters(postings, {"salary_midpoint": ["5.0"]})) == ["2"]
    assert active_selections({"a": [], "b": ["x"]}) == {"b": ["x"]}


def test_or_is_additive(postings):
    counts = [apply_filters(postings, {"role_category": [r]}).count() for r in ("Data Analyst", "Data Engineer")]
    assert apply_filters(postings, {"role_category": ["Data Analyst", "Data Engineer"]}).count() == sum(counts)


def test_options(postings):
    rows = {(r.column_name, r.value) for r in filter_options(postings).collect()}
    assert rows == {
        ("role_category", "Data Analyst"), ("role_category", "Data Engineer"),
        ("location", "London"), ("location", "Leeds"),
    }
    assert filter_options(postings.select("id")).count() == 0


def test_search(postings):
    assert ids(search(postings, "power bi")) == ["2"]
    assert ids(search(postings, " LEEDS")) == ["2", "4"]
    assert ids(search(postings, "  ")) == ["1", "2", "3", "4"]


def test_recent(postings):
    cards = recent_postings(postings, 2).collect()
    assert [c.created for c in cards] == ["2026-08-03", "2026-08-03"]
    assert cards[0].salary is None and cards[0].location == "Leeds" and cards[0].title == ""
    assert [r.id for r in newest(postings, 3).collect()] == ["2", "3", "1"]
    card = posting_cards(postings.filter("id = '1'")).first()
    assert card.salary == 30000 and card.skills == ["SQL"] and card.url == ""
    for wrong in (0, 201):
        with pytest.raises(ValueError):
            newest(postings, wrong)
