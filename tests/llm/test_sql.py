import duckdb
import pytest

from tests.llm.conftest import SMALL
from vacanta.llm.queries import CHECKS, JOBS


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(workers, duck, name):
    cursor = duck.execute(CHECKS[name])
    columns = [d[0] for d in cursor.description]
    df = JOBS[name](workers, SMALL)
    assert set(df.columns) == set(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(cursor.fetchall())


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(JOBS)
    assert sorted(int(n[2:].split("_")[0]) for n in JOBS) == [*range(1, 14)]
