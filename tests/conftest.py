import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vacanta.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4, app="vacanta-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def raw_row(job_id, title="BI Developer (Fixed Term)", **changes):
    """A posting as collected; every field can be changed by name."""
    place = {"location": "Leeds", "region": "Yorkshire", "company": "Harbour & Finch"}
    terms = {"contract_type": "contract", "contract_time": "part_time", "salary_is_predicted": "1"}
    pay = {"salary_min": "41500", "salary_max": "48500"}
    times = {"created": "2025-03-03T07:45:00Z", "collected_at": "2025-03-05T06:15:00Z"}
    text = "<p>You will model sales in Tableau and <i>Snowflake</i>, with some Kafka.</p>"
    row = {"id": job_id, "title": title, "description": text, **place, **terms, **pay, **times}
    row |= {"category": "Reporting", "query": "bi developer", "redirect_url": f"https://jobs.invalid/{job_id}"}
    return row | changes


@pytest.fixture(scope="session")
def raw(spark):
    from vacanta.sources.schema import RAW

    def build(*rows):
        return spark.createDataFrame([tuple(r[n] for n in RAW.fieldNames()) for r in rows], RAW)

    return build
