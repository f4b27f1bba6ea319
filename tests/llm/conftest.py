import random

import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside.
        T.StructField("key", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("words", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("blob", T.StringType()),
        T.StructField("size", T.StringType()),
        *(T.StructField(n, T.StringType()) for n in ("_id", "_found", "_digest", "pii_found", "document_key")),
    ]
)


@pytest.fixture(scope="session")
def workers(spark):
    from vacanta.llm.queries import ship

    ship(spark)
    return spark


@pytest.fixture(scope="session")
def build(workers):
    """Documents of (doc_id, text) pairs, with clashing and null columns."""

    def make(pairs):
        rows = [
            (i, t, ("en", None)[n % 2], None, None, "k", "r", None, 3, "b", "s", "i", "f", None, "p", "d")
            for n, (i, t) in enumerate(pairs)
        ]
        return workers.createDataFrame(rows, DOCUMENTS)

    return make


def prose(seed, n, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd():
    """Null, empty, blank, very long, repeated and id-less rows."""
    long_text = prose(1, 60_000)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, long_text),
        (5, long_text),
        (6, "één Ünï 中文 😀 \x00 end"),
        (6, "één Ünï 中文 😀 \x00 end"),
        (None, prose(2, 80)),
        (None, prose(2, 80)),
        (None, None),
        (9, "a " * 700),
    ]
