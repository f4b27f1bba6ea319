"""Quality by a regularised quadratic discriminant over document statistics.

A text becomes a short vector of statistics: how many words and how long, which kinds of
characters, how often words, three-word windows and lines repeat. Shares and counts go
through logarithms, so that each class is closer to a normal distribution. Each class
(label 1, label 0) has a mean and a covariance; the covariance is shrunk toward the
pooled one and then toward a multiple of the identity, so it can always be factored.
The score is the logistic of the difference of the two log densities, Mahalanobis terms
with cached inverse Cholesky factors and determinants, plus the log odds of the classes.

Texts are read once, into a table of statistics. Training joins it with the labels and sums
(count, statistics, products) over all labelled rows, first within tasks; only
2 * (1 + d + d * d) sums reach the driver. Nothing is sampled. Scoring is a pass over the
statistics without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.session import scratch_path

NAMES = (
    "words", "word_length", "length_spread", "short_words", "symbols", "punctuation", "capitals", "digits",
    "letters", "entropy", "same_as_last", "distinct_words", "repeated_windows", "repeated_lines", "words_per_line",
)
WIDTH = len(NAMES)
SYMBOLS = "#*$%&|<>"
POOLED = 0.5  # share of the pooled covariance
ROUND = 0.01  # share of the identity
TEMPERATURE = 0.5  # statistics are not independent draws; their evidence counts for less
LEAST = 0.01  # added to shares before their logarithm
_SPACE, _LOWER, _UPPER, _DIGIT, _SYMBOL, _MARK, _LETTER = range(7)
_TABLE_SIZE = 0x250


def _kind(c: str) -> int:
    if c.isspace() or not c.isprintable():
        return _SPACE
    if c in SYMBOLS:
        return _SYMBOL
    if c.isdigit():
        return _DIGIT
    if c.isalpha():
        return _UPPER if c.isupper() else _LOWER
    return _MARK


# Characters beyond the table count as letters without case.
_KINDS = np.array([_kind(chr(c)) for c in range(_TABLE_SIZE)] + [_LETTER])


def statistics(text: str | None) -> list[float]:
    """The statistics named ``NAMES`` of a whole text; null counts as empty."""
    text = text or ""
    words = text.split()
    n = len(words)
    lines = [line for line in text.split("\n") if line.strip()]
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4"), _TABLE_SIZE)
    seen = np.bincount(codes, minlength=_TABLE_SIZE + 1)
    kinds = np.bincount(_KINDS, weights=seen, minlength=7)
    shown = max(1.0, kinds.sum() - kinds[_SPACE])
    letters = kinds[_LOWER] + kinds[_UPPER] + kinds[_LETTER]
    lengths = np.fromiter(map(len, words), dtype=float, count=n) if n else np.zeros(1)
    counts = seen[seen > 0]
    shares = counts / max(1, len(codes))
    windows = len(set(zip(words, words[1:], words[2:], strict=False)))

    def log_share(part: float, whole: float) -> float:
        return float(np.log(part / max(1.0, whole) + LEAST))

    return [
        float(np.log1p(n)),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        log_share(float((lengths <= 3).sum()) if n else 0.0, n),
        log_share(kinds[_SYMBOL], shown),
        log_share(kinds[_MARK], shown),
        log_share(kinds[_UPPER], letters),
        log_share(kinds[_DIGIT], shown),
        log_share(letters, shown),
        float(-(shares * np.log(shares)).sum()),
        log_share(sum(map(str.__eq__, words[1:], words)), n - 1),
        float(np.log1p(len(set(words))) / np.log1p(n)) if n else 1.0,
        log_share(max(0, n - 2) - windows, n - 2),
        log_share(len(lines) - len(set(lines)), len(lines)),
        float(np.log1p(n / max(1, len(lines)))),
    ]


def measured(documents: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``statistics``, written once for training and scoring."""
    narrow = documents.select(*keep, F.col(text).alias("_quality_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[: len(keep)])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(x.as_py()) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(found, pa.list_(pa.float64()))], names=[*keep, "statistics"]
            )

    path = scratch_path(documents.sparkSession, "quality-statistics")
    narrow.mapInArrow(measure, f"{schema}, statistics array<double>").write.parquet(path)
    return documents.sparkSession.read.parquet(path)


@dataclass(frozen=True)
class Model:
    """Scores = logistic(offset + (log density of label 1 - that of label 0) * temperature)."""

    offset: float
    means: np.ndarray | None = None  # 2 x d, label 0 first
    inverse_factors: np.ndarray | None = None  # 2 x d x d, inverses of the Cholesky factors
    log_roots: np.ndarray | None = None  # half the log determinants

    def scores(self, rows: np.ndarray) -> np.ndarray:
        margin = np.full(len(rows), self.offset)
        if self.means is not None:
            logs = []
            for mean, inverse, log_root in zip(self.means, self.inverse_factors, self.log_roots, strict=True):
                distance = (rows - mean) @ inverse.T
                logs.append(-0.5 * (distance**2).sum(axis=1) - log_root)
            margin = margin + TEMPERATURE * (logs[1] - logs[0])
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def fitted(n: np.ndarray, sums: np.ndarray, products: np.ndarray, pooled: float = POOLED, round_: float = ROUND) -> Model:
    """The model of two classes from their counts, sums and sums of products.

    Without rows of both classes the score is the share of label 1, 0.5 without any row.
    A class of one row has the pooled covariance's shape through the shrinkage.
    """
    offset = float(np.log((n[1] + 0.5) / (n[0] + 0.5)))
    if not n.all():
        return Model(offset)
    means = sums / n[:, None]
    scatter = products - n[:, None, None] * means[:, :, None] * means[:, None, :]
    within = scatter.sum(axis=0) / n.sum()
    # Statistics are on scales of their own: the identity is that of the pooled deviations.
    scale = np.sqrt(np.maximum(np.diag(within), 1e-6))
    factors, roots = [], []
    for k in range(2):
        own = (1 - pooled) * scatter[k] / n[k] + pooled * within
        shrunk = own / scale[:, None] / scale
        shrunk = (1 - round_) * shrunk + round_ * max(np.trace(shrunk) / len(scale), 1e-6) * np.eye(len(scale))
        factor = np.linalg.cholesky(shrunk) * scale[:, None]
        factors.append(np.linalg.inv(factor))
        roots.append(float(np.log(np.diag(factor)).sum()))
    return Model(offset, means, np.array(factors), np.array(roots))


def train(labels: DataFrame, measured: DataFrame, label: str = "quality", key: str = "doc_id") -> Model:
    """A model of all rows of ``measured`` that ``labels`` (key and label) marks 0 or 1.

    Null or other labels, null keys and keys on one side only are left out. A key that is
    labelled repeatedly counts so often, with each label; its labels are added up before
    the join, which therefore never multiplies rows.
    """
    spark = measured.sparkSession
    y = F.col(label).cast("int")
    path = scratch_path(spark, "quality-labels")
    (
        labels.select(F.col(key).alias("key"), y.alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.sum(1 - F.col("y")).cast("double").alias("n0"), F.sum("y").cast("double").alias("n1"))
        .write.parquet(path)
    )
    known = spark.read.parquet(path)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + WIDTH + WIDTH * WIDTH))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, WIDTH)
            products = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
            row = np.concatenate([np.ones((len(x), 1)), x, products], axis=1)
            for k in range(2):
                total[k] += batch.column(1 + k).to_numpy() @ row
        where = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(where[0], pa.int32()), pa.array(where[1], pa.int32()), pa.array(total[where])],
            names=["label", "place", "value"],
        )

    joined = measured.select(F.col(key).alias("key"), "statistics").join(known, "key").select("statistics", "n0", "n1")
    sums = joined.mapInArrow(add, "label int, place int, value double").groupBy("label", "place").agg(F.sum("value").alias("value"))
    total = np.zeros((2, 1 + WIDTH + WIDTH * WIDTH))
    for r in sums.collect():  # a row for each sum of each class
        total[r.label, r.place] = r.value
    n, means, products = total[:, 0], total[:, 1 : 1 + WIDTH], total[:, 1 + WIDTH :].reshape(2, WIDTH, WIDTH)
    return fitted(n, means, products)


def scored(measured: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``score`` (0 to 1, label 1 likelier) of every measured row.

    Null and empty texts have statistics like any other; repeated rows and null ids stay.
    No row, no result. Other columns of the documents are not read.
    """
    sent = measured.sparkSession.sparkContext.broadcast(model)  # d * d numbers
    narrow = measured.select(*keep, "statistics")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[: len(keep)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(len(keep)).flatten().to_numpy().reshape(batch.num_rows, WIDTH)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(sent.value.scores(x))], names=[*keep, "score"]
            )

    return narrow.mapInArrow(score, f"{schema}, score double")
