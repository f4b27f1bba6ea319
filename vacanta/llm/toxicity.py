"""Toxicity by a linear classifier over character n-grams scaled by log-count ratios.

A text's features are the hashed n-grams of its lower-cased characters that occur in it,
each once. A naive Bayes step counts in how many toxic and clean training texts each
n-gram occurs; its log-count ratio scales the feature, and n-grams that are rare or whose
counts could be chance are left out. A logistic regression with an L2 penalty is then fitted on the scaled
features. Its weights and the ratios multiply to one table of fixed size for scoring.

Training uses at most ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` clean labelled rows, those
with the smallest hash of their key; rows are weighted so that the share of toxic ones is
that of all labelled training rows. Everything the driver and the one fitting task see is
bounded by these numbers and by ``BUCKETS``. Scoring covers every whole text in one pass
without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.session import scratch_path

ORDERS = (4, 5, 6)
BUCKETS = 1 << 18
TOXIC_ROWS = 4_000
CLEAN_ROWS = 8_000
MIN_TEXTS = 3
MIN_RATIO = 1.0
SMOOTHING = 1.0
PENALTY = 1e-3
# Least G statistic of an n-gram's counts against independence of the class.
MIN_EVIDENCE = 15.0
STEPS = 150
_MULTIPLIER = np.uint32(0x01000193)
_MIX = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class Model:
    """Score = logistic(bias + the weights of the features that occur)."""

    weights: np.ndarray
    bias: float


def buckets_of(text: str | None) -> np.ndarray:
    """Bucket of every n-gram of every order, repeats included."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    found, hashed = [], codes.astype(np.uint32)
    for n in range(2, max(ORDERS) + 1):
        if len(codes) < n:
            break
        hashed = hashed[:-1] * _MULTIPLIER + codes[n - 1 :]
        if n in ORDERS:
            found.append(((hashed ^ np.uint32(n)) * _MIX) >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)


def score_text(text: str | None, model: Model) -> float:
    at = buckets_of(text)
    at = np.unique(at[model.weights[at] != 0])
    margin = model.bias + float(model.weights[at].sum(dtype=np.float64))
    return float(1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))))


def log_count_ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """0 for an n-gram that neither class has, however uneven the classes are."""
    total = n_toxic + n_clean
    p = (toxic + SMOOTHING * n_toxic / total) / n_toxic
    q = (clean + SMOOTHING * n_clean / total) / n_clean
    return np.log(p / q)


def evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """The G statistic of each n-gram's two-by-two table of occurrence and class."""
    total = n_toxic + n_clean
    share = (toxic + clean) / total
    found = np.zeros(len(toxic))
    for seen, size in ((toxic, n_toxic), (clean, n_clean)):
        for observed, expected in ((seen, share * size), (size - seen, (1 - share) * size)):
            some = observed > 0
            found[some] += 2 * observed[some] * np.log(observed[some] / expected[some])
    return found


def fit_weights(
    labels: np.ndarray, features: list[np.ndarray], ratios: np.ndarray, row_weights: np.ndarray
) -> Model:
    """Weighted logistic regression on the scaled features, by full-batch Adam steps."""
    used = np.flatnonzero(ratios)
    place = np.zeros(len(ratios), dtype=np.int64)
    place[used] = np.arange(len(used))
    at = place[np.concatenate(features)] if features else np.zeros(0, dtype=np.int64)
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    scale = ratios[used]
    value = scale[at]
    share = row_weights / row_weights.sum()
    prior = float((share * labels).sum())
    bias = np.log(prior / (1 - prior))
    w = np.zeros(len(used) + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        margin = bias + w[-1] + np.bincount(row, weights=value * w[at], minlength=len(labels))
        error = share * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels)
        slope = np.append(np.bincount(at, weights=value * error[row], minlength=len(used)), error.sum())
        slope[:-1] += PENALTY * w[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    weights = np.zeros(len(ratios))
    weights[used] = w[:-1] * scale
    return Model(weights, float(bias + w[-1]))


def train(
    labels: DataFrame,
    documents: DataFrame,
    text: str = "text",
    label: str = "toxic",
    key: str = "doc_id",
) -> Model:
    """A model of the documents that ``labels`` (key and label) marks 0 or 1.

    The sample is drawn from the labels alone and has at most ``TOXIC_ROWS`` +
    ``CLEAN_ROWS`` rows, so its keys may go to every task that reads documents, and only
    the sampled texts move. Null or other labels, null keys and keys without a document
    are left out. A key counts once for each label it has, with one text (the smallest of a
    repeated key), so repeated rows do not make the sample larger. Without rows of both classes the
    model scores every text with the share of toxic rows, or 0.5 without any row.
    """
    spark = documents.sparkSession
    rows = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & F.col("key").isNotNull()
    ).distinct()
    totals = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
    constant = Model(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    if not n_toxic or not n_clean:
        return constant

    # The rows of smallest hash: hashes below a bound that lets about twice the number pass
    # first, so the sort that takes exactly that number sees few rows.
    def sample(y: int, n: int, total: int) -> DataFrame:
        order = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
        some = rows.filter(F.col("y") == y).withColumn("at", order)
        if total > 4 * n:
            some = some.filter(F.col("at") < int((1 << 30) * 2.0 * n / total))
        return some.orderBy("at", "key").limit(n).drop("at")

    drawn = sample(1, TOXIC_ROWS, n_toxic).unionByName(sample(0, CLEAN_ROWS, n_clean))
    path = scratch_path(spark, "toxicity-sample")
    (
        documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .join(F.broadcast(drawn), "key")
        .groupBy("key", "y")
        .agg(F.min("text").alias("text"))
        .repartition(12, "key")
        .write.parquet(path)
    )
    chosen = spark.read.parquet(path)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            for content, y in zip(batch["text"], batch["y"], strict=True):
                seen[y, np.unique(buckets_of(content))] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pd.DataFrame({"bucket": at, "clean": seen[0, at], "toxic": seen[1, at]})

    counts = (
        chosen.mapInPandas(count, "bucket long, clean long, toxic long")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("clean") + F.col("toxic") >= MIN_TEXTS)
        .toPandas()  # at most BUCKETS rows
    )
    found = {r.y: r["count"] for r in chosen.groupBy("y").count().collect()}
    sampled = {y: found.get(y, 0) for y in (0, 1)}
    if not all(sampled.values()):
        return constant
    both = np.zeros((2, BUCKETS))
    both[0, counts["bucket"]], both[1, counts["bucket"]] = counts["clean"], counts["toxic"]
    ratios = log_count_ratios(both[1], both[0], sampled[1], sampled[0])
    ratios[(both.sum(axis=0) < MIN_TEXTS) | (np.abs(ratios) < MIN_RATIO)] = 0
    ratios[evidence(both[1], both[0], sampled[1], sampled[0]) < MIN_EVIDENCE] = 0

    sent = spark.sparkContext.broadcast(ratios)  # BUCKETS doubles
    weight = {y: totals[y] / sampled[y] for y in (0, 1)}

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for content in batch["text"]:
                at = np.unique(buckets_of(content))
                found.append(at[sent.value[at] != 0].astype("<i4").tobytes())
            yield pd.DataFrame({"y": batch["y"], "features": found})

    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values(["y", "features"], ignore_index=True)
        labels = sample["y"].to_numpy(dtype=float)
        model = fit_weights(
            labels,
            [np.frombuffer(x, dtype="<i4") for x in sample["features"]],
            sent.value,
            np.where(labels == 1, weight[1], weight[0]),
        )
        return pd.DataFrame({"weights": [model.weights.astype("<f8").tobytes()], "bias": [model.bias]})

    # One group on purpose: its rows are bounded by TOXIC_ROWS and CLEAN_ROWS.
    fitted = (
        chosen.mapInPandas(features, "y int, features binary")
        .withColumn("all", F.lit(0))
        .groupBy("all")
        .applyInPandas(fit, "weights binary, bias double")
        .first()
    )
    return Model(np.frombuffer(fitted.weights, dtype="<f8"), float(fitted.bias))


def scored(documents: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``score`` (0 to 1) of every row.

    Null and empty texts, and texts shorter than an n-gram, get the model's bias as score.
    Rows and nulls in other columns pass through; no row, no result.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    narrow = documents.select(*keep, F.col(text).alias("_toxicity_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[: len(keep)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            scores = [score_text(x.as_py(), model) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(scores, pa.float64())], names=[*keep, "score"]
            )

    return narrow.mapInArrow(score, f"{schema}, score double")
