"""Benchmark decontamination: a prefix-filtered set join with exact verification.

Each benchmark item is cut into windows of 13 consecutive words (a shorter item is one
window). A document contains a window only if it contains the window's rarest word, so
that word is the necessary prefix: with containment of all words, a prefix of one word is
enough. The join runs on it alone, the position of the word in the window bounds where the
window can start, the document's length bounds where it can end, and what is left is
compared word by word.

Before the join, two lossless filters over the whole text of every document: each word is
marked as in or outside the benchmark's vocabulary, and a document without a run of
marked words as long as the shortest window cannot contain any. Only documents with such
a run are exploded into words. Rarity is counted over all documents that have a run.

Work per document is bounded by its own length times the windows that share a prefix
word. Prefixes are broadcast if they are few. Results meet on the number of the row, which
no two rows share, so repeated documents do not gather in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacanta.session import scratch_path

WINDOW_WORDS = 13
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A vocabulary of more words is not put into the plan; then every document is exploded.
LITERAL_WORDS = 50_000
# So many windows (about 200 bytes each) may be broadcast to the words of the documents; more
# meet them by a shuffle, where adaptive execution splits a frequent word.
BROADCAST_WINDOWS = 200_000


def words_of(text: Column) -> Column:
    """Words with A-Z in lower case; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, length, words, window): distinct windows of items; ``window`` numbers them."""
    words = benchmark.select(F.col(item).alias("item"), words_of(F.col(text)).alias("all_words"))
    words = words.filter(F.size("all_words") > 0)
    length = F.least(F.size("all_words"), F.lit(WINDOW_WORDS))
    starts = F.sequence(F.lit(1), F.size("all_words") - length + 1)
    return (
        words.withColumn("length", length)
        .withColumn("at", F.explode(starts))
        .select("item", "length", F.slice("all_words", F.col("at"), F.col("length")).alias("words"))
        .distinct()
        .withColumn("window", F.xxhash64("item", "words"))
    )


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: ``keep``, n_words, n_hit, n_items, items, contaminated.

    ``n_hit`` counts words inside any occurrence of a window, ``items`` are the ids (as
    sorted text) of items with an occurrence, ``contaminated`` is true where at least one
    word in twenty is hit. Null and empty texts have no words and are clean. Repeated rows
    and null ids give a row each. Without documents there is no row, without benchmark
    nothing is hit. Columns not named in ``keep`` are ignored, so their names cannot clash.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "windows")
    item_windows(benchmark, item, item_text).write.parquet(path)
    windows = spark.read.parquet(path)
    shortest = windows.agg(F.min("length")).first()[0]
    vocabulary = [
        r[0] for r in windows.select(F.explode("words")).distinct().limit(LITERAL_WORDS + 1).collect()
    ]

    # All documents: row number, length, and the words where a window could be.
    narrow = documents.select(*(F.col(c).alias(f"_k_{c}") for c in keep), words_of(F.col(text)).alias("words"))
    if len(vocabulary) > LITERAL_WORDS:
        possible = F.lit(True)
    elif vocabulary:
        marks = F.transform("words", lambda w: F.when(w.isin(vocabulary), "1").otherwise("0"))
        possible = F.array_join(marks, "").rlike(f"1{{{shortest}}}")
    else:
        possible = F.lit(False)
    path = scratch_path(spark, "words")
    narrow.select(
        *(f"_k_{c}" for c in keep),
        F.monotonically_increasing_id().alias("row"),
        F.size("words").cast("long").alias("n_words"),
        F.when(possible, F.col("words")).alias("words"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    runs = rows.filter(F.col("words").isNotNull()).select("row", "n_words", "words")

    # Prefix of each window: its rarest word, and where that word stands.
    in_windows = windows.select(F.explode("words").alias("word")).distinct()
    frequency = (
        runs.select(F.explode(F.array_distinct("words")).alias("word"))
        .join(in_windows, "word", "left_semi")
        .groupBy("word")
        .agg(F.count("*").alias("documents"))
    )
    prefix = (
        windows.select("window", F.posexplode("words").alias("offset", "word"))
        .join(frequency, "word")
        .groupBy("window")
        .agg(
            F.count("*").alias("present"),
            F.min(F.struct("documents", "word", "offset")).alias("rarest"),
        )
        # A window with a word that no document has cannot occur.
        .join(windows.select("window", "item", "length", F.col("words").alias("window_words")), "window")
        .filter(F.col("present") == F.col("length"))
        .select("item", "length", "window_words", "rarest.word", "rarest.offset")
    )

    path = scratch_path(spark, "prefixes")
    prefix.write.parquet(path)
    prefix = spark.read.parquet(path)
    if prefix.count() <= BROADCAST_WINDOWS:
        prefix = F.broadcast(prefix)

    # Candidates by prefix word, bounded by position and length, then verified.
    places = runs.select("row", F.posexplode("words").alias("at", "word"))
    candidates = (
        places.join(prefix, "word")
        .select("row", (F.col("at") - F.col("offset")).alias("start"), "length", "window_words", "item")
        .filter(F.col("start") >= 0)
    )
    hits = (
        candidates.join(runs, "row")
        .filter(F.col("start") + F.col("length") <= F.col("n_words"))
        .filter(F.slice("words", F.col("start") + 1, F.col("length")) == F.col("window_words"))
        .select("row", "start", (F.col("start") + F.col("length")).alias("end"), "item")
        .distinct()
    )
    so_far = Window.partitionBy("row").orderBy("start", "end", "item")
    reached = F.max("end").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("end") - F.greatest(F.col("start"), F.coalesce(reached, F.lit(0)))
    found = (
        hits.withColumn("fresh", F.greatest(fresh, F.lit(0)))
        .groupBy("row")
        .agg(
            F.sum("fresh").alias("n_hit"),
            F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"),
        )
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.drop("words").join(found, "row", "left").select(
        *(F.col(f"_k_{c}").alias(c) for c in keep),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
