"""Skill dictionaries that are tables: matching by join, and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacanta.fixed_values import SKILL_DICTIONARY
from vacanta.functions.skills import Dictionary, tokens
from vacanta.functions.text import is_blank


def dictionary_table(spark, dictionary: Dictionary = SKILL_DICTIONARY) -> DataFrame:
    """A dictionary constant as rows ``(category, category_order, skill, alias)``."""
    rows = [
        (category, order, skill, alias)
        for order, (category, skills) in enumerate(dictionary.items())
        for skill, aliases in skills.items()
        for alias in aliases
    ]
    return spark.createDataFrame(
        rows, "category string, category_order int, skill string, alias string"
    )


LEAD_WORDS = 2
# Spellings of more words than this are compared beside their texts, joined by key.
WORDS_AT_PLACE = 8
# Spellings of no more bytes than this are broadcast.
SMALL_DICTIONARY = 4_000_000
# Leads of the rows that keep texts without a hit; no word holds a line break.
MARKS = 64


def match_dictionary(
    texts: DataFrame, dictionary: DataFrame, key: str = "id", text: str = "text"
) -> DataFrame:
    """``(key, skills)`` for texts against a dictionary table ``(skill, alias)`` of any size.

    Every word, and every word with its neighbour, is looked up by an equi-join among the
    spellings' first two words, so the cost grows neither with the number of spellings nor
    with their lengths. Spellings of more than two words are then compared in full, at the
    places found: up to eight words with the words that a place carries, longer ones with
    the text, joined by key. Texts are evaluated once unless there are such longer ones.

    The dictionary is measured first (two numbers). A small one is broadcast, so that
    words are not shuffled; otherwise both sides are shuffled by words, where a frequent one
    is split by the adaptive skew handling. ``key`` must be unique; under a null key only
    spellings of up to two words and longer than none are found.
    """
    spelled = (
        dictionary.select("skill", tokens(F.col("alias")).alias("_spelling"))
        .filter(F.size("_spelling") > 0)
        .distinct()
        .withColumn("_lead", F.array_join(F.slice("_spelling", 1, LEAD_WORDS), " "))
    )
    letters = F.length(F.array_join("_spelling", " ")) + F.coalesce(F.length("skill"), F.lit(0))
    measured = spelled.agg(
        F.max(F.size("_spelling")).alias("words"), (4 * F.sum(letters) + 100 * F.count(F.lit(1))).alias("bytes")
    ).first()
    longest = measured.words or 0
    hinted = (measured.bytes or 0) <= SMALL_DICTIONARY and not texts.sparkSession.conf.get(
        "spark.sql.autoBroadcastJoinThreshold"
    ).startswith("-")
    tokenised = texts.select(key, F.coalesce(tokens(F.col(text)), F.array()).alias("_words"))
    # One marker per text keeps those without a hit, without reading texts again.
    mark = F.concat(F.lit("\n"), F.pmod(F.xxhash64(key), F.lit(MARKS)).cast("string"))
    marks = texts.sparkSession.range(MARKS).select(
        F.lit(None).cast("string").alias("skill"),
        F.array().cast("array<string>").alias("_spelling"),
        F.concat(F.lit("\n"), F.col("id").cast("string")).alias("_lead"),
    )
    pairs = F.arrays_zip(
        F.col("_words").alias("one"),
        F.slice("_words", F.lit(2), F.size("_words")).alias("next"),
    )
    marked = F.concat(pairs, F.array(F.struct(mark.alias("one"), F.lit(None).cast("string").alias("next"))))
    ahead = F.slice("_words", F.col("_at") + 1, min(longest, WORDS_AT_PLACE))
    places = tokenised.select(key, "_words", F.posexplode(marked).alias("_at", "_pair")).select(
        key,
        "_at",
        *([ahead.alias("_ahead")] if longest > LEAD_WORDS else []),
        F.explode(F.array("_pair.one", F.concat("_pair.one", F.lit(" "), "_pair.next"))).alias("_lead"),
    )
    length = F.size("_spelling")

    def look_up(spellings: DataFrame) -> DataFrame:
        return places.join(F.broadcast(spellings) if hinted else spellings, "_lead")

    found = look_up(spelled.filter(length <= WORDS_AT_PLACE).select("skill", "_spelling", "_lead").unionByName(marks))
    if longest > LEAD_WORDS:
        in_full = F.col(key).isNotNull() & (F.slice("_ahead", F.lit(1), length) == F.col("_spelling"))
        found = found.filter((length <= LEAD_WORDS) | in_full)
    hits = found.select(key, "skill")
    if longest > WORDS_AT_PLACE:
        hits = hits.unionByName(
            look_up(spelled.filter(length > WORDS_AT_PLACE))
            .select(key, "_at", "skill", "_spelling")
            .join(tokenised, key)
            .filter(F.slice("_words", F.col("_at") + 1, length) == F.col("_spelling"))
            .select(key, "skill")
        )
    return hits.groupBy(key).agg(F.sort_array(F.collect_set("skill")).alias("skills"))


def dictionary_problems(dictionary: DataFrame) -> DataFrame:
    """Violations of a dictionary table ``(category, skill, alias)`` as rows.

    A skill belongs to one category, no spelling is blank, and the names of the count
    columns are distinct and free of spaces and ampersands.
    """
    column = F.concat(F.lit("n_"), F.replace(F.replace("category", F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and")))
    per_skill = (
        dictionary.groupBy("skill")
        .agg(F.count_distinct("category").alias("n"), F.count_if(F.col("category").isNull()).alias("z"))
    )
    shared = per_skill.filter("n > 1").select(
        F.lit("skill in several categories").alias("problem"), F.col("skill").alias("subject")
    )
    unmapped = per_skill.filter("z > 0").select(
        F.lit("skill without category").alias("problem"), F.col("skill").alias("subject")
    )
    blank = dictionary.filter(is_blank(F.col("alias"))).select(
        F.lit("blank spelling").alias("problem"), F.col("skill").alias("subject")
    )
    named = dictionary.select("category", column.alias("name")).distinct()
    clash = (
        named.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("name")))
        .filter("_n > 1")
        .select(F.lit("count column not unique").alias("problem"), F.col("category").alias("subject"))
    )
    unsafe = named.filter(~F.col("name").rlike(r"\A[^\s&]+\z")).select(
        F.lit("count column name not safe").alias("problem"), F.col("category").alias("subject")
    )
    return shared.unionByName(unmapped).unionByName(blank).unionByName(clash).unionByName(unsafe)
