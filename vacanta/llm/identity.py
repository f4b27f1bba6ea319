"""Taking documents away by identity: the id and the digest of the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identities of about 40 bytes; more than these are joined by a shuffle.
BROADCAST_ROWS = 500_000


def text_md5(text: str = "text") -> Column:
    """The digest of a text as bytes; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``frame`` is called so."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _key(doc_id: Column, digest: Column) -> Column:
    null = doc_id.isNull()
    return F.struct(null.alias("none"), F.coalesce(doc_id.cast("string"), F.lit("")).alias("id"), digest.alias("digest"))


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def without(documents: DataFrame, taken: DataFrame) -> DataFrame:
    """The documents whose (doc_id, text_md5) is not in ``taken``; null ids are equal."""
    name = free_name(documents, "document_key")
    keys = taken.select(_key(F.col("doc_id"), F.col("text_md5")).alias(name)).distinct()
    rows = documents.withColumn(name, _key(F.col("doc_id"), text_md5()))
    return rows.join(_small(keys), name, "left_anti").drop(name)


def once(documents: DataFrame, again: DataFrame) -> DataFrame:
    """One row of each (doc_id, text_md5) in ``again``."""
    name = free_name(documents, "document_key")
    keys = again.select(_key(F.col("doc_id"), F.col("text_md5")).alias(name)).distinct()
    rows = documents.withColumn(name, _key(F.col("doc_id"), text_md5()))
    return rows.join(_small(keys), name, "left_semi").dropDuplicates([name]).drop(name)
