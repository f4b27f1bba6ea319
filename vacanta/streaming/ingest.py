"""New advert files into the posting store as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vacanta.operators.processing import process_postings
from vacanta.plans.refresh import compact, write_batch
from vacanta.sources.commits import committed, writer_id

MOST_BATCHES = 100


def ingest(raw_stream: DataFrame, store: str, checkpoint: str, most_batches: int = MOST_BATCHES) -> StreamingQuery:
    """Start a query that stores what is available and then ends.

    Each micro-batch becomes one batch of the store, named after the checkpoint's writer
    id and the micro-batch number: one that runs again after a failure finds its own
    commit, and no other writer or checkpoint can have the name. Work per micro-batch
    depends on its own rows only, but that a store of more than ``most_batches`` batches is
    compacted, so that plans stay small; read the result with
    :func:`vacanta.plans.refresh.current`.
    """
    spark = raw_stream.sparkSession
    writer = writer_id(spark, checkpoint)

    def store_batch(rows: DataFrame, number: int) -> None:
        write_batch(rows, store, f"{writer}-{number:012d}")
        if len(committed(spark, store)) > most_batches:
            compact(spark, store, rows.schema)

    return (
        process_postings(raw_stream)
        .writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
