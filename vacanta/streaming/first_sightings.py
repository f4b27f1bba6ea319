"""First sightings kept in the state of a stream: the earliest per id, changes come out.

The state of an id holds its earliest sighting so far. A row that is earlier takes it back
and puts itself in its place, so the stream of changes (+1 and -1) adds up to the first
sightings at any time, whatever the order of arrival, and no stored row is read again.
Rows without an id are first sightings each and pass by the state.

The state lies in the state store of the stream (RocksDB, checkpointed). Ids are dealt by
hash over ``BUCKETS`` values, each the sightings of its ids as one Arrow batch: a call
into Python and its few requests to the state store cost about a millisecond, so they are
made per bucket and not per id. A micro-batch reads and writes the buckets of its own ids. A
task reduces its rows to the earliest per id before they move, so an id with a third of all
rows moves one row per Arrow batch. A store that has sightings already gives a new
checkpoint its first state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from vacanta.functions.values import timestamp_column
from vacanta.session import use_value_state
from vacanta.sources import commits

NEVER = (1 << 63) - 1  # an unreadable time comes last
BUCKETS = 1 << 12  # a checkpoint holds for this number only
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

SIGHTING = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("seen", T.LongType()),
        T.StructField("tie", T.LongType()),
        T.StructField("posting", T.StringType()),
    ]
)
DEALT = T.StructType([T.StructField("bucket", T.LongType()), *SIGHTING.fields])
CHANGES = T.StructType([*SIGHTING.fields, T.StructField("change", T.LongType())])


def _sighted(postings: DataFrame, time: str, tie: Column | None) -> DataFrame:
    """``SIGHTING`` of each row: what decides, and the whole row as JSON."""
    content = [c for c in postings.columns if c != "id"]
    return postings.select(
        F.col("id").cast("string").alias("id"),
        F.coalesce(F.unix_micros(timestamp_column(postings, time)), F.lit(NEVER)).alias("seen"),
        (F.xxhash64(*content) if tie is None else F.coalesce(tie.cast("long"), F.lit(NEVER))).alias("tie"),
        F.to_json(F.struct(*postings.columns), _TIMES).alias("posting"),
    )


def _bucket() -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).alias("bucket")


def _processor() -> StatefulProcessor:
    """Defined here, so that workers get the class itself and need no copy of this package."""
    columns = CHANGES.fieldNames()
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    schema = pa.schema(list(zip(columns, kinds)))

    class Earliest(StatefulProcessor):
        def init(self, handle) -> None:
            self._packed = handle.getValueState("sightings", "packed binary")

        def _sightings(self) -> dict[str, tuple]:
            """id -> (seen, tie, posting) of this bucket."""
            packed = self._packed.get()
            if packed is None:
                return {}
            with pa.ipc.open_stream(packed[0]) as stream:
                known, *best = (c.to_pylist() for c in stream.read_all().columns)
            return dict(zip(known, zip(*best)))

        def _keep(self, best: dict[str, tuple]) -> None:
            values = zip(*((key, *sighting) for key, sighting in best.items()))
            batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], schema=schema)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as stream:
                stream.write_batch(batch)
            self._packed.update((sink.getvalue().to_pybytes(),))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            best, before = self._sightings(), {}
            for batch in rows:
                for name, *found in zip(*(batch[c].tolist() for c in columns[:4])):
                    known = best.get(name)
                    if known is None or tuple(found[:2]) < known[:2]:
                        before.setdefault(name, known)
                        best[name] = tuple(found)
            if before:
                self._keep(best)
                taken = [(name, *known, -1) for name, known in before.items() if known is not None]
                yield pd.DataFrame([*taken, *((name, *best[name], 1) for name in before)], columns=columns)

        def handleInitialState(self, key, initialState, timerValues) -> None:
            best = self._sightings()
            for name, *found in zip(*(initialState[c].tolist() for c in columns[:4])):
                best[name] = tuple(found)
            self._keep(best)

        def close(self) -> None:
            pass

    return Earliest()


def sighting_changes(
    postings: DataFrame, known: DataFrame | None, time: str = "collected_at", tie: Column | None = None
) -> DataFrame:
    """The stream of ``CHANGES`` to the first sightings of a stream of postings.

    Times decide, then ``tie`` (default: a hash of the other columns): the smaller one is
    first, whichever came first. ``known``, if there is any, has one ``SIGHTING`` per id for the
    first micro-batch of a checkpoint.
    """
    rows = _sighted(postings, time, tie)

    def earliest_in_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not batch["id"].is_unique:
                batch = batch.sort_values(["seen", "tie"], kind="stable").drop_duplicates("id")
            yield batch

    first = None if known is None else known.select(_bucket(), *SIGHTING.names).groupBy("bucket")
    changed = (
        rows.filter("id IS NOT NULL")
        .select(_bucket(), *SIGHTING.names)
        .mapInPandas(earliest_in_task, DEALT)
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=_processor(),
            outputStructType=CHANGES,
            outputMode="Append",
            timeMode="None",
            initialState=first,
        )
    )
    return changed.unionByName(rows.filter("id IS NULL").withColumn("change", F.lit(1).cast("long")))


def standing(changes: DataFrame) -> DataFrame:
    """``SIGHTING`` of what changes add up to; a row without id as often as it came."""
    kept = changes.groupBy("id", "seen", "tie", "posting").agg(F.sum("change").alias("n")).filter("n > 0")
    # Equal rows without id are one row above; ids have one each.
    return kept.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n", "copy")


def _unpacked(sightings: DataFrame, schema: T.StructType) -> DataFrame:
    return sightings.withColumn("posting", F.from_json("posting", schema, _TIMES))


def is_new(spark: SparkSession, checkpoint: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/offsets")
    return not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def keep_first_sightings(
    postings: DataFrame,
    store: str,
    checkpoint: str,
    tie: Column | None = None,
    after: Callable[[DataFrame, str], Any] | None = None,
) -> StreamingQuery:
    """Start a query that stores the changes of what is available and then ends.

    A micro-batch becomes one committed batch of changes and reads nothing stored; one
    that runs again finds its commit. ``after`` gets the batch's changes, with the posting's
    columns beside ``change``, and its name. The id column is ``id``, the time
    ``collected_at``. One query at a time writes a store.
    """
    spark = use_value_state(postings.sparkSession)
    known = None
    if is_new(spark, checkpoint) and commits.committed(spark, store):
        known = standing(commits.read(spark, store, CHANGES).filter("id IS NOT NULL"))
    writer = commits.writer_id(spark, checkpoint)
    schema = postings.schema

    def store_batch(rows: DataFrame, number: int) -> None:
        name = f"{writer}-{number:012d}"
        commits.commit(rows, store, name)
        if after is not None:
            mine = [b for b in commits.committed(spark, store) if b.name == name]
            after(_unpacked(commits.read(spark, store, CHANGES, mine), schema).select("posting.*", "change"), name)

    return (
        sighting_changes(postings, known, tie=tie)
        .writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_sightings(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """The first sightings as of the last micro-batch, in the columns of ``schema``."""
    return _unpacked(standing(commits.read(spark, store, CHANGES)), schema).select("posting.*")
