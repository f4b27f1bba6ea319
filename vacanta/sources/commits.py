"""Committed batches in a folder: what a writer finished is seen whole, or not at all.

``rows/<name>/`` holds the Parquet files of a batch, each row with the order and the name
of the batch it came with; ``commits/<order>_<rows>_<name>`` is created when they are
complete. Readers list the commits and open only those batches. Names never collide: a
writer brings its own id, so nobody overwrites what someone else stored, and two writers
need no lock.

A batch that replaces others lists their names in its commit file. Of two that replace
the same batch the one of earlier order counts, and the other is lost: readers take no row
of it, and what only it replaced is read as before. So every row is read once, whatever
writers do at the same time; a lost batch only cost its own work.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER, BATCH = "batch_order", "batch"


@dataclass(frozen=True, order=True)
class Batch:
    """A committed batch; batches sort from the earliest commit to the latest."""

    order: int
    name: str
    rows: int = 0
    replaces: tuple[str, ...] = ()


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _create(spark: SparkSession, path: str, text: str) -> None:
    """A new file that appears under its name only when its text is complete."""
    files, target = _files(spark, path)
    _, aside = _files(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(aside, target):
        files.delete(aside, False)


def _text(spark: SparkSession, path) -> str:
    files, _ = _files(spark, str(path))
    stream = files.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _listed(spark: SparkSession, store: str) -> list[Batch]:
    files, folder = _files(spark, f"{store}/commits")
    if not files.exists(folder):
        return []
    found = []
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if not name.startswith(("_", ".")):
            order, rows, batch = name.split("_", 2)
            names = _text(spark, entry.getPath()).split() if entry.getLen() else []
            found.append(Batch(int(order), batch, int(rows), tuple(names)))
    return sorted(found)


def _passed(batches: list[Batch]) -> set[str]:
    """Names of the batches that are replaced, and of those that lost to another one."""
    replaced, lost = set(), set()
    for batch in batches:
        if any(name in replaced or name in lost for name in batch.replaces):
            lost.add(batch.name)
        else:
            replaced.update(batch.replaces)
    return replaced | lost


def committed(spark: SparkSession, store: str) -> list[Batch]:
    """Valid batches, earliest first. Only folder entries and lists of names are read."""
    batches = _listed(spark, store)
    passed = _passed(batches)
    return [b for b in batches if b.name not in passed]


def new_name() -> str:
    return uuid.uuid4().hex


def commit(
    rows: DataFrame,
    store: str,
    name: str,
    order: int | None = None,
    replaces: tuple[str, ...] = (),
    settle: Callable[[DataFrame], DataFrame | None] = lambda written: None,
) -> None:
    """Store rows as batch ``name``. Does nothing if that batch is committed already.

    ``settle`` sees the written rows before the commit, and may give others to store instead.
    Rows that have an order and a batch keep them. A try that died left no commit; its
    files are replaced.
    """
    spark = rows.sparkSession
    if any(name == batch.name for batch in _listed(spark, store)):
        return
    order = time.time_ns() if order is None else order
    marks = {n: v for n, v in ((ORDER, F.lit(order)), (BATCH, F.lit(name))) if n not in rows.columns}
    path = f"{store}/rows/{name}"
    marked = rows.withColumns(marks)
    marked.write.mode("overwrite").parquet(path)
    settled = settle(spark.read.schema(marked.schema).parquet(path))
    if settled is not None:
        settled.write.mode("overwrite").parquet(f"{path}-settled")
        files, target = _files(spark, path)
        files.delete(target, True)
        if not files.rename(_files(spark, f"{path}-settled")[1], target):
            raise OSError(f"cannot rename {path}-settled")
    n = spark.read.parquet(path).count()  # from the files' footers
    files, folder = _files(spark, f"{store}/commits")
    files.mkdirs(folder)
    _create(spark, f"{store}/commits/{order:020d}_{n}_{name}", "\n".join(replaces))


def read(
    spark: SparkSession, store: str, schema: T.StructType, batches: list[Batch] | None = None
) -> DataFrame:
    """Rows of the batches (default: all committed), with their order and name."""
    batches = committed(spark, store) if batches is None else batches
    full = T.StructType(
        [*schema.fields, T.StructField(ORDER, T.LongType()), T.StructField(BATCH, T.StringType())]
    )
    if not batches:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(*(f"{store}/rows/{b.name}" for b in batches))


def vacuum(spark: SparkSession, store: str, hours: float = 24.0) -> list[str]:
    """Delete replaced and lost batches whose successor is older than ``hours``; their names.

    The time is for readers that listed them before, and for writers that are still about to
    replace some of the same batches.
    """
    batches = _listed(spark, store)
    passed, limit = _passed(batches), time.time_ns() - int(hours * 3.6e12)
    by = {name: b.order for b in reversed(batches) if b.name not in passed for name in b.replaces}
    # A batch that a passed one replaced goes with it.
    for batch in reversed(batches):
        if batch.name in by:
            by |= {name: by[batch.name] for name in batch.replaces if name not in by}
    gone = [b for b in batches if b.name in passed and by.get(b.name, b.order) < limit]
    for batch in gone:
        for path in (f"commits/{batch.order:020d}_{batch.rows}_{batch.name}", f"rows/{batch.name}"):
            files, target = _files(spark, f"{store}/{path}")
            files.delete(target, True)
    return [b.name for b in gone]


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """The id kept beside a streaming checkpoint; a new checkpoint is a new writer."""
    path = f"{checkpoint.rstrip('/')}-writer/id"
    files, target = _files(spark, path)
    if not files.exists(target):
        files.mkdirs(target.getParent())
        _create(spark, path, uuid.uuid4().hex)
    return _text(spark, target).strip()
