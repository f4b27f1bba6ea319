"""Saved searches as a Spark data source, ``searches``, for batches and streams.

Below ``path`` lie folders ``query=<words>`` with pages of one record a line, plain or
compressed. A partition holds pages of one search; a search of more than ``piece_bytes``
has several, and a large plain page is cut at lines, so a search may hold any share of all
records. Pieces that are small beside all records share a partition: the number of tasks
does not grow with the records before partitions are full. Files are listed on the driver,
as Spark lists its own; records are read in tasks.

A page that cannot be read costs one row with ``failure`` and fails nothing else. Rows
before the fault stay. A line that is not UTF-8 is a failure of its own. Empty lines, empty
pages and hidden files (names that begin with ``_`` or ``.``) give nothing.

A stream's offset holds, per search, the time of the newest page taken and the names of
the pages of that very time, so pages of one tick that arrive apart are all read, once
each. A page must appear whole, and not with an earlier time than pages already taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacanta.sources.readers import CORRUPT, flatten_adverts
from vacanta.sources.schema import ADVERT

FORMAT = "searches"
PIECE_BYTES = 64 << 20
BATCH_BYTES = 4 << 20  # lines handed to Spark at once
MANY_TASKS = 2048  # from here on a partition takes several small pieces of a search, up to PIECE_BYTES
TAIL_BYTES = 4 << 10  # read at once beyond a piece, for its last line

RECORDS = "query string, file string, written timestamp, record string, failure string"


def register(spark: SparkSession) -> None:
    """Makes ``spark.read.format("searches")`` and its stream known to the session."""
    spark.dataSource.register(_source())


def _source():
    """Defined here, so that workers get the classes themselves and need no copy of this package."""
    from pyspark.sql.datasource import (
        DataSource,
        DataSourceReader,
        DataSourceStreamReader,
        InputPartition,
    )

    piece_bytes, batch_bytes, tail_bytes, many_tasks = PIECE_BYTES, BATCH_BYTES, TAIL_BYTES, MANY_TASKS
    schema = RECORDS

    class Pieces(InputPartition):
        def __init__(self, query, pieces):
            self.query, self.pieces = query, pieces  # pieces: (file, time in ns, first byte, end)

    class Pages:
        """Listing and reading, alike for batches and streams."""

        def __init__(self, options):
            self.path = options["path"]
            self.most = int(options.get("piece_bytes", piece_bytes))

        def filesystem(self):
            from pyarrow import fs

            if self.path.startswith("file:"):
                return fs.LocalFileSystem(), "/" + self.path[5:].lstrip("/")
            if "://" in self.path:
                return fs.FileSystem.from_uri(self.path)
            return fs.LocalFileSystem(), self.path

        def listed(self):
            """query -> [(time in ns, file, bytes)], oldest first."""
            from urllib.parse import unquote

            from pyarrow import fs

            files, root = self.filesystem()
            found = {}
            for page in files.get_file_info(fs.FileSelector(root, recursive=True)):
                names = page.path[len(root.rstrip("/")) :].strip("/").split("/")
                words = [n[6:] for n in names[:-1] if n.startswith("query=")]
                if page.is_file and page.size and words and not any(n[0] in "_." for n in names):
                    query = unquote(words[-1])
                    found.setdefault(query, []).append((page.mtime_ns, page.path, page.size))
            return {query: sorted(pages) for query, pages in sorted(found.items())}

        def partitions_of(self, listed):
            parts = []
            total = sum(length for pages in listed.values() for *_, length in pages)
            room = max(self.most, min(total // many_tasks, piece_bytes))
            for query, pages in listed.items():
                own, size = [], 0
                for time, file, length in pages:
                    plain = not file.endswith((".gz", ".bz2", ".zst", ".lz4"))
                    step = self.most if plain else length
                    for first in range(0, length, step):
                        end = min(length, first + step)
                        if own and size + end - first > room:
                            parts.append(Pieces(query, own))
                            own, size = [], 0
                        own.append((file, time, first, end if plain else None))
                        size += end - first
                if own:
                    parts.append(Pieces(query, own))
            return parts

        @staticmethod
        def lines(files, file, first, end):
            """Lists of the lines that begin in bytes first to end (None: all) of a page."""
            if end is None:
                source, at = files.open_input_stream(file, compression="detect"), 0
            else:
                source, at = files.open_input_file(file), first
            with source:
                rest = b""
                if first:  # the line that runs into this piece belongs to the one before
                    at = source.seek(first - 1)
                skip = bool(first)
                step, read, tail = batch_bytes, at, tail_bytes
                while True:
                    if end is not None and read < end:
                        step = min(batch_bytes, end - read)
                    elif end is not None:  # the rest of the last line
                        step, tail = tail, min(batch_bytes, 2 * tail)
                    block = source.read(step)
                    read += len(block)
                    text = rest + block
                    cut = text.rfind(b"\n") + 1 if block else len(text)
                    whole, rest = text[:cut], text[cut:]
                    taken = []
                    for line in _at_newlines(whole):
                        begins, at = at, at + len(line)
                        if skip:
                            skip = False
                        elif end is not None and begins >= end:
                            if taken:
                                yield taken
                            return
                        else:
                            taken.append(line)
                    if taken:
                        yield taken
                    if not block or (end is not None and at >= end and not skip):
                        return

        def records(self, part):
            import pyarrow as pa

            kinds = [pa.string(), pa.string(), pa.timestamp("us", "UTC"), pa.string(), pa.string()]
            names = ["query", "file", "written", "record", "failure"]

            def batch(file, time, rows):
                records, failures = zip(*rows)
                same = [part.query] * len(rows), [file] * len(rows), [time // 1000] * len(rows)
                columns = [pa.array(c, k) for c, k in zip((*same, records, failures), kinds)]
                return pa.RecordBatch.from_arrays(columns, names=names)

            if part is None:  # nothing was listed
                return
            files, _ = self.filesystem()
            for file, time, first, end in part.pieces:
                try:
                    for lines in self.lines(files, file, first, end):
                        rows = [_decoded(x) for x in (line.rstrip(b"\r\n") for line in lines) if x.strip()]
                        if rows:
                            yield batch(file, time, rows)
                except (OSError, pa.ArrowInvalid) as fault:
                    yield batch(file, time, [(None, f"{type(fault).__name__}: {fault}")])

    def _at_newlines(text):
        parts = text.split(b"\n")
        return [p + b"\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])

    def _decoded(line):
        try:
            return line.decode(), None
        except UnicodeDecodeError:
            return line.decode(errors="replace"), "not UTF-8"

    class Batch(Pages, DataSourceReader):
        def partitions(self):
            return self.partitions_of(self.listed())

        def read(self, partition):
            return self.records(partition)

    class Stream(Pages, DataSourceStreamReader):
        def initialOffset(self):
            return {}

        def latestOffset(self):
            newest = {}
            for query, pages in self.listed().items():
                last = pages[-1][0]
                newest[query] = [last, [file for time, file, _ in pages if time == last]]
            return newest

        def partitions(self, start, end):
            def upto(offset, query, time, file):
                last, names = offset.get(query, (-1, ()))
                return time < last or (time == last and file in names)

            new = {
                query: [p for p in pages if upto(end, query, *p[:2]) and not upto(start, query, *p[:2])]
                for query, pages in self.listed().items()
            }
            return self.partitions_of(new)

        def read(self, partition):
            return self.records(partition)

    class Searches(DataSource):
        @classmethod
        def name(cls):
            return "searches"

        def schema(self):
            return schema

        def reader(self, schema):
            return Batch(self.options)

        def streamReader(self, schema):
            return Stream(self.options)

    return Searches


def load_searches(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """Every record below ``path`` with its search, file, write time and failure."""
    register(spark)
    source = spark.readStream if streaming else spark.read
    return source.format(FORMAT).options(**options).load(path)


def _parsed(records: DataFrame) -> DataFrame:
    schema = T.StructType([*ADVERT.fields, T.StructField(CORRUPT, T.StringType())])
    return records.withColumn("_advert", F.from_json("record", schema, {"columnNameOfCorruptRecord": CORRUPT}))


def found_postings(records: DataFrame) -> DataFrame:
    """Raw posting rows of the records that are adverts."""
    good = _parsed(records).filter(F.col("failure").isNull() & F.col(f"_advert.{CORRUPT}").isNull())
    adverts = good.select("query", "written", "_advert.*")
    return flatten_adverts(adverts, F.col("query"), F.col("written").cast("string"))


def failed_records(records: DataFrame) -> DataFrame:
    """Pages that could not be read and lines that are no adverts: ``(query, file, record, failure)``."""
    no_json = F.when(F.col(f"_advert.{CORRUPT}").isNotNull(), "not JSON")
    failed = _parsed(records).select("query", "file", "record", F.coalesce("failure", no_json).alias("failure"))
    return failed.filter(F.col("failure").isNotNull())
