"""Secret scans over every version of every path, through an incremental blob ledger.

A version's content is addressed by its SHA-256. The ledger is a table of scans, one row
per blob and run: which rules (with their versions) looked at the blob, and what they
found. A run scans only pairs of blob and rule version that no row holds, appends a row
per blob it scanned, and joins all findings of the current rule versions back to every
path. A new version of one rule makes only that rule run again; a new copy of a known
blob costs nothing; findings of withdrawn rule versions stay in the ledger, unused.

Blobs are unique before text moves: each task keeps one copy per content, so a blob that
a third of all paths share moves once per task. Appending writes a folder of its own, and
a run that dies leaves at most a folder without ``_SUCCESS``, which no later run reads.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches that pass ``accept``."""

    kind: str
    version: int
    pattern: re.Pattern
    accept: Callable[[re.Match], bool] = lambda match: True

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Start and end (exclusive) in code points."""
        return [m.span() for m in self.pattern.finditer(text) if self.accept(m)]


def _rule(kind: str, pattern: str, accept=lambda match: True, flags: int = 0) -> Rule:
    return Rule(kind, 1, re.compile(pattern, re.ASCII | flags), accept)


# Three base kinds, then those this library adds; the order settles equal starts.
RULES = (
    _rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
        re.IGNORECASE,
    ),
    _rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    _rule("hex", r"[0-9a-f]{24,}"),  # equal to maximal runs of 24 and more
    _rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    _rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    _rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    _rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    _rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    _rule("login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)
BASE = ("assign", "access", "hex")

_SPANS = "array<struct<kind:string,start:int,end:int>>"


def seen_scans(spark, ledger: str) -> DataFrame | None:
    """(blob, rules, found) of all finished runs, or None before the first."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return None
    runs = [
        str(r.getPath())
        for r in files.listStatus(root)
        if files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(r.getPath(), "_SUCCESS"))
    ]
    return spark.read.parquet(*runs) if runs else None


def scan_versions(
    versions: DataFrame,
    ledger: str,
    rules: tuple[Rule, ...] = RULES,
    path: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """One row per version: the ``path`` columns, ``blob`` and ``spans``.

    ``ledger`` is a folder in the cluster's shared storage that grows with each run.
    ``spans`` is an array of (kind, start, end), by start and then by the order of
    ``rules``. A null text is the empty blob. Repeated rows and null paths give a row
    each; without versions there is no row and the ledger gets no blob. Columns outside
    ``path`` and ``text`` are ignored.
    """
    spark = versions.sparkSession
    current = [r.key for r in rules]
    content = F.coalesce(F.col(text), F.lit(""))
    paths = versions.select(*(F.col(c).alias(f"_p_{c}") for c in path), F.sha2(content, 256).alias("blob"))
    blobs = (
        versions.select(F.sha2(content, 256).alias("blob"), content.alias("text"))
        .groupBy("blob")
        .agg(F.first("text").alias("text"))
    )
    before = seen_scans(spark, ledger)
    every = F.array(*map(F.lit, current))
    if before is None:
        unseen = blobs.withColumn("rules", every)
    else:
        done = before.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
        missing = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
        unseen = (
            blobs.join(done, "blob", "left").select("blob", "text", missing.alias("rules")).filter(F.size("rules") > 0)
        )
    by_key = {r.key: r for r in rules}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = []
            for content, keys in zip(batch.column(1), batch.column(2), strict=True):
                content = content.as_py()
                found.append(
                    [
                        {"kind": key, "start": start, "end": end}
                        for key in keys.as_py()
                        for start, end in by_key[key].spans(content)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, kind)], names=["blob", "rules", "found"]
            )

    unseen.mapInArrow(scan, f"blob string, rules array<string>, found {_SPANS}").write.parquet(
        f"{ledger.rstrip('/')}/run-{uuid.uuid4().hex}"
    )
    order = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))))
    kinds = F.create_map(*(x for r in rules for x in (F.lit(r.key), F.lit(r.kind))))
    findings = (
        seen_scans(spark, ledger)
        .filter(F.size("found") > 0)
        .select("blob", F.explode("found").alias("f"))
        .filter(F.col("f.kind").isin(current))
        .groupBy("blob")
        .agg(
            F.array_sort(
                F.collect_set(F.struct(F.col("f.start").alias("start"), order[F.col("f.kind")].alias("n"), F.col("f.end").alias("end"), kinds[F.col("f.kind")].alias("kind")))
            ).alias("spans")
        )
    )
    # Written, so that a blob with very many paths can be split in the join.
    found_at = scratch_path(spark, "secret-findings")
    findings.write.parquet(found_at)
    findings = spark.read.parquet(found_at)
    return paths.join(findings, "blob", "left").select(
        *(F.col(f"_p_{c}").alias(c) for c in path),
        "blob",
        F.coalesce(
            F.transform("spans", lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end"))),
            F.array().cast(_SPANS),
        ).alias("spans"),
    )
