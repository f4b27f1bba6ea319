"""Packing token ids into rows of one length, by best-fit decreasing.

Documents are encoded where they are read, and a document longer than a row is cut into
full rows and a rest, so no token is lost. Chunks then move once, to packing groups of a
bounded number of bytes; the number of groups grows with the corpus. Inside a group the
longest chunk comes first and goes to the open row with the least room that still holds
it. Rooms are the leaves of a segment tree over capacities, each inner node counting the
open rows below it, so the best row is found in the logarithm of the row length.

A group wastes at most the half-filled rows at its end, which is why small groups cost
little, and why no task ever holds more than a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacanta.llm.bpe import codec, worker_path

ROW_TOKENS = 4096
GROUP_BYTES = 8 << 20
GROUP_CHUNKS = 64  # neighbouring chunks of a document that stay in one group
MOST_TASKS = 20_000


class RoomTree:
    """Open rows by the room they have left; a segment tree over the rooms 0..size."""

    def __init__(self, size: int):
        self._leaves = 1 << size.bit_length()
        self._count = [0] * (2 * self._leaves)
        self._rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self._rows.setdefault(room, []).append(row)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self._leaves
        while node:
            self._count[node] += by
            node //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes the row with the least room of at least ``need``: (room, row)."""
        node = need + self._leaves
        if not self._count[node]:
            # Up to the first right neighbour with a row below it, then down its left side.
            while node > 1 and (node & 1 or not self._count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node = 2 * node if self._count[2 * node] else 2 * node + 1
        room = node - self._leaves
        row = self._rows[room].pop()
        self._change(room, -1)
        return room, row


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of chunk numbers. Longest chunks first, ties in the order given."""
    tree, rows = RoomTree(size), []
    for chunk in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[chunk])
        if found is None:
            found = size, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(chunk)
        if room > lengths[chunk]:
            tree.add(room - lengths[chunk], row)
    return rows


def packed_rows(
    documents: DataFrame,
    rank_file: str,
    pattern: str,
    pad_id: int,
    row_tokens: int = ROW_TOKENS,
    group_bytes: int = GROUP_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per packed sequence.

    ``pack_group``, ``pack``: which sequence. ``ids``: ``row_tokens`` token ids as packed
    little-endian unsigned integers of 16 bits (32 if ``pad_id`` needs them), padded with
    ``pad_id``; the rows of a group, one after the other, are its id matrix.
    ``segment_ends``: cumulative segment lengths, from 0. ``position_resets``: where
    positions start again at 0, which are the segment starts and the start of the
    padding. ``doc_ids`` and ``chunks``: the document and the number of the chunk of each
    segment; a document's chunks in order are exactly its tokens.

    Null and empty texts have no tokens and no segment. Ids keep their type; null ids stay
    null. Rows are dealt over the groups by id, text and place in the table, and a long
    document's chunks over several groups, so neither repeated rows nor one document make a
    group larger than others. An empty table gives no rows. Other columns are ignored.
    """
    total = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    kind = "<u2" if pad_id < 1 << 16 else "<u4"
    narrow = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.pmod(F.xxhash64(F.struct(doc_id, text), F.monotonically_increasing_id()), F.lit(groups)).alias("pack_group"),
        F.col(text).alias("text"),
    )
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(worker_path(rank_file), pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = []
                for row, (group, content) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)):
                    ids = np.frombuffer(bpe.encode(content or ""), dtype="<u4").astype(kind)
                    for n, at in enumerate(range(0, len(ids), row_tokens)):
                        piece = ids[at : at + row_tokens]
                        rows.append(((group + n // GROUP_CHUNKS) % groups, n, len(piece), piece.tobytes(), row))
                group, n, length, ids, at = zip(*rows) if rows else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group, pa.int64()),
                        part.column(0).take(pa.array(at, pa.int64())),
                        pa.array(n, pa.int32()),
                        pa.array(length, pa.int32()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["pack_group", "doc_id", "chunk", "length", "ids"],
                )

    chunks = narrow.mapInArrow(chunked, f"pack_group long, doc_id {id_type}, chunk int, length int, ids binary")

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("doc_id", "chunk", "ids")])
        lengths, ids, numbers = (group[c].to_pylist() for c in ("length", "ids", "chunk"))
        rows = best_fit_decreasing(lengths, row_tokens)
        packed, every, resets = [], [], []
        for row in rows:
            ends = np.concatenate([[0], np.cumsum([lengths[i] for i in row])]).tolist()
            padding = np.full(row_tokens - ends[-1], pad_id, dtype=kind).tobytes()
            packed.append(b"".join(ids[i] for i in row) + padding)
            every.append(ends)
            resets.append(ends[:-1] + ([ends[-1]] if ends[-1] < row_tokens else []))
        doc_ids = group["doc_id"].combine_chunks().take(pa.array([i for row in rows for i in row], pa.int64()))
        starts = pa.array(np.cumsum([0, *map(len, rows)]), pa.int32())
        ints = pa.list_(pa.int32())
        return pa.table(
            {
                "pack_group": pa.array([group["pack_group"][0].as_py()] * len(rows), pa.int32()),
                "pack": pa.array(range(len(rows)), pa.int32()),
                "ids": pa.array(packed, pa.binary()),
                "segment_ends": pa.array(every, ints),
                "position_resets": pa.array(resets, ints),
                "doc_ids": pa.ListArray.from_arrays(starts, doc_ids),
                "chunks": pa.array([[numbers[i] for i in row] for row in rows], ints),
            }
        )

    # A task takes few groups, however many there are.
    tasks = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(groups, MOST_TASKS))
    return chunks.repartition(tasks, "pack_group").groupBy("pack_group").applyInArrow(
        pack,
        "pack_group int, pack int, ids binary, segment_ends array<int>, "
        f"position_resets array<int>, doc_ids array<{id_type}>, chunks array<int>",
    )
