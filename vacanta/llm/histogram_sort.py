"""Sharding by histogram sort: exact byte counts below probes, then one exchange.

Rows are ordered by keys of 60 bits: of the text, of the id, of the row. ``splitters`` finds, for every border between
shards, the key at which the bytes counted from the smallest key reach the border's share.
A round counts the bytes of 256 cells of each interval that still holds a border, over
all partitions, and keeps only the cell the border falls into. A border is done when its
cell holds one key. 8 rounds a key suffice for any input, three or four in all for most; a
round moves 256 rows per open interval to the driver, however large the table is.

Only then rows move, once, by (shard, cell): a cell is a range of the first key, and a
range of the second key as well where one first key holds many rows (copies of a text),
and of the third where both do (repeated rows). Slots are numbered inside cells, on top of
the number of rows in earlier cells.

All of it is DataFrame expressions; text is read once, to derive narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacanta.llm.identity import free_name

KEY_BITS = 60
PROBES = 256
CELL_BITS = 12
# A cell with more than this share of the rows is cut by the next key. So at most
# HEAVY_SHARE cells are cut by each key, whatever the table's size.
HEAVY_SHARE = 1024
HEAVY_ROWS = 1000
KEYS = ("k1", "k2", "k3")


def hash_key(value: Column) -> Column:
    """The first 60 bits of the MD5 digest of a value's text; null counts as empty."""
    digits = F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, KEY_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def row_key() -> Column:
    """A key of the row itself; write it before it is read twice."""
    return hash_key(F.monotonically_increasing_id())


def splitters(keyed: DataFrame, shards: int, size: str = "size", keys: tuple[str, ...] = KEYS) -> list[tuple[int, ...]]:
    """The last keys of every shard but the last, ascending.

    Shard ``s`` holds the rows that ``floor(bytes before the keys * shards / total)`` puts
    there. Fewer keys than shards leave shards empty; an empty table has no splitters.
    """
    total = keyed.agg(F.sum(size)).first()[0]
    if not total:
        return []
    done: dict[int, tuple[int, ...]] = {}
    # By border: the keys settled so far, the open interval of the next, the bytes below it.
    open_at: dict[int, tuple[tuple[int, ...], int, int, int]] = {i: ((), 0, 1 << KEY_BITS, 0) for i in range(1, shards)}
    while open_at:
        spans = sorted({v[:3] for v in open_at.values()})
        cell = F.lit(None).cast("int")
        for n, (settled, low, high) in enumerate(spans):
            key = F.col(keys[len(settled)])
            inside = (key >= low) & (key < high)
            for name, value in zip(keys, settled, strict=False):
                inside = inside & (F.col(name) == value)
            width = -(-(high - low) // PROBES)
            probe = F.lit(n * PROBES) + F.call_function("div", key - low, F.lit(width))
            cell = F.when(inside, probe.cast("int")).otherwise(cell)
        ends = [f(k).alias(f"{name}_{k}") for k in keys for name, f in (("low", F.min), ("high", F.max))]
        counts = (
            keyed.select(cell.alias("cell"), size, *keys)
            .filter(F.col("cell").isNotNull())
            .groupBy("cell")
            .agg(F.sum(size).alias("bytes"), *ends)
            .collect()
        )
        by_cell = sorted(counts, key=lambda r: r.cell)
        for border, (settled, low, high, below) in list(open_at.items()):
            n = spans.index((settled, low, high))
            for r in by_cell:
                if r.cell // PROBES != n:
                    continue
                if (below + r.bytes) * shards >= border * total:
                    break
                below += r.bytes
            # The first key that the cell has more than one value of is open.
            reached: list[int] = []
            while len(reached) < len(keys) and r[f"low_{keys[len(reached)]}"] == r[f"high_{keys[len(reached)]}"]:
                reached.append(r[f"low_{keys[len(reached)]}"])
            if len(reached) == len(keys):
                done[border] = tuple(reached)
                del open_at[border]
            else:
                key = keys[len(reached)]
                open_at[border] = (tuple(reached), r[f"low_{key}"], r[f"high_{key}"] + 1, below)
    return [done[i] for i in range(1, shards)]


def shard_of(last_keys: list[tuple[int, ...]], keys: tuple[str, ...] = KEYS) -> Column:
    """The number of splitters below a row's keys, by a balanced tree of comparisons."""

    def after(last: tuple[int, ...]) -> Column:
        above = F.lit(False)
        for name, value in reversed(list(zip(keys, last, strict=True))):
            above = (F.col(name) > value) | ((F.col(name) == value) & above)
        return above

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(after(last_keys[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(last_keys))


def histogram_shards(keyed: DataFrame, shards: int, size: str = "size", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The rows of ``keyed`` with ``shard`` and ``slot``, sorted by keys over the shards.

    ``keyed`` is read once per round, so give it written rows, not a plan over texts. Keys
    are longs of 60 bits, not null. Sizes of the shards differ from the mean by less than
    the rows that agree in all keys; with a key of the row itself (``row_key``) that is one
    row, however often rows repeat. Rows that agree in all keys stay in one shard; slots are
    gapless from 0. An empty table gives no rows. Columns named shard and slot are replaced.
    """
    start, n, before, at = (free_name(keyed, x) for x in ("cell", "cell_rows", "cell_before", "cell_at"))
    placed = keyed.withColumn("shard", shard_of(splitters(keyed, shards, size, keys), keys))
    # The cell: the first bits of the first key, and of the next ones where a cell is heavy.
    cut = [F.shiftright(k, KEY_BITS - CELL_BITS).cast("int") for k in keys]
    parts = [cut[0]]
    rows = None
    for k in range(1, len(keys)):
        counts = placed.groupBy(F.array(*parts).alias(start)).agg(F.count("*").alias(n))
        rows = placed.count() if rows is None else rows
        limit = max(HEAVY_ROWS, rows / HEAVY_SHARE)
        heavy = [tuple(r[start]) for r in counts.filter(F.col(n) > limit).collect()]  # at most HEAVY_SHARE
        if heavy:
            same = F.array(*parts).isin([F.array(*map(F.lit, h)) for h in heavy])
            parts.append(F.when(same, cut[k]).otherwise(0))
        else:
            parts.append(F.lit(0))
    placed = placed.withColumn(start, F.struct(*(p.alias(f"c{i}") for i, p in enumerate(parts))))
    earlier = Window.partitionBy("shard").orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    counted = (
        placed.groupBy("shard", start)
        .agg(F.count("*").alias(n))
        .select("shard", start, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    )
    inside = Window.partitionBy("shard", start).orderBy(*keys)
    return (
        placed.withColumn(at, F.row_number().over(inside))
        .join(counted, ["shard", start])
        .withColumn("slot", F.col(before) + F.col(at) - 1)
        .drop(start, at, before)
    )
