"""Grouping of spelling variants by a bit-sliced position index.

The vocabulary are the runs of letters that are long and frequent enough. Two words are
near if they differ by one inserted, deleted or replaced code point. Near words share all
but one window of their letters, so words meet in blocks of equal length and equal letters
outside a window: a word of ``m`` letters stands in the blocks of its two halves, and among
the longer words in those of ``m - 1`` letters.

Within a block an index holds, for each (position, letter), the set of words that have the
letter there, as bits. All words of a block read it at once: while their letters are taken
one by one, the words that agree so far without an error, with a replaced letter, and with
an additional letter (positions shifted by one) are three sets of bits, each made of those
before by a few operations on whole machine words. Only counts and the best near word
of a word leave a block, never pairs.

Blocks are counted before anything is gathered. One of more than ``LIMIT`` words, or of a
window of more than ``WINDOW`` letters, is not read but dealt anew by the halves of its
window; a window of one letter holds no more words than there are letters (and pairs of
letters). So a common beginning is no hot group, whatever its share, and long words
cost in proportion to their length wherever nothing else begins or ends like them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacanta.session import scratch_path

LEAST_LETTERS = 7
LEAST_COUNT = 2
STEP = 10  # a form is at least so many times as frequent
DROPPED = 31  # one in so many runs loses a letter
LIMIT = 8_192
WINDOW = 48
AT_ONCE = 1_024  # words of small blocks that are read together
BROADCAST_ROWS = 100_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def vocabulary(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``LEAST_LETTERS`` letters and ``LEAST_COUNT`` occurrences.

    Runs of ``[A-Za-z\\u00C0-\\u00FF]`` are taken whole, A-Z lower-cased. With h the CRC-32 of
    ``<doc_id>:<run>``, a run whose h is divisible by ``DROPPED`` loses letter h mod its
    length. A null text has no runs, a null id is written as nothing. Rows repeat as often
    as they are given. Counting starts before the shuffle, so a frequent word moves one row
    per task.
    """
    runs = documents.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}"), F.lit(0))).alias("run"),
    ).select("id", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    marked = runs.select(
        "run",
        F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"),
        F.length("run").alias("letters"),
    )
    at = (F.col("h") % F.col("letters")).cast("int")
    shortened = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("letters")))
    words = marked.select(F.when(F.col("h") % DROPPED == 0, shortened).otherwise(F.col("run")).alias("word"))
    return (
        words.filter(F.length("word") >= LEAST_LETTERS)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= LEAST_COUNT)
    )


def _blocks(words: DataFrame) -> DataFrame:
    """Each word in the blocks of the halves of its own length and of one letter less.

    ``m`` letters of the shorter words, ``head`` and ``tail`` that all words of the block
    share, ``part`` between them: one letter longer for the longer words.
    """
    length = F.length("word")

    def placed(m: Column, low: Column, high: Column) -> Column:
        return F.struct(m.alias("m"), low.alias("low"), high.alias("high"))

    def halves(m: Column) -> list[Column]:
        middle = (m / 2).cast("int")
        return [placed(m, F.lit(0), middle), placed(m, middle, m)]

    both = F.array(*halves(length), *halves(length - 1))
    at = F.explode(F.filter(both, lambda x: x.m >= LEAST_LETTERS)).alias("at")
    dealt = words.select("word", "n", at)
    return dealt.select(*_cut(F.col("word"), F.col("at.m"), F.col("at.low"), F.col("at.high")), "n")


def _cut(word: Column, m: Column, low: Column, high: Column) -> list[Column]:
    longer = F.length(word) - m
    return [
        m.alias("m"),
        F.substring(word, F.lit(1), low).alias("head"),
        F.substring(word, high + longer + 1, F.length(word)).alias("tail"),
        F.substring(word, low + 1, high - low + longer).alias("part"),
    ]


def _halved(blocks: DataFrame) -> DataFrame:
    """The same words in the blocks of the halves of their windows."""
    low = F.length("head")
    high = F.col("m") - F.length("tail")
    middle = ((low + high) / 2).cast("int")
    at = F.explode(F.array(F.struct(low.alias("low"), middle.alias("high")), F.struct(middle.alias("low"), high.alias("high"))))
    dealt = blocks.select(F.concat("head", "part", "tail").alias("word"), "m", "n", at.alias("at"))
    return dealt.select(*_cut(F.col("word"), F.col("m"), F.col("at.low"), F.col("at.high")), "n")


def near_in_block(
    parts: list[str], blocks: np.ndarray, asking: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs (i, j) of parts of one block, and whether j has a letter more than i.

    Part j is part i, one of the ``asking``, with one letter replaced or added. Numbers in
    ``blocks`` tell which parts may meet, from 0 without gaps.
    """
    n = len(parts)
    lengths = np.array([len(p) for p in parts])
    width = int(lengths.max())
    codes = np.zeros((n, width + 2), dtype=np.int64)
    flat = np.frombuffer("".join(parts).encode("utf-32-le"), dtype="<u4")
    letters, numbered = np.unique(flat, return_inverse=True)
    starts = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(n), lengths)
    codes[row, np.arange(len(flat)) - starts[row]] = numbered + 1

    def bits(members: np.ndarray) -> np.ndarray:
        """Sets along the last axis as bits of whole machine words."""
        padded = np.zeros((*members.shape[:-1], -(-n // 64) * 64), dtype=bool)
        padded[..., :n] = members
        return np.packbits(padded, axis=-1, bitorder="little").view("<u8")

    index = np.stack([bits(codes[:, p] == np.arange(len(letters) + 1)[:, None]) for p in range(width + 2)])
    together = bits(blocks == np.arange(int(blocks.max()) + 1)[:, None])
    of_length = {k: bits(lengths == k) for k in range(width + 2)}
    found: list[tuple[np.ndarray, np.ndarray, bool]] = [(np.zeros(0, int), np.zeros(0, int), False)]
    for size in np.unique(lengths[asking]):
        for begin in range(0, n, AT_ONCE):
            some = slice(begin, begin + AT_ONCE)
            asked = begin + np.flatnonzero((lengths[some] == size) & asking[some])
            if not len(asked):
                continue
            same = together[blocks[asked]]
            replaced = np.zeros_like(same)
            added = np.zeros_like(same)
            for p in range(size):
                here, shifted = index[p, codes[asked, p]], index[p + 1, codes[asked, p]]
                added = (added | same) & shifted
                replaced = (replaced & here) | (same & ~here)
                same = same & here
            added |= same
            for hits, longer in ((replaced & of_length[size], False), (added & of_length[size + 1], True)):
                i, j = np.nonzero(np.unpackbits(hits.view(np.uint8), axis=-1, bitorder="little"))
                found.append((asked[i], j, longer))
    first = np.concatenate([f[0] for f in found])
    second = np.concatenate([f[1] for f in found])
    return first, second, np.repeat([f[2] for f in found], [len(f[0]) for f in found])


def _added_here(short: str, long: str, head: str, last: bool) -> bool:
    """Whether the first place where a letter can be added to ``short`` lies in this window.

    A letter added to a run of its like could stand anywhere in the run; the pair counts in
    the window of the first of these places only.
    """
    at = len(short)
    while at and short[at - 1] == long[at]:
        at -= 1
    if at == 0:
        return not head or head[-1] != long[0]
    return at < len(short) or last


def _summed(m: int, pending: list[tuple[str, str, list[tuple[str, int]]]]) -> list[tuple[str, int, int, str]]:
    """(word, near words, count of the best, best) of the words of some blocks.

    Words of ``m`` letters ask: for like ones of their length, and for longer ones, which
    are near to them in turn.
    """
    parts = [part for _, _, block in pending for part, _ in block]
    asking = np.array([len(h) + len(p) + len(t) == m for h, t, block in pending for p, _ in block])
    sizes = [len(block) for _, _, block in pending]
    blocks = np.repeat(np.arange(len(pending)), sizes)
    counts = [n for _, _, block in pending for _, n in block]
    near: dict[int, list[int]] = {}
    for i, j, longer in zip(*(x.tolist() for x in near_in_block(parts, blocks, asking)), strict=True):
        if longer:
            head, tail, _ = pending[blocks[i]]
            if not _added_here(parts[i], parts[j], head, not tail):
                continue
            near.setdefault(j, []).append(i)
        near.setdefault(i, []).append(j)

    def whole(i: int) -> str:
        head, tail, _ = pending[blocks[i]]
        return head + parts[i] + tail

    rows = []
    for i, others in near.items():
        most = max(counts[j] for j in others)
        rows.append((whole(i), len(others), most, min(whole(j) for j in others if counts[j] == most)))
    return rows


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by block; blocks of one word are passed over."""
    pending: list[tuple[str, str, list[tuple[str, int]]]] = []
    waiting, key, block, length = 0, None, [], 0

    def done() -> Iterator[pa.RecordBatch]:
        rows = _summed(length, pending) if pending else []
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOUND, strict=True)], schema=_FOUND
            )

    def close() -> None:
        nonlocal waiting
        if len(block) > 1:
            pending.append((key[1], key[2], block))
            waiting += len(block)

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for m, head, tail, part, n in zip(*columns, strict=True):
            if key != (m, head, tail):
                close()
                block = []
                # Parts of like lengths share an index.
                if waiting >= AT_ONCE or m != length:
                    yield from done()
                    pending, waiting, length = [], 0, m
                key = (m, head, tail)
            block.append((part, n))
    close()
    yield from done()


def near_words(words: DataFrame, limit: int = LIMIT, window: int = WINDOW) -> DataFrame:
    """(word, n_near, best_n, best) of every word of ``words`` (word, n) with a near word.

    ``n_near`` counts the near words; ``best`` is that of largest n, the smallest in
    code-point order among equals. Words must be distinct. Limit and window change which
    blocks are read, not the result.
    """
    spark = words.sparkSession
    dealt, found = _blocks(words), []
    key = F.xxhash64("m", "head", "tail")
    wide = F.length("part") > window
    while True:
        path = scratch_path(spark, "spelling-large")
        large = (F.col("rows") > limit) & F.col("halves")
        (
            dealt.groupBy(key.alias("block"))
            .agg(
                F.count("*").alias("rows"),
                F.max(F.col("m") - F.length("head") - F.length("tail") > 1).alias("halves"),
                F.max(wide).alias("wide"),
            )
            .filter(large | (F.col("wide") & (F.col("rows") > 1)))
            .select("block")
            .write.parquet(path)
        )
        blocks = spark.read.parquet(path)
        n = blocks.count()
        some = F.broadcast(blocks) if n <= BROADCAST_ROWS else blocks
        marked = dealt.withColumn("block", key)
        small = (marked.join(some, "block", "left_anti") if n else marked).filter(~wide)
        small = small.select("m", "head", "tail", "part", "n").repartition("m", "head", "tail")
        found.append(
            small.sortWithinPartitions("m", "head", "tail").mapInArrow(
                _read_blocks, "word string, n_near long, best_n long, best string"
            )
        )
        if not n:
            break
        path = scratch_path(spark, "spelling-halved")
        _halved(marked.join(some, "block", "left_semi")).write.parquet(path)
        dealt = spark.read.parquet(path)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best")))
    return (
        every.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("at"))
        .select("word", "n_near", (-F.col("at.less")).alias("best_n"), F.col("at.best").alias("best"))
    )


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form) links, by doubling.

    Forms are ``STEP`` times as frequent as their words, so a path is as long as counts have
    digits, at most, and no word has more links to it than it has near words: no hot keys.
    """
    spark = links.sparkSession

    def kept(frame: DataFrame) -> DataFrame:
        path = scratch_path(spark, "spelling-roots")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    now = kept(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not now.filter("moved").isEmpty():
        farther = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = kept(
            now.join(farther, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            )
        )
    return now.select("word", "root")


def variants(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    ``form`` is the near word of largest n, if that is ``STEP`` times the word's at least;
    ``root`` follows forms to the last. An empty table gives no rows; other columns, whatever
    their names, are not read.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "spelling-words")
    vocabulary(documents, doc_id, text).write.parquet(path)
    words = spark.read.parquet(path)
    near = near_words(words)
    has_form = F.col("best_n") >= STEP * F.col("n")
    path = scratch_path(spark, "spelling-forms")
    words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best")).alias("form"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    ).write.parquet(path)
    formed = spark.read.parquet(path)
    roots = _roots(formed.filter("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
