"""Ranked lexical search over bit-sliced Bloom signatures, exact.

Documents are indexed in blocks. A block's signature matrix has a row of bits per Bloom position and a column per document, and
is stored by rows, so one row is a bitmap over the block's documents. Each term of a document sets the positions of its keys:
one for being there, one more for every level of frequency it reaches. The rows of a key, joined by AND, mark every document that
has it, and a few that do not.

Such bitmaps overestimate how often a term stands in a document, never the opposite. Summed with the terms' weights, one sum per
level, they give an upper bound of every document's score at once. Documents whose bound does not reach the score of the
``k``-th best found so far are excluded; all others are scored exactly from their stored terms.

Documents of like size share a block, and a block's rows are in proportion to that size, so rows stay about as full everywhere.
Blocks are stored small, so that no row of the index is a large object for Spark, and blocks of as many rows are searched side by
side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.shared import Words, blocks, mix, small_batches, stored, text_bytes

#: Bytes of terms: ASCII letters and digits, and everything beyond ASCII.
IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Levels of frequency: a term that stands ``LEVELS[i]`` times or more sets the keys of levels 0 to i.
LEVELS = (1, 2, 3, 4, 6, 9, 16, 32)
#: Positions of a key, bits of a row per key of a document, the fewest and the most rows of a block.
HASHES, BITS_A_KEY = 3, 8
FEWEST_ROWS, MOST_ROWS = 1 << 6, 1 << 20
#: Bits of a stored block, whose row of the index takes about a byte for each, and of those that are searched side by side.
STORED_BITS = 1 << 18
BLOCK_BITS = 1 << 22
MOST_DOCS = 1 << 13
#: Stored rows of an index are read a row group at a time, and its size is looked at every few rows.
INDEX_FILES = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 4, "parquet.enable.dictionary": "false"}
#: Terms of the items that are searched for in one pass over the index.
PASS_TERMS = 500_000
#: Bytes of bitmaps of one item's terms that are held unpacked at a time; an item with more terms takes several rounds.
UNPACKED_BYTES = 1 << 22
#: Documents scored exactly between two looks at the bound.
RESCORED = 256
FINAL_SALTS = 64

INDEX = "rows long, ids array<long>, sizes array<long>, starts array<long>, terms binary, counts binary, slices binary"
_INDEX_NAMES = ["rows", "ids", "sizes", "starts", "terms", "counts", "slices"]
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run of texts: its first and end row, all terms of each text, and the offsets of their distinct terms; then per
    distinct term its hash and how often it stands there (as one array of pairs)."""
    raw, at = text_bytes(column)
    for first, end, part, part_at in blocks(raw, at):
        found = Words(part, part_at, IS_TERM)
        owner = np.repeat(np.arange(end - first), found.counts)
        order = np.lexsort((found.hashes, owner))
        hashes, owner = found.hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        at_new = np.flatnonzero(new)
        counts = np.diff(np.append(at_new, len(hashes)))
        starts = np.searchsorted(owner[at_new], np.arange(end - first + 1))
        yield first, end, found.counts, starts, np.stack([hashes[at_new], counts.astype(np.uint64)])


def positions(terms: np.ndarray, level: int, rows: int) -> np.ndarray:
    """The rows of the keys of ``terms`` at a level, ``HASHES`` for each."""
    salts = (np.arange(1, HASHES + 1, dtype=np.uint64) + np.uint64(level * HASHES)) * _STEP
    return (mix(terms[:, None] ^ salts) & np.uint64(rows - 1)).astype(np.int64)


def _keys(counts: np.ndarray) -> int:
    return int(sum((counts >= level).sum() for level in LEVELS))


class _Block:
    """Documents of like size that wait for their block to be full."""

    def __init__(self, rows: int):
        self.rows = rows
        self.room = max(8, min(MOST_DOCS, STORED_BITS // rows))
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.parts: list[np.ndarray] = []

    def record(self) -> pa.RecordBatch:
        """The block as one row of the index."""
        lengths = [part.shape[1] for part in self.parts]
        terms, counts = np.concatenate(self.parts, 1)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        bits = np.zeros((self.rows, -(-len(lengths) // 8) * 8), bool)
        for i, level in enumerate(LEVELS):
            reached = counts >= level
            bits[positions(terms[reached], i, self.rows), owner[reached][:, None]] = True
        columns = [
            pa.array([self.rows], pa.int64()), pa.array([self.ids], pa.list_(pa.int64())), pa.array([self.sizes], pa.list_(pa.int64())),
            pa.array([np.cumsum([0, *lengths])], pa.list_(pa.int64())), pa.array([terms.tobytes()], pa.binary()),
            pa.array([counts.astype("<u4").tobytes()], pa.binary()), pa.array([np.packbits(bits, 1).tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=_INDEX_NAMES)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_blocks: dict[int, _Block] = {}
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for first, _, sizes, starts, pairs in _terms(batch.column(1)):
            for i in np.flatnonzero(sizes).tolist():
                part = pairs[:, starts[i]: starts[i + 1]]
                wanted = BITS_A_KEY * _keys(part[1])
                rows = min(max(1 << max(wanted - 1, 0).bit_length(), FEWEST_ROWS), MOST_ROWS)
                block = open_blocks.setdefault(rows, _Block(rows))
                block.ids.append(ids[first + i])
                block.sizes.append(int(sizes[i]))
                block.parts.append(part.copy())
                if len(block.ids) == block.room:
                    yield block.record()
                    del open_blocks[rows]
    for block in open_blocks.values():
        yield block.record()


def index(docs: DataFrame) -> DataFrame:
    """The stored index of ``docs (doc_id, text)``, a row per block. Documents without a term are not in it.

    Blocks are filled inside the tasks that read the documents, so nothing is exchanged.
    """
    small_batches(docs.sparkSession, "4m")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(_indexed, INDEX), "lexical-index", INDEX_FILES)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, _, starts, (terms, counts) in _terms(batch.column(1)):
            lists = [
                pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values.view(np.int64))) for values in (terms, counts)
            ]
            lengths = pa.array(np.diff(starts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), *lists, lengths], names=["item", "terms", "times", "n"])


def bitmaps(slices: np.ndarray, terms: np.ndarray, level: int) -> np.ndarray:
    """For each term the documents of a block that may reach a level, packed: the rows of its key joined by AND."""
    at = positions(terms, level, len(slices))
    out = slices[at[:, 0]]
    for i in range(1, HASHES):
        out &= slices[at[:, i]]
    return out


class _Item:
    """One item's terms in ascending order of hash, their weights, and its best documents so far."""

    def __init__(self, number: int, terms: np.ndarray, weights: np.ndarray, k: int):
        self.number, self.terms, self.weights, self.k = number, terms, weights, k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        """The score that a document has to reach."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        best = np.lexsort((ids, -scores))
        best = best[scores[best] > 0][: self.k]
        self.scores, self.ids = scores[best], ids[best]

    def bounds(self, slices: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of a block's documents: weighted sums of slices, level by level."""
        n = steps.shape[1]
        total = np.zeros(n)
        room = max(1, UNPACKED_BYTES // (8 * slices.shape[1]))
        for start in range(0, len(self.terms), room):
            terms, weights = self.terms[start: start + room], self.weights[start: start + room].astype(np.float64)
            may = None
            for level, step in enumerate(steps):
                more = bitmaps(slices, terms, level)
                may = more if may is None else may & more
                there = may.any(1)
                if not there.any():
                    break
                may, terms, weights = may[there], terms[there], weights[there]
                total += (weights @ np.unpackbits(may, axis=1, count=n)) * step
        return total * (1 + 1e-9) + 1

    def exact(self, docs: np.ndarray, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Scores of some documents of a block from their terms."""
        lengths = starts[docs + 1] - starts[docs]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(starts[docs] - (ends - lengths), lengths)
        owner = np.repeat(np.arange(len(docs)), lengths)
        place = np.minimum(np.searchsorted(self.terms, terms[at]), len(self.terms) - 1)
        hit = self.terms[place] == terms[at]
        owner, place, tf = owner[hit], place[hit], counts[at[hit]].astype(np.int64)
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, owner, self.weights[place] * share(tf, m[docs[owner]]))
        return out


def share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's weight is multiplied with in a document where it stands ``tf`` times."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _padded(values: np.ndarray, n: int, empty: int = 0) -> np.ndarray:
    return np.concatenate([values, np.full(n - len(values), empty, np.int64)])


def _part(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, ...]:
    """A stored block as arrays of its own: ids, sizes, numbers of terms and highest counts of its documents, filled up to whole
    bytes of a row with documents that have no terms, then terms, counts and the matrix."""
    rows, ids, sizes, starts, terms, counts, matrix = (batch.column(name)[i] for name in _INDEX_NAMES)
    matrix = np.frombuffer(matrix.as_buffer(), np.uint8).reshape(rows.as_py(), -1).copy()
    # A null id stands behind all others among equal scores.
    ids, sizes, starts = pc.fill_null(ids.values, NO_ID).to_numpy(), sizes.values.to_numpy(), starts.values.to_numpy()
    terms, counts = np.frombuffer(terms.as_buffer(), np.uint64).copy(), np.frombuffer(counts.as_buffer(), "<u4").copy()
    n, most = 8 * matrix.shape[1], np.maximum.reduceat(counts, starts[:-1]).astype(np.int64)
    return _padded(ids, n, NO_ID), _padded(sizes, n), _padded(np.diff(starts), n), _padded(most, n), terms, counts, matrix


def _side_by_side(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[np.ndarray, ...]]]:
    """Stored blocks of as many rows, in lists of about ``BLOCK_BITS``."""
    held: dict[int, list] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            part = _part(batch, i)
            rows = len(part[-1])
            mine = held.setdefault(rows, [])
            mine.append(part)
            if sum(len(ids) for ids, *_ in mine) >= min(MOST_DOCS, BLOCK_BITS // rows):
                yield held.pop(rows)
    while held:
        yield held.popitem()[1]


def _searched(shipped, n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [_Item(number, terms, weights, k) for number, terms, weights in shipped.value if len(terms)]
        for parts in _side_by_side(batches):
            ids, sizes, lengths, most, terms, counts = (np.concatenate(values) for values in list(zip(*parts))[:-1])
            slices = np.concatenate([matrix for *_, matrix in parts], 1)
            starts, there = np.append(0, np.cumsum(lengths)), sizes > 0
            m = np.array([75 + (25 * n * n_docs) // n_terms for n in sizes.tolist()], np.int64)
            # Level i promises at most as many as one below the next level, and never more than the document's most.
            tops = [np.minimum(most, level - 1) for level in LEVELS[1:]] + [most]
            shares = np.stack([share(np.maximum(top, 1), m) for top in tops])
            steps = np.maximum(np.diff(shares, axis=0, prepend=0), 0).astype(np.float64)
            for item in items:
                bounds = item.bounds(slices, steps)
                left = np.flatnonzero((bounds >= item.floor) & there)
                left = left[np.argsort(-bounds[left], kind="stable")]
                while len(left):
                    now, left = left[:RESCORED], left[RESCORED:]
                    item.take(item.exact(now, starts, terms, counts, m), ids[now])
                    left = left[bounds[left] >= item.floor]
        part = TaskContext.get().partitionId()
        for item in items:
            n = len(item.ids)
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array([item.number] * n, pa.int64()), pa.array([part] * n, pa.int64()), pa.array(item.ids, pa.int64(), mask=item.ids == NO_ID),
                    pa.array(item.scores),
                ], names=["item", "part", "doc_id", "score"])

    return run


NO_ID = (1 << 63) - 1


def _frequencies(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(shipped.value, np.uint64)
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            if batch.num_rows:
                terms = np.concatenate([np.frombuffer(data.as_buffer(), np.uint64) for data in batch.column(0)])
                place = np.minimum(np.searchsorted(wanted, terms), len(wanted) - 1)
                total += np.bincount(place[wanted[place] == terms], minlength=len(wanted))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["place", "df"])

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(indexed: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of a stored index for each row of ``items (item_id, text)``.

    Only scores above 0 count; equal scores rank by ascending doc_id, null last. Rows that repeat a doc_id or an item_id are
    documents or items of their own. Null and empty texts find nothing; an empty index gives an empty result.

    Items are dealt to passes of about ``PASS_TERMS`` distinct terms; the terms of a pass go to every task. A task keeps the
    ``k`` best documents per item, and these are ranked at the end, in two rounds so that no task ranks all of an item's rows.
    """
    spark = indexed.sparkSession
    small_batches(spark, "4m")
    n_docs, n_terms = indexed.select(
        F.coalesce(F.sum(F.size("ids").cast("long")), F.lit(0)),
        F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda total, n: total + n)), F.lit(0)),
    ).head()
    numbered = stored(items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id"), F.col("text").cast("string").alias("text")), "items")
    listed = stored(
        numbered.select("item", "text").mapInArrow(_item_terms, "item long, terms array<long>, times array<long>, n long"), "item-terms"
    )
    passes = -(-int(listed.agg(F.sum("n")).head()[0] or 0) // PASS_TERMS)
    found = []
    for p in range(passes if n_docs else 0):
        mine = listed.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == p).select("item", "terms", "times").toArrow().to_pydict()
        lists = [(np.array(t, np.int64).view(np.uint64), np.array(n, np.int64)) for t, n in zip(mine["terms"], mine["times"])]
        wanted = np.unique(np.concatenate([t for t, _ in lists])) if lists else np.zeros(0, np.uint64)
        if not len(wanted):
            continue
        counted = indexed.select("terms").mapInArrow(_frequencies(spark.sparkContext.broadcast(wanted.tobytes())), "place long, df long")
        df = dict(counted.groupBy("place").agg(F.sum("df").alias("df")).collect())
        weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(wanted))], np.int64)
        ready = [
            (number, terms, weights[np.searchsorted(wanted, terms)] * times) for number, (terms, times) in zip(mine["item"], lists)
        ]
        run = _searched(spark.sparkContext.broadcast(ready), n_docs, n_terms, k)
        found.append(indexed.mapInArrow(run, "item long, part long, doc_id long, score long"))
    schema = "item long, part long, doc_id long, score long"
    rows = spark.createDataFrame([], schema)
    for more in found:
        rows = rows.unionByName(more)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["item", F.pmod("part", F.lit(FINAL_SALTS))], ["item"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return rows.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """Index ``docs (doc_id, text)`` and rank them for every row of ``items (item_id, text)``; see ``search``. Other columns of
    either table are not read."""
    return search(index(docs), items, k)
