"""Scratch tables, word hashing over whole Arrow batches, and what workers remember."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.session import scratch_dir

WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
BLOCK_BYTES = 1 << 19


def stored(df: DataFrame, purpose: str, options: dict | None = None) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back: lineage ends here and survives executors. ``options`` are
    those of the files."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, size: str = "8m", rows: int = 2000) -> None:
    """Bound the Arrow batches sent to Python: whole texts can be long, and a worker holds a batch or two at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


#: An id set of at most this many rows (8 bytes each) is broadcast; a larger one is joined by exchange.
BROADCAST_IDS = 2_000_000


def rows_with_ids(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` is in the one column of the stored table ``ids``. Few ids go to the rows, so texts stay in place."""
    small = ids.count() <= BROADCAST_IDS
    named = ids.toDF(column)
    return df.join(F.broadcast(named) if small else named, column, "left_semi")


def grouped(df: DataFrame, keys: Sequence[str], fn: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over the rows of each key (all integers, not null), one group in memory at a time."""
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], 1)
            cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                key = tuple(values[start].tolist())
                if held and key != now:
                    yield from fn(pa.Table.from_batches(held))
                    held = []
                now = key
                held.append(batch.slice(start, end - start))
        if held:
            yield from fn(pa.Table.from_batches(held))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def worker_memo(name: str) -> dict:
    """A table that stays with this worker process from task to task."""
    return sys.modules.setdefault("_finlake_memo", ModuleType("_finlake_memo")).__dict__.setdefault(name, {})


def trim(memo: dict, most: int) -> None:
    """Make room in a full table: the half that came first, which holds the most frequent keys, stays."""
    if len(memo) >= most:
        for key in list(islice(memo, most // 2, None)):
            del memo[key]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def held_out(doc_id: str | Column) -> Column:
    """The rows no model may learn labels from: crc32 of the id as text, modulo 3, is 1. A null id is not held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(column.cast("string")), F.lit(3)) == 1, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Masks that keep the first 0 to 8 bytes of eight.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)
LENGTHS = np.uint64(0xD6E8FEB86659FD93)


def stretch_hashes(raw: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches of ``raw`` that begin at ``first`` and have ``sizes`` bytes, none empty.

    Every eight bytes are mixed with their place in the stretch before they are summed, so no regular pattern of bytes, such as
    a word and its mirror image, makes sums meet.
    """
    if not len(first):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lanes = (sizes + 7) >> 3
    ends = np.cumsum(lanes)
    nth = np.arange(ends[-1]) - np.repeat(ends - lanes, lanes)
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))[np.repeat(first, lanes) + 8 * nth]
    eight &= MASKS[np.minimum(np.repeat(sizes, lanes) - 8 * nth, 8)]
    salted = mix(eight ^ mix((nth + 1).astype(np.uint64) * STEP))
    return mix(np.add.reduceat(salted, ends - lanes) + sizes.astype(np.uint64) * LENGTHS)


#: Places for stretches that a worker remembers for either tokenizer, 16 bytes each, and room for their ids, 4 bytes each.
MEMO_PLACES = 1 << 21
MEMO_IDS = 1 << 23


def slices(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    return flat[np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)] if len(ends) else flat[:0]


class Remembered:
    """Ids of stretches of bytes by 64-bit hashes of the stretches, in arrays.

    Each hash has one place, where the stretch that came last stays. When the room for ids is used up, the half that came first
    is kept. What is forgotten is encoded anew, so ids do not depend on it.
    """

    def __init__(self, places: int, room: int):
        self.keys = np.zeros(places, np.uint64)
        self.starts, self.widths = np.zeros(places, np.int32), np.zeros(places, np.int32)
        self.flat, self.used = np.zeros(room, np.int32), 0

    @classmethod
    def of_worker(cls, name: str) -> Remembered:
        memo = worker_memo(name)
        if "stretches" not in memo:
            memo["stretches"] = cls(MEMO_PLACES, MEMO_IDS)
        return memo["stretches"]

    def ids(self, raw: np.ndarray, first: np.ndarray, encode: Callable[[list[bytes]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the stretches of ``raw`` that begin at ``first``, and the number of ids up to the end of each. ``encode`` gives
        the ids of new ones as 32-bit integers."""
        sizes = np.diff(np.append(first, len(raw)))
        codes, distinct = pd.factorize(stretch_hashes(raw, first, sizes))
        place = (distinct & np.uint64(len(self.keys) - 1)).astype(np.int64)
        widths = np.where(self.keys[place] == distinct, self.widths[place], 0)
        flat, starts = slices(self.flat, self.starts[place], widths), np.cumsum(widths) - widths
        new = np.flatnonzero(widths == 0)
        if len(new):
            sample = np.empty(len(distinct), np.int64)
            sample[codes] = np.arange(len(codes))
            of, data = sample[new], raw.tobytes()
            got = encode([data[x:y] for x, y in zip(first[of].tolist(), (first[of] + sizes[of]).tolist())])
            fresh = np.frombuffer(b"".join(got), np.int32)
            widths[new] = np.fromiter(map(len, got), np.int32, len(got)) // 4
            starts[new] = len(flat) + np.cumsum(widths[new]) - widths[new]
            flat = np.concatenate([flat, fresh])
            self._keep(distinct[new], place[new], widths[new], fresh)
        return slices(flat, starts[codes], widths[codes]).astype(np.int64), np.cumsum(widths[codes], dtype=np.int64)

    def _keep(self, keys: np.ndarray, place: np.ndarray, widths: np.ndarray, ids: np.ndarray) -> None:
        if self.used + len(ids) > len(self.flat):
            self._halve()
        if self.used + len(ids) > len(self.flat):
            return
        self.keys[place], self.widths[place], self.starts[place] = keys, widths, self.used + np.cumsum(widths) - widths
        self.flat[self.used: self.used + len(ids)] = ids
        self.used += len(ids)

    def _halve(self) -> None:
        held = np.flatnonzero(self.widths)
        held = held[np.argsort(self.starts[held])]
        early = np.cumsum(self.widths[held], dtype=np.int64) <= len(self.flat) // 2
        self.widths[held[~early]] = 0
        kept = held[early]
        ids = slices(self.flat, self.starts[kept], self.widths[kept])
        self.starts[kept] = np.cumsum(self.widths[kept]) - self.widths[kept]
        self.flat[: len(ids)], self.used = ids, len(ids)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a batch, one after the other, and the offsets of each text. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]]
    return raw, at - at[0]


def blocks(raw: np.ndarray, at: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``most`` bytes: first row, end row, their bytes and offsets."""
    first, n = 0, len(at) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, end, raw[at[first]: at[end]], at[first: end + 1] - at[first]
        first = end


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, bool)
IS_WORD[list(WHITE)] = False


class Words:
    """Words of a block of texts: 64-bit hashes in text order (A-Z lower-cased), lengths, and word counts per text.

    ``letters`` marks the bytes that words are made of.
    """

    def __init__(self, raw: np.ndarray, at: np.ndarray, letters: np.ndarray = IS_WORD):
        n = len(at) - 1
        inside = letters[raw]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        edge = at[:-1][at[:-1] < len(raw)]
        starts[edge] = inside[edge]
        chars = LOWER[raw[inside]]
        # Place of each word's first character among the word characters, and each word's length.
        first = np.flatnonzero(starts[inside])
        self.lengths = np.diff(np.append(first, len(chars)))
        self.counts = np.diff(np.searchsorted(np.flatnonzero(starts), at)) if n else np.zeros(0, np.int64)
        self.hashes = stretch_hashes(chars, first, self.lengths)
