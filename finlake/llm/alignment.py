"""Alignment of two tokenizers over the same texts, as Arrow tables inside tasks and counts merged by Spark.

Each text is cut by a byte-level BPE and by a SentencePiece model. Lists of ids are flattened with their parent rows, token sizes
are summed up to byte ends within each row, and a hash join on (row, end) finds the places where both cut. These places divide the
tokens of a row into groups; every token of the one side is linked with every token of the other in its group.

A group's tokens are first reduced to distinct ids with their numbers, and a second join on the group makes distinct id pairs with
their numbers of links, a bounded number at a time; links themselves are never listed. How many documents hold a pair is counted
per task by ``Table.group_by``, exchanged and sorted by Spark, and added up in order of pair.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.shared import Remembered, blocks, slices, small_batches, stored, text_bytes, trim, worker_memo
from finlake.llm.token_files import KIND, Encoder

#: Pieces of texts with odd characters that a worker remembers for the byte-level tokenizer, about 200 bytes each.
MEMO_PIECES = 200_000
#: Id pairs that one join inside a task may make, and distinct pairs a task counts before it hands them on.
JOINED_PAIRS = 1 << 21
COUNTED_PAIRS = 1 << 21
#: The corpus-wide table of pairs (17 bytes a row) is broadcast up to so many rows; a larger one is joined by exchange.
BROADCAST_PAIRS = 4_000_000
#: Bytes of texts that are aligned at a time.
ALIGNED_BYTES = 1 << 18
#: Stored parts of the alignment for each task that sums up what comes from them, which is narrow.
PARTS_A_TASK = 4
#: Bytes of a row group of the stored alignment, which a task holds while it writes.
ROW_GROUP = 8 << 20
#: Rows that Spark decodes from Parquet at a time: whole texts and lists of pairs can be long, and a task holds them all.
READ_ROWS = 256
SPACE, BREAK = 32, 10
MARK = "▁"
ROW_BITS = 33

ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
)
_ALIGNED_NAMES = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


class Spans:
    """The bytes that each id of a vocabulary stands for, one after the other."""

    def __init__(self, parts: list[bytes]):
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(parts), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return slices(self.flat, self.starts[ids], self.sizes[ids])


#: Fixed value: the byte-level alphabet shows printable bytes as themselves, the others from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SHOWN = {chr(b): b for b in PRINTABLE} | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}


def byte_level_parts(encoder: Encoder) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer; added tokens stand for their own strings."""
    size = encoder.tokenizer.get_vocab_size()
    tokens = [encoder.tokenizer.id_to_token(i) or "" for i in range(size)]
    return [bytes(SHOWN[c] for c in t) if all(c in SHOWN for c in t) else t.encode() for t in tokens]


class ByteLevel(Encoder):
    """Ids of whole texts by the tokenizers library, new pieces remembered in arrays."""

    def _by_bytes(self, raw: np.ndarray, at: np.ndarray, kind: np.ndarray) -> list[bytes]:
        if not len(raw):
            return [b""] * (len(at) - 1)
        before, now = kind[:-1], kind[1:]
        begins = (kind == KIND[SPACE]) | (kind == KIND[BREAK])
        begins[1:] |= (before == KIND[BREAK]) | ((before != KIND[SPACE]) & (before != now))
        begins[at[:-1][at[:-1] < len(raw)]] = True
        first = np.flatnonzero(begins)
        ids, ends = self.known.ids(raw, first, lambda new: self.whole([piece.decode() for piece in new]))
        out = ids.astype(np.int32).tobytes()
        cuts = (4 * np.append(0, ends)[np.searchsorted(first, at)]).tolist()
        return [out[x:y] for x, y in zip(cuts, cuts[1:])]


class Pieces:
    """Ids of whole texts by the sentencepiece library, which puts a space before each.

    No piece reaches over the beginning of a run of spaces or holds a line feed, so the library never merges across these places
    and the stretches between are encoded by themselves, once a worker, and looked up afterwards. A model whose pieces do reach
    over them gets whole texts.
    """

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        normal, user_defined, byte = 1, 4, 6
        if spec.normalizer_spec.precompiled_charsmap or spec.normalizer_spec.remove_extra_whitespaces or not spec.normalizer_spec.add_dummy_prefix:
            raise ValueError("the model changes texts before it cuts them, or puts no space before them")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        over = any(re.search(f"[^{MARK}]{MARK}|\n", p.piece) for p in spec.pieces if p.type in (normal, user_defined))
        self.apart = not over and all(p.type != user_defined for p in spec.pieces) and bool(spec.trainer_spec.byte_fallback)
        self.lead = 2  # the space put before the text, and the line feed that a stretch is encoded behind
        self.known = Remembered.of_worker(f"pieces-{zlib.crc32(model)}-{len(model)}")
        self.parts = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == byte else p.piece.replace(MARK, " ").encode() if p.type == normal else b""
            for p in spec.pieces
        ]

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, each given with a space before it, and how many each text has."""
        if not len(raw):
            return np.zeros(0, np.int64), np.zeros(len(at) - 1, np.int64)
        if not self.apart:
            data = raw.tobytes()
            lists = self.library.encode([data[a + 1: b].decode() for a, b in zip(at.tolist(), at[1:].tolist())], num_threads=1)
            return np.array([i for ids in lists for i in ids], np.int64), np.array(list(map(len, lists)), np.int64)
        begins = raw == BREAK
        space = raw == SPACE
        begins[0] = True
        begins[1:] |= space[1:] & ~space[:-1]
        begins[at[:-1][at[:-1] < len(raw)]] = True
        first = np.flatnonzero(begins)
        ids, ends = self.known.ids(raw, first, self._stretches)
        return ids, np.diff(np.append(0, ends)[np.searchsorted(first, at)])

    def _stretches(self, new: list[bytes]) -> list[bytes]:
        lists = self.library.encode(["\n" + stretch.decode() for stretch in new], num_threads=1)
        widths = (4 * (np.fromiter(map(len, lists), np.int64, len(lists)))).tolist()
        ends = np.cumsum(widths).tolist()
        flat = array("i", chain.from_iterable(lists)).tobytes()
        return [flat[end - width + 4 * self.lead: end] for end, width in zip(ends, widths)]


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids))


def _same(spans: Spans, ids: np.ndarray, counts: np.ndarray, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which texts the bytes of their tokens, joined, are."""
    ends = np.append(0, np.cumsum(counts))
    total = np.append(0, np.cumsum(spans.sizes[ids]))[ends]
    same = np.diff(total) == np.diff(at)
    joined = spans.joined(ids[np.repeat(same, counts)])
    differs = np.append(0, np.cumsum(joined != raw[np.repeat(same, np.diff(at))]))
    sizes = np.diff(at)[same]
    same[same] = np.diff(differs[np.append(0, np.cumsum(sizes))]) == 0
    return same


def _ends(lists: pa.ListArray, sizes: pa.Array) -> pa.Table:
    """One row per token: its text, its id, a key of the text and the byte where the token ends within it, and its place."""
    row, ids = pc.list_parent_indices(lists), pc.list_flatten(lists)
    upto = pc.cumulative_sum(pc.take(sizes, ids))
    offsets = lists.offsets.to_numpy()
    before = pa.array(np.append(0, upto.to_numpy())[offsets[:-1]])  # bytes of all texts before
    end = pc.subtract(upto, pc.take(before, row))
    key = pc.bit_wise_or(pc.shift_left(row.cast(pa.int64()), 32), end)
    return pa.table({"row": row, "id": ids, "key": key, "place": pa.array(np.arange(len(ids), dtype=np.int32))})


def _grouped(tokens: pa.Table, cuts: pa.Array) -> np.ndarray:
    """The group of each token: the number of common ends before its own."""
    flags = np.zeros(len(tokens), np.int64)
    flags[cuts.to_numpy()] = 1
    return np.cumsum(flags) - flags


def _numbers(group: np.ndarray, ids: pa.Array, name: str) -> pa.Table:
    """Distinct ids of each group and how often they stand in it."""
    table = pa.table({"group": group, name: ids})
    return table.group_by(["group", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", name, f"n_{name}"])


def _joined(a: pa.Table, b: pa.Table, groups: int) -> Iterator[pa.Table]:
    """Id pairs of each group and their links: distinct ids of a group on either side joined, ``JOINED_PAIRS`` at a time."""
    per_group = np.bincount(b["group"].to_numpy(), minlength=groups)
    made = np.cumsum(per_group[a["group"].to_numpy()])
    cuts = [0, *(np.flatnonzero(np.diff(made // JOINED_PAIRS)) + 1).tolist(), len(a)]
    for start, end in zip(cuts, cuts[1:]):
        joined = a.slice(start, end - start).join(b, "group", join_type="inner", use_threads=False)
        yield joined.append_column("times", pc.multiply(joined["n_a"], joined["n_b"])).select(["group", "a", "b", "times"])


def _pairs(left: pa.ChunkedArray, right: pa.ChunkedArray, group_a: np.ndarray, group_b: np.ndarray, row_of: np.ndarray, most: int) -> pa.Table:
    """Links per text and id pair, in order. A group of one token on either side is a link as it stands; the others are joined.
    ``most`` is greater than any id."""
    groups = len(row_of)
    one = (np.bincount(group_a, minlength=groups) == 1) & (np.bincount(group_b, minlength=groups) == 1)
    alone_a, alone_b = one[group_a], one[group_b]
    ids_a, ids_b = left.to_numpy(), right.to_numpy()
    ones = np.ones(int(one.sum()), np.int64)
    single = pa.table({"group": np.flatnonzero(one), "a": ids_a[alone_a], "b": ids_b[alone_b], "times": ones})
    a = _numbers(group_a[~alone_a], pa.array(ids_a[~alone_a]), "a")
    b = _numbers(group_b[~alone_b], pa.array(ids_b[~alone_b]), "b")
    done = []
    for links in chain([single], _joined(a, b, groups)):
        key = (row_of[links["group"].to_numpy()] * most + links["a"].to_numpy()) * most + links["b"].to_numpy()
        done.append(pa.table({"key": key, "times": links["times"]}).group_by("key", use_threads=False).aggregate([("times", "sum")]))
    whole = pa.concat_tables(done).group_by("key", use_threads=False).aggregate([("times_sum", "sum")])
    key = whole["key"].to_numpy()
    order = np.argsort(key)
    key = key[order]
    pair = key % (most * most)
    return pa.table({"row": key // (most * most), "pair": (pair // most) << 32 | pair % most, "times": whole["times_sum_sum"].to_numpy()[order]})


class Aligner:
    """Alignment of a run of texts by both tokenizers."""

    def __init__(self, definition: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.encoder, self.pieces = ByteLevel(definition), Pieces(model)
        self.a, self.b = Spans(byte_level_parts(self.encoder)), Spans(self.pieces.parts)
        self.most = most = max(len(self.a.sizes), len(self.b.sizes))
        # Each id in decimal digits, followed by one of four marks.
        self.shown = Spans([f"{i}{mark}".encode() for i in range(most) for mark in (",", "|", ";", "")])

    @classmethod
    def of_worker(cls, definition: str, model: bytes) -> Aligner:
        """The one that this worker process made before, if any: reading both vocabularies anew for each task takes time, and
        memory that comes back in pieces."""
        key = f"aligner-{zlib.crc32(definition.encode())}-{len(definition)}-{zlib.crc32(model)}-{len(model)}"
        memo = worker_memo(key)
        if "made" not in memo:
            memo["made"] = cls(definition, model)
        return memo["made"]

    def align(self, texts: pa.Array) -> list[pa.Array]:
        """Columns ``n_a`` to ``times`` of ``ALIGNED`` for whole texts."""
        texts = texts.fill_null("")
        spaced = pc.binary_join_element_wise("", texts, " ")
        raw, at = text_bytes(spaced)
        trim(self.encoder.pieces, MEMO_PIECES)
        parts = self.encoder.encode(spaced)
        a, n_a = np.frombuffer(b"".join(parts), np.int32).astype(np.int64), np.array([len(p) // 4 for p in parts], np.int64)
        b, n_b = self.pieces.encode(raw, at)
        kept = _same(self.a, a, n_a, raw, at) & _same(self.b, b, n_b, raw, at) & (np.diff(at) > 1)
        a, b = a[np.repeat(kept, n_a)], b[np.repeat(kept, n_b)]
        n_a, n_b = n_a * kept, n_b * kept
        left, right = _ends(_lists(a, n_a), pa.array(self.a.sizes)), _ends(_lists(b, n_b), pa.array(self.b.sizes))
        common = left.select(["key", "place"]).join(
            right.select(["key", "place"]), "key", join_type="inner", right_suffix="_b", use_threads=False
        )
        group_a, group_b = _grouped(left, common["place"]), _grouped(right, common["place_b"])
        n = len(kept)
        row_of = np.zeros(len(common), np.int64)
        row_of[group_a] = left["row"].to_numpy()
        sizes_a, sizes_b = np.bincount(group_a, minlength=len(row_of)), np.bincount(group_b, minlength=len(row_of))
        per_row = lambda values: np.bincount(row_of, weights=values, minlength=n).astype(np.int64)
        pairs = _pairs(left["id"], right["id"], group_a, group_b, row_of, self.most)
        offsets = pa.array(np.searchsorted(pairs["row"].to_numpy(), np.arange(n + 1)), pa.int32())
        return [
            pa.array(n_a), pa.array(n_b), pa.array(np.bincount(row_of, minlength=n)), pa.array(per_row(sizes_a * sizes_b)),
            self._digests(a, b, n_a + n_b, group_a, group_b, sizes_a, sizes_b),
            pa.ListArray.from_arrays(offsets, pairs["pair"].combine_chunks()), pa.ListArray.from_arrays(offsets, pairs["times"].combine_chunks()),
        ]

    def _digests(self, a, b, counts, group_a, group_b, sizes_a, sizes_b) -> pa.Array:
        """Digest of each text's groups: ids in order, the marks that follow them set by where they stand."""
        comma, bar, semicolon, nothing = range(4)
        upto_a, upto_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        code = np.empty(len(a) + len(b), np.int64)
        place_a = np.arange(len(a)) + (upto_b - sizes_b)[group_a]
        place_b = np.arange(len(b)) + upto_a[group_b]
        code[place_a], code[place_b] = 4 * a + comma, 4 * b + comma
        code[place_a[upto_a - 1]] += bar
        code[place_b[upto_b - 1]] += semicolon
        ends = np.cumsum(counts)
        last = ends[counts > 0] - 1
        code[last] += nothing - semicolon
        upto = np.append(0, np.cumsum(self.shown.sizes[code]))
        shown = self.shown.joined(code).tobytes()
        cuts = upto[np.append(0, ends)].tolist()
        return pa.array([hashlib.sha256(shown[x:y]).hexdigest() if y > x else "" for x, y in zip(cuts, cuts[1:])], pa.string())


def aligned(docs: DataFrame, bpe_path: str, pieces_path: str) -> DataFrame:
    """The stored alignment of ``docs (doc_id, text)``, a row per row: ``row`` numbers it, ``pairs`` are its linked id pairs (the
    byte-level id in the upper 32 bits), ``times`` the links of each."""
    small_batches(docs.sparkSession, "4m")
    docs.sparkSession.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))
    context = docs.sparkSession.sparkContext
    with open(bpe_path, encoding="utf-8") as file:
        definition = file.read()
    with open(pieces_path, "rb") as file:
        model = file.read()
    shipped = context.broadcast((definition, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner.of_worker(*shipped.value), TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            _, at = text_bytes(batch.column(1))
            for first, end, _, _ in blocks(np.zeros(at[-1], np.uint8), at, ALIGNED_BYTES):
                columns = aligner.align(batch.column(1).slice(first, end - first))
                rows = pa.array(np.arange(number, number + end - first))
                number += end - first
                yield pa.RecordBatch.from_arrays([rows, batch.column(0).slice(first, end - first), *columns], names=_ALIGNED_NAMES)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(run, ALIGNED), "aligned", {"parquet.block.size": ROW_GROUP})


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per pair of a task, handed on whenever many pairs have come together."""
    held: list[pa.Table] = []
    size = 0

    def merged() -> pa.Table:
        whole = pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")])
        return whole.rename_columns(["pair", "n"])

    for batch in batches:
        pairs = pc.list_flatten(batch.column(0))
        held.append(pa.table({"pair": pairs}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"]))
        size += len(held[-1])
        if size > COUNTED_PAIRS:
            held = [merged()]
            size = len(held[0])
            if size > COUNTED_PAIRS // 2:
                yield from held[0].to_batches()
                held, size = [], 0
    if held:
        yield from merged().to_batches()


def _best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(pair, n, best)`` from parts of the pairs' numbers in order of pair, or in several runs of such order that share no
    byte-level id. What waits for its end is one such id's pairs, at most as many as the other vocabulary has ids."""
    pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def told(pair: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        first = _firsts(pair >> 32)
        most = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(n))))
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n), pa.array(n == most)], names=["pair", "n", "best"])

    for batch in batches:
        if not batch.num_rows:
            continue
        pair, n = np.concatenate([pair, batch.column(0).to_numpy()]), np.concatenate([n, batch.column(1).to_numpy()])
        first = _firsts(pair)
        pair, n = pair[first], np.add.reduceat(n, first)
        open_id = int(_firsts(pair >> 32)[-1])
        if open_id:
            yield told(pair[:open_id], n[:open_id])
        pair, n = pair[open_id:], n[open_id:]
    if len(pair):
        yield told(pair, n)


def _firsts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, values[1:] != values[:-1]))


def _tasks(alignment: DataFrame) -> int:
    """How many tasks sum up what comes from a stored alignment, and so how many files they store: all cores', and more as the
    alignment grows, however many partitions the session gives an exchange."""
    return max(alignment.sparkSession.sparkContext.defaultParallelism, len(alignment.inputFiles()) // PARTS_A_TASK)


def pair_counts(alignment: DataFrame) -> DataFrame:
    """The stored corpus-wide table ``(pair, n, best)``: documents that hold a pair linked, and whether no pair of the same
    byte-level id has more. The tasks' numbers are exchanged once, by that id, and summed up in order of pair, several partitions
    of the exchange by a task, one after the other."""
    counted = alignment.select("pairs").mapInArrow(_counted, "pair long, n long")
    ordered = counted.repartition(F.shiftright("pair", 32)).sortWithinPartitions("pair").coalesce(_tasks(alignment))
    return stored(ordered.mapInArrow(_best, "pair long, n long, best boolean"), "pair-counts")


def summed(alignment: DataFrame, counts: DataFrame, broadcast_rows: int = BROADCAST_PAIRS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per row of a stored alignment.

    Where the table of pairs is broadcast, a row's links never leave its task before they are summed up, and its other columns go
    with them. Otherwise links are exchanged, as narrow as they can be, and their sums joined to the rows."""
    small = counts.count() <= broadcast_rows
    own = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    keys = own if small else ["row"]
    links = alignment.select(*keys, "times", F.posexplode_outer("pairs").alias("place", "pair")).withColumn("times", F.col("times")[F.col("place")])
    known = links.join(F.broadcast(counts), "pair", "left") if small else links.join(counts.hint("merge"), "pair")
    sums = known.groupBy(*keys).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    none = F.lit(0).cast("long")
    return (sums if small else alignment.join(sums, "row", "left")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    ).coalesce(_tasks(alignment))


def alignments(docs: DataFrame, bpe_path: str, pieces_path: str) -> DataFrame:
    """Align both tokenizers over every whole text of ``docs (doc_id, text)``; one row per row, see ``summed``.

    Null and empty texts, and texts that the bytes of either side's tokens do not give back, have no tokens: zeros, and an empty
    digest. Each row counts as a document, also where ids repeat or are null. An empty table gives an empty result. Other columns
    are not read.
    """
    alignment = aligned(docs, bpe_path, pieces_path)
    return summed(alignment, pair_counts(alignment))
