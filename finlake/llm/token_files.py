"""Token ids as grammar-compressed binary shards.

Documents are laid out in ascending id order. Each shard is one byte string that stands alone: frequent neighbouring ids are
replaced by nonterminals again and again (Re-Pair), and the rules, their expansion lengths and the places of the documents
are stored with the remaining sequence, so a document is decoded without the others.

Shard format, little-endian: magic ``RPT2``; six 32-bit counts (terminals, rules, symbols, documents, samples, bits of a symbol);
rules as pairs of 32-bit symbols; expansion lengths of the rules, 32-bit; symbols, each in as few bits as the greatest needs, lowest
bit first; for each document its id (64-bit), whether it has
one (8-bit) and its first token in the shard (64-bit, one more for the end); for every ``SAMPLE``-th symbol the number of
tokens before it (64-bit).
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.shared import Remembered, small_batches, stored, text_bytes, trim, worker_memo

MAGIC = b"RPT2"
SHARD_TOKENS = 1 << 20
#: A rule takes 96 bits and each replacement saves one symbol of 16 bits or a few more, so a pair pays from 7 occurrences on.
LEAST_COUNT = 7
#: Pairs at least this share as frequent as the most frequent one are replaced in the same round.
ROUND_SHARE = 0.03
PLACE_BITS = 17
SAMPLE = 1024
#: Symbols packed at a time; eight of them fill whole bytes.
PACKED = 1 << 16
#: One document of so many is read by itself.
ALONE = 16
MEMO_PIECES = 800_000
#: New pieces that go through the library as one text.
TOGETHER = 64
END = 0


# ---- ids ----

#: Fixed value: the byte-level pre-tokenizer's pattern, for texts in which the two regular expression engines agree.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: Characters that the library may class otherwise than Python does: other letters, numbers and spaces.
UNSURE_RANGES = (
    (0x1C, 0x1F), (0x85, 0x85), (0xA0, 0xA0), (0xB2, 0xB3), (0xB9, 0xB9), (0xBC, 0xBE), (0x250, 0x200F), (0x2028, 0x202F),
    (0x205F, 0x20AB), (0x20AD, 0x10FFFF),
)
UNSURE = "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in UNSURE_RANGES) + "]"


#: Bytes of texts that are not cut by bytes: other spaces, apostrophes (contractions), and characters beyond ASCII that are
#: not in U+00C0 to U+023F, which are letters but for two signs.
ODD = np.zeros(256, bool)
ODD[[9, 11, 12, 13, 39, *range(0x1C, 0x20), 0xC2, *range(0xC9, 0x100)]] = True
SIGNS = (0x97, 0xB7)  # second bytes of the two, after 0xC3
SPACE, BREAK, LETTER, DIGIT, OTHER = range(5)
KIND = np.full(256, OTHER, np.uint8)
KIND[32], KIND[10], KIND[48:58] = SPACE, BREAK, DIGIT
KIND[65:91] = KIND[97:123] = KIND[128:] = LETTER


class Encoder:
    """Ids of whole texts by the tokenizers library.

    Its pre-tokenizer encodes each of its pieces by itself, so each new piece goes through the library and is remembered, up to
    a bounded number. Texts of letters, digits, signs, and single spaces and line feeds are cut into pieces by bytes, many texts
    at a time; pieces are told apart by 64-bit hashes. Other texts are cut by the pre-tokenizer's pattern, and those with
    characters that the two engines could class differently go through the library whole.

    With ``added``, the strings of the tokenizer's added tokens (``<|endoftext|>``) become those tokens, as in a plain call of
    the library, and texts that hold one go through it whole; without, they are text like any other.
    """

    def __init__(self, definition: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = not added
        strings = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content] if added else []
        self.added = "|".join(map(re.escape, strings))
        self.cut = re.compile(PATTERN).findall
        self.unsure = re.compile(UNSURE).search
        name = f"{zlib.crc32(definition.encode())}-{len(definition)}-{added}"
        self.known, self.pieces = Remembered.of_worker(f"{name}-hashed"), worker_memo(f"{name}-pieces")
        self.blank = dict(zip((b" ", b"\n"), self.whole([" ", "\n"])))
        feed = np.frombuffer(self.blank[b"\n"], np.int32).tolist()
        fed = any("\n" in t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.feed = feed[0] if len(feed) == 1 and not fed else None

    def whole(self, texts: list[str]) -> list[bytes]:
        gc.disable()  # the lists of ids live for a moment and hold no cycles
        try:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        finally:
            gc.enable()
        ends = (4 * np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))).tolist()
        flat = array("i", chain.from_iterable(ids)).tobytes()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def new(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces cut by bytes, ``TOGETHER`` of them in a text: the pre-tokenizer makes each line feed between them a piece.

        Pieces that are blank would merge with it, and are known beforehand.
        """
        filled = [p for p in pieces if p not in self.blank]
        texts = [(b"\n".join(filled[i: i + TOGETHER]) + b"\n").decode() for i in range(0, len(filled), TOGETHER)]
        flat = np.frombuffer(b"".join(self.whole(texts)), np.int32) if self.feed is not None else np.zeros(0, np.int32)
        ends = np.flatnonzero(flat == self.feed)
        if len(ends) != len(filled):  # another kind of tokenizer
            return self.whole([p.decode() for p in pieces])
        data, ends = flat.tobytes(), (4 * ends).tolist()
        ids = iter([data[a:b] for a, b in zip([0, *(e + 4 for e in ends)], ends)])
        return [self.blank.get(p) or next(ids) for p in pieces]

    def _by_bytes(self, raw: np.ndarray, at: np.ndarray, kind: np.ndarray) -> list[bytes]:
        if not len(raw):
            return [b""] * (len(at) - 1)
        begins = kind <= BREAK
        before = kind[:-1]
        begins[1:] |= (before == BREAK) | ((before != SPACE) & (before != kind[1:]))
        begins[at[:-1][at[:-1] < len(raw)]] = True
        first = np.flatnonzero(begins)
        ids, ends = self.known.ids(raw, first, self.new)
        out = ids.astype(np.int32).tobytes()
        cuts = (4 * np.append(0, ends)[np.searchsorted(first, at)]).tolist()
        return [out[a:b] for a, b in zip(cuts, cuts[1:])]

    def _by_pattern(self, texts: list[str]) -> list[bytes]:
        parts = [self.cut(t) for t in texts]
        fresh = list({p for pieces in parts for p in pieces}.difference(self.pieces))
        self.pieces.update(zip(fresh, self.whole(fresh)))
        return [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in parts]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; null is empty."""
        trim(self.pieces, MEMO_PIECES)
        raw, at = text_bytes(texts)
        kind, odd = KIND[raw], ODD[raw]
        blank = kind <= BREAK
        together = blank[1:] & blank[:-1]
        together[at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(raw))] - 1] = False
        odd[1:] |= together
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        second = raw[lead + 1]
        odd[lead[(second == SIGNS[0]) | (second == SIGNS[1])]] = True
        held = np.zeros(len(at) - 1, bool)
        if self.added:
            held = pc.match_substring_regex(texts, self.added).fill_null(False).to_numpy(zero_copy_only=False)
        other = np.union1d(np.searchsorted(at, np.flatnonzero(odd), "right") - 1, np.flatnonzero(held))
        if not len(other):
            return self._by_bytes(raw, at, kind)
        sizes = np.diff(at)
        plain = np.ones(len(sizes), bool)
        plain[other] = False
        out: list[bytes] = [b""] * len(sizes)
        bytes_kept = np.repeat(plain, sizes)
        ids = self._by_bytes(raw[bytes_kept], np.cumsum([0, *sizes[plain]]), kind[bytes_kept])
        for i, got in zip(np.flatnonzero(plain).tolist(), ids):
            out[i] = got
        rest = {i: texts[i].as_py() for i in other.tolist()}
        entire = {i for i, t in rest.items() if held[i] or self.unsure(t)}
        for run, mine in ((self.whole, [i for i in rest if i in entire]), (self._by_pattern, [i for i in rest if i not in entire])):
            for i, got in zip(mine, run([rest[i] for i in mine]) if mine else []):
                out[i] = got
        return out


# ---- one shard ----


def compress(tokens: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray]:
    """Rules (pairs of symbols; rule r is symbol ``terminals + r``) and the remaining sequence.

    In each round the pairs of neighbours are first counted roughly, in a table of hashes; those in places nearly as full as the
    fullest are counted exactly, and all that are frequent are replaced from left to right. Rounds go on until no pair is. Once a
    round has replaced all pairs that pay, only pairs with a symbol made since can have become frequent, so no others are counted.
    """
    sequence, rules = tokens.astype(np.int32), np.zeros((0, 2), np.int64)
    share, made = ROUND_SHARE, 0
    while len(sequence) > 1:
        near: np.ndarray | slice = slice(None)
        if made:
            recent = sequence >= made
            near = np.flatnonzero(recent[:-1] | recent[1:])
        left, right = sequence[:-1][near], sequence[1:][near]
        place = left.view(np.uint32) * np.uint32(0x9E3779B1)
        place += right.view(np.uint32) * np.uint32(0x85EBCA77)
        place >>= np.uint32(32 - PLACE_BITS)
        place = place.astype(np.int64)
        filled = np.bincount(place, minlength=1 << PLACE_BITS)
        least = LEAST_COUNT if made else max(LEAST_COUNT, int(filled.max() * share))
        some = np.flatnonzero((filled >= least)[place])
        at = near[some] if made else some
        codes, pairs = pd.factorize((left[some].astype(np.int64) << 32) | right[some])
        counts = np.bincount(codes, minlength=1)
        chosen = np.flatnonzero(counts >= least)
        if not len(chosen):
            if least == LEAST_COUNT:
                break
            share /= 8
            continue
        chosen = chosen[np.argsort(-counts[chosen], kind="stable")]
        made = terminals + len(rules) if least == LEAST_COUNT else 0
        symbol = np.zeros(len(pairs), np.int32)
        symbol[chosen] = terminals + len(rules) + np.arange(len(chosen))
        new = symbol[codes]
        at, new = at[new > 0], new[new > 0]
        number = np.arange(len(at))
        first = np.ones(len(at), bool)
        first[1:] = at[1:] != at[:-1] + 1
        kept = (number - np.maximum.accumulate(np.where(first, number, 0))) % 2 == 0
        at, new = at[kept], new[kept]
        rules = np.vstack([rules, np.stack([pairs[chosen] >> 32, pairs[chosen] & 0xFFFFFFFF], 1)])
        sequence[at] = new
        stays = np.ones(len(sequence), bool)
        stays[at + 1] = False
        sequence = sequence[stays]
    return rules, sequence


def _runs(rules: np.ndarray, terminals: int) -> Iterator[tuple[int, int]]:
    """Stretches of rules, in order, whose parts are terminals or rules before the stretch."""
    latest = np.maximum.accumulate(rules.max(1) - terminals)
    start = 0
    while start < len(rules):
        end = int(np.searchsorted(latest, start))
        if end <= start:
            raise ValueError(f"rule {start} is made of later ones")
        yield start, end
        start = end


def rule_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """How many tokens each rule expands to."""
    widths = np.ones(terminals + len(rules), np.int64)
    for start, end in _runs(rules, terminals):
        widths[terminals + start: terminals + end] = widths[rules[start:end, 0]] + widths[rules[start:end, 1]]
    return widths[terminals:]


def expansions(rules: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all rules one after the other, where each rule's begin, and how many there are.

    Rules are filled in many at a time: those of terminals first, then those whose parts are there already.
    """
    lengths = rule_lengths(rules, terminals)
    begin = np.cumsum(lengths) - lengths
    flat = np.zeros(int(lengths.sum()), np.int64)
    for start, end in _runs(rules, terminals):
        at = begin[start:end]
        for side in (0, 1):
            symbol = rules[start:end, side]
            plain = symbol < terminals
            flat[at[plain]] = symbol[plain]
            part, to = symbol[~plain] - terminals, at[~plain]
            sizes = lengths[part]
            inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            flat[np.repeat(to, sizes) + inside] = flat[np.repeat(begin[part], sizes) + inside]
            at = at + np.where(plain, 1, lengths[np.maximum(symbol - terminals, 0)])
    return flat, begin, lengths


def packed_bits(symbols: np.ndarray, bits: int) -> bytes:
    """Symbols of so many bits each, at most 32, one after the other."""
    parts = []
    for i in range(0, len(symbols), PACKED):
        rows = symbols[i: i + PACKED].astype("<u4").view("u1").reshape(-1, 4)
        parts.append(np.packbits(np.unpackbits(rows, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes())
    return b"".join(parts)


def unpacked_bits(data: np.ndarray, bits: int, count: int) -> np.ndarray:
    """The first ``count`` symbols of so many bits each."""
    out = np.empty(count, np.int64)
    for i in range(0, count, PACKED):
        n = min(PACKED, count - i)
        rows = np.zeros((n, 32), np.uint8)
        rows[:, :bits] = np.unpackbits(data[i * bits // 8:], count=n * bits, bitorder="little").reshape(n, bits)
        out[i: i + n] = np.packbits(rows, axis=1, bitorder="little").view("<u4")[:, 0]
    return out


def pack(ids: list[int | None], parts: list[bytes], terminals: int) -> bytes:
    """A shard of documents, each given by its id and its tokens."""
    tokens = np.frombuffer(b"".join(parts), np.int32)
    if len(tokens) and int(tokens.max()) >= terminals:
        raise ValueError(f"id {tokens.max()} is beyond the {terminals} of the vocabulary")
    rules, sequence = compress(tokens, terminals)
    lengths = rule_lengths(rules, terminals)
    widths = np.concatenate([np.ones(terminals, np.int64), lengths])[sequence]
    before = np.cumsum(widths) - widths
    starts = np.cumsum([0, *(len(p) // 4 for p in parts)])
    samples = before[::SAMPLE]
    bits = max(1, int(sequence.max()).bit_length()) if len(sequence) else 1
    head = np.array([terminals, len(rules), len(sequence), len(parts), len(samples), bits], "<u4")
    return b"".join([
        MAGIC, head.tobytes(), rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), packed_bits(sequence, bits),
        np.array([i or 0 for i in ids], "<i8").tobytes(), np.array([i is not None for i in ids], "u1").tobytes(),
        starts.astype("<i8").tobytes(), samples.astype("<i8").tobytes(),
    ])


class Shard:
    """Reader of one shard."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard")
        self.terminals, n_rules, self.n_symbols, n_docs, n_samples, self.bits = np.frombuffer(data, "<u4", 6, 4).tolist()
        at = 28

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, n, at)
            at += got.nbytes
            return got

        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2).astype(np.int64)
        self.lengths = take("<u4", n_rules).astype(np.int64)
        self.packed = take("u1", -(-self.n_symbols * self.bits // 8))
        self.ids = take("<i8", n_docs)
        self.has_id = take("u1", n_docs).astype(bool)
        self.starts = take("<i8", n_docs + 1)
        self.samples = take("<i8", n_samples)
        self.flat, self.begin, _ = expansions(self.rules, self.terminals)
        # Terminals expand to themselves, stored behind the rules' tokens.
        self.table = np.concatenate([self.flat, np.arange(self.terminals)]).astype(np.uint32)
        self.width = np.concatenate([np.ones(self.terminals, np.int64), self.lengths])
        self.place = np.concatenate([np.arange(self.terminals) + len(self.flat), self.begin])

    def symbols(self, start: int, end: int) -> np.ndarray:
        """Symbols from a sampled place on."""
        end = min(end, self.n_symbols)
        return unpacked_bits(self.packed[start * self.bits // 8:], self.bits, end - start)

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        widths = self.width[symbols]
        ends = np.cumsum(widths)
        if not len(ends):
            return np.zeros(0, np.uint32)
        return self.table[np.arange(ends[-1]) + np.repeat(self.place[symbols] - (ends - widths), widths)]

    def tokens(self) -> np.ndarray:
        return self._expand(self.symbols(0, self.n_symbols))

    def document(self, i: int) -> np.ndarray:
        """Tokens of one document: from the last sample before it, only the symbols that cover it are expanded."""
        start, end = int(self.starts[i]), int(self.starts[i + 1])
        if start == end:
            return np.zeros(0, np.uint32)
        sample = int(np.searchsorted(self.samples, start, "right")) - 1
        upto = int(np.searchsorted(self.samples, end, "left"))
        symbols = self.symbols(sample * SAMPLE, upto * SAMPLE)
        offset = int(self.samples[sample])
        ends = offset + np.cumsum(self.width[symbols])
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, end, "left")) + 1
        before = int(ends[a - 1]) if a else offset
        return self._expand(symbols[a:b])[start - before: end - before]


# ---- tables ----


def write(docs: DataFrame, tokenizer_path: str, path: str | None = None) -> DataFrame:
    """Encode ``docs (doc_id, text)``, end each document with id 0, and store the shards: ``(part, number, data)``, as a Parquet
    table at ``path``, which must not exist, or else in the scratch folder. ``read`` takes the table again.

    Shards of ascending ``(part, number)`` hold documents of ascending id; rows without an id come first, rows that repeat one
    follow each other in an order set by their texts. A text is spread over nothing: a shard ends after the document that
    fills it.
    """
    small_batches(docs.sparkSession, "2m")
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    shipped = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shipped.value, added=True)
        terminals = encoder.tokenizer.get_vocab_size()
        end = np.array([END], np.int32).tobytes()
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        parts: list[bytes] = []
        size = 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([pack(ids, parts, terminals)], pa.binary())],
                names=["part", "number", "data"],
            )

        for batch in batches:
            for doc_id, got in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                ids.append(doc_id)
                parts.append(got + end)
                size += len(got) // 4 + 1
                if size >= SHARD_TOKENS:
                    yield shard()
                    number, size = number + 1, 0
                    ids.clear()
                    parts.clear()
        if ids:
            yield shard()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    shards = rows.select("doc_id", "text").mapInArrow(run, "part int, number int, data binary")
    if path is None:
        return stored(shards, "token-files")
    shards.write.parquet(path)
    return docs.sparkSession.read.schema(shards.schema).parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, data in zip(*(batch.column(c).to_pylist() for c in ("part", "number", "data"))):
            shard = Shard(data)
            starts, n = shard.starts.tolist(), len(shard.ids)
            whole = shard.tokens().astype("<u4", copy=False)
            # Some documents come by random access, which decodes them without the others.
            sums = [
                zlib.crc32(whole[a:b] if i % ALONE else shard.document(i).astype("<u4", copy=False))
                for i, (a, b) in enumerate(zip(starts, starts[1:]))
            ]
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(shard.ids, mask=~shard.has_id),
                pa.array(starts[:-1], pa.int64()), pa.array(np.diff(shard.starts)), pa.array(sums, pa.int64()),
            ], names=["part", "number", "doc_id", "first", "n_tokens", "ids_crc32"])


def read(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document of the stored shards.

    ``start`` counts the ids of all documents before it; it comes from the number of ids of the parts before and of the
    part's shards before.
    """
    rows = files.mapInArrow(_read, "part int, number int, doc_id long, first long, n_tokens long, ids_crc32 long")
    rows = stored(rows, "token-index")
    shards = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = shards.groupBy("part").agg(F.sum("n").alias("n")).select("part", before(Window.orderBy("part")).alias("base"))
    inside = shards.select("part", "number", before(Window.partitionBy("part").orderBy("number")).alias("ahead"))
    placed = inside.join(parts, "part").select("part", "number", (F.col("base") + F.col("ahead")).alias("offset"))
    out = rows.join(placed, ["part", "number"])
    return out.select("doc_id", (F.col("offset") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def written_and_read(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write ``docs`` and read them back, one row per row: ``(doc_id, start, n_tokens, ids_crc32)``.

    Null and empty texts are the end id alone. Rows with a null id come first, rows that repeat an id have a row each. An empty
    table gives an empty result. Other columns are not read.
    """
    return read(write(docs, tokenizer_path))
