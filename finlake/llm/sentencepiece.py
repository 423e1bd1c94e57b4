"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The pieces are those of a SentencePiece model file; of all ways to cut a text into pieces the one with the greatest sum of
scores is taken (the unigram rule), ties going to the longer last piece. A unigram model's scores are log probabilities. A BPE
model's are negative ranks, from which Zipf's law gives log probabilities up to a constant: ``-log(1 + rank)``. Characters
outside the vocabulary become byte pieces.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm.shared import small_batches, trim, worker_memo

SPACE = "▁"
#: Score of a character outside the vocabulary, below the lowest piece.
UNKNOWN_PENALTY = 10
#: Scores are integers of this many to one, so sums are exact and ties are ties wherever in a text they stand.
UNIT = 1 << 20
MEMO_SEGMENTS = 200_000
#: Letters that a stretch may end after: ASCII and U+00C0 to U+024F without the two signs among them.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
NORMAL, BYTE = 1, 6
BPE = 2


@dataclass
class Vocabulary:
    """What encoding and decoding need of a model file; small enough to go to every task."""

    #: Score and id of each piece; (None, None) for a proper prefix of one.
    pieces: dict[str, tuple[int | None, int | None]]
    byte_ids: list[int]
    texts: list[bytes]
    unknown_score: int
    longest: int
    #: A pattern whose matches meet where no piece of the vocabulary spans the place; None if it has no such places.
    cuts: str | None
    dummy_prefix: bool
    name: str

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            content = file.read()
        model.ParseFromString(content)
        pieces: dict[str, tuple[int | None, int | None]] = {}
        byte_ids, texts, lowest = [-1] * 256, [], 0
        ranked = model.trainer_spec.model_type == BPE
        for i, p in enumerate(model.pieces):
            if p.type == NORMAL:
                for end in range(1, len(p.piece)):
                    pieces.setdefault(p.piece[:end], (None, None))
                score = round(UNIT * (-math.log(1 - p.score) if ranked else p.score))
                pieces[p.piece] = (score, i)
                lowest = min(lowest, score)
                texts.append(p.piece.replace(SPACE, " ").encode())
            elif p.type == BYTE:
                byte_ids[int(p.piece[1:-1], 16)] = i
                texts.append(bytes([int(p.piece[1:-1], 16)]))
            else:
                texts.append(b"")
        normal = [p.piece for p in model.pieces if p.type == NORMAL]
        spans = lambda pattern: any(re.search(pattern, p) for p in normal)
        if spans(f"[^{SPACE}]{SPACE}"):
            cuts = None
        elif spans("\n") or spans(f"[{LETTERS}][^{LETTERS}]"):
            cuts = f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        else:
            sign = f"[^{SPACE}\n{LETTERS}]"
            cuts = f"\n|{SPACE}*{sign}*[{LETTERS}]+|{SPACE}*{sign}+|{SPACE}+"
        return cls(
            pieces, byte_ids, texts, lowest - UNKNOWN_PENALTY * UNIT, max(map(len, normal)), cuts, model.normalizer_spec.add_dummy_prefix,
            f"sentencepiece-{zlib.crc32(content)}-{len(content)}",
        )


class Stream:
    """Viterbi over characters that arrive bit by bit.

    A step needs the best scores of the last ``longest`` positions only. Whenever enough characters are pending, the paths of
    all positions that a later piece may start from are followed back; where they have become one, the ids up to that
    boundary are final and leave memory.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._begin()

    def _begin(self) -> None:
        self.text = ""
        self.best: list[float] = [0]
        self.back: list[tuple[int, int]] = [(0, -1)]
        self.done = 0  # positions whose outgoing pieces are all known
        self.look = 0  # characters from which paths are followed back again; twice as many after each time in vain

    def feed(self, chars: str) -> list[int]:
        """Take characters; the ids that have become final."""
        out: list[int] = []
        step = 4 * self.v.longest
        for start in range(0, len(chars), step):
            self.text += chars[start: start + step]
            if len(self.text) - self.v.longest > self.done:
                self._extend(len(self.text) - self.v.longest)
                if len(self.text) >= self.look:
                    boundary = self._meeting()
                    out += self._commit(boundary)
                    self.look = 0 if boundary else 2 * len(self.text)
        return out

    def finish(self) -> list[int]:
        """The ids of what is left; the next text begins."""
        self._extend(len(self.text))
        out = self._path(len(self.text))
        self._begin()
        return out

    def _extend(self, until: int) -> None:
        """Take all pieces that start before ``until``; their characters are all there."""
        find, text, best, back = self.v.pieces.get, self.text, self.best, self.back
        size, longest, unknown = len(text), self.v.longest, self.v.unknown_score
        lacking = min(size, until - 1 + longest) + 1 - len(best)
        if lacking > 0:
            best.extend([float("-inf")] * lacking)
            back.extend([(-1, -1)] * lacking)
        for i in range(self.done, until):
            here, single = best[i], False
            for end in range(i + 1, min(size, i + longest) + 1):
                found = find(text[i:end])
                if found is None:
                    break
                score, piece = found
                if piece is not None:
                    if end == i + 1:
                        single = True
                    if here + score > best[end]:
                        best[end], back[end] = here + score, (i, piece)
            if not single and here + unknown > best[i + 1]:
                best[i + 1], back[i + 1] = here + unknown, (i, -1)
        self.done = max(self.done, until)

    def _meeting(self) -> int:
        """The last boundary that the best paths to all open positions share."""
        open_ends = {i for i in range(self.done, len(self.best)) if self.back[i][0] >= 0 or i == 0}
        while len(open_ends) > 1:
            last = max(open_ends)
            open_ends.remove(last)
            open_ends.add(self.back[last][0])
        return open_ends.pop() if open_ends else 0

    def _path(self, end: int) -> list[int]:
        """The ids of the best path to a position."""
        out: list[int] = []
        back = self.back
        while end:
            start, piece = back[end]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend([self.v.byte_ids[b] for b in reversed(self.text[start:end].encode())])
            end = start
        out.reverse()
        return out

    def _commit(self, boundary: int) -> list[int]:
        """The ids up to a boundary, which leave memory."""
        out = self._path(boundary)
        if boundary:
            self.text = self.text[boundary:]
            self.best = self.best[boundary:]
            self.back = [(max(start - boundary, 0), piece) for start, piece in self.back[boundary:]]
            self.done -= boundary
        return out


def encode_stream(vocabulary: Vocabulary, chunks: Iterable[str]) -> Iterator[int]:
    """Ids of the text that the chunks make together, each given out as soon as it is final."""
    stream, begun = Stream(vocabulary), False
    for chunk in chunks:
        if chunk and not begun and vocabulary.dummy_prefix:
            yield from stream.feed(SPACE)
        begun = begun or bool(chunk)
        yield from stream.feed(chunk.replace(" ", SPACE))
    yield from stream.finish()


class Encoder:
    """Whole texts to ids, each new stretch by the stream. Where no piece of the vocabulary spans a place (the start of a word, the end of its letters), all
    paths meet there, so the stretches between are encoded one by one; a bounded number of them is remembered, from task to
    task of a worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.stream = Stream(vocabulary)
        self.memo = worker_memo(vocabulary.name)
        trim(self.memo, MEMO_SEGMENTS)
        self.segments = re.compile(vocabulary.cuts or "(?s:.+)").findall

    def _segment(self, text: str) -> bytes:
        return array("i", self.stream.feed(text) + self.stream.finish()).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers; of a text without characters, none."""
        if not text:
            return b""
        marked = (SPACE if self.vocabulary.dummy_prefix else "") + text.replace(" ", SPACE)
        segments = self.segments(marked)
        ids = list(map(self.memo.get, segments))
        if None in ids:
            for i, segment in enumerate(segments):
                if ids[i] is None:
                    ids[i] = self.memo.get(segment) or self._segment(segment)
                    if len(segment) <= 4 * self.vocabulary.longest and len(self.memo) < MEMO_SEGMENTS:
                        self.memo[segment] = ids[i]
        return b"".join(ids)


def decode(vocabulary: Vocabulary, ids: Iterable[int]) -> str:
    """The text of ids; the mark of a space reads as a space, as the format has it."""
    text = b"".join(map(vocabulary.texts.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if vocabulary.dummy_prefix else text


def encoded(docs: DataFrame, model_path: str, column: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each whole text as array<int> in ``column``, which replaces one of that name.

    Null and empty texts have no ids; rows are kept as they are, repeated ones and those with nulls elsewhere too.
    """
    small_batches(docs.sparkSession, "4m")
    shipped = docs.sparkSession.sparkContext.broadcast(vars(Vocabulary.load(model_path)))
    kept = [c for c in docs.columns if c != column]
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).select(*[f"c{i}" for i, c in enumerate(docs.columns) if c != column])
    place = kept.index("text")
    schema = T.StructType([*rows.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(**shipped.value))
        for batch in batches:
            parts = [encoder.encode(t.as_py() or "") for t in batch.column(place)]
            ends = np.cumsum([0, *map(len, parts)]) // 4
            ids = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(np.frombuffer(b"".join(parts), np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=schema.names)

    return rows.mapInArrow(run, schema).toDF(*kept, column)


def round_trips(docs: DataFrame, model_path: str) -> DataFrame:
    """Encode and decode every whole text of ``docs (doc_id, text)``; one row per row of it.

    ``n_ids``, ``ids_crc32`` (crc32 of the ids as little-endian 32-bit integers), ``n_chars`` and ``text_crc32`` of the decoded
    text, ``same``: it is the text given (its own marks of a space read as spaces). Null texts are empty; repeated rows and null
    ids are kept; an empty table gives an empty result. Other columns are not read.
    """
    small_batches(docs.sparkSession, "4m")
    shipped = docs.sparkSession.sparkContext.broadcast(vars(Vocabulary.load(model_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(**shipped.value))
        for batch in batches:
            out: list[tuple] = []
            for t in batch.column(1):
                text = t.as_py() or ""
                ids = encoder.encode(text)
                back = decode(encoder.vocabulary, np.frombuffer(ids, np.int32).tolist())
                out.append((len(ids) // 4, zlib.crc32(ids), len(back), zlib.crc32(back.encode()), back == text.replace(SPACE, " ")))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), [*[pa.int64()] * 4, pa.bool_()])] if out else [pa.array([], t) for t in [*[pa.int64()] * 4, pa.bool_()]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_ids", "ids_crc32", "n_chars", "text_crc32", "same"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ids.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, n_chars long, text_crc32 long, same boolean")
