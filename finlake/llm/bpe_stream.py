"""BPE encoding as a streaming transducer of bounded lookahead, and decoding by a byte-to-text state machine.

A run of symbols (one word of the pre-tokenizer) arrives bit by bit. The merge list alone says how far from the end of what has
arrived a later symbol can still change tokens: its sufficient lookahead. Tokens that end further back are stable and are given
out at once, so memory stays constant however long a word or a text is.

Why the bound holds: run the merges, in order of their ranks, on two texts that share a beginning. Their common tokens can
shrink at rule ``(u, v)`` only where ``u`` ends the common part and ``v`` follows it in one of the two, by the length of ``u``;
and ``v`` then begins with the symbols that the shrinking before it uncovered, the ``u`` of an earlier rule. So the loss is at
most the greatest sum of ``len(u)`` over chains of rules of rising rank in which each ``v`` begins with the ``u`` before it.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm.shared import trim, worker_memo

#: Characters that are normalized and cut into words at a time.
WINDOW = 1 << 16
#: A word that is still open at the end of a window goes on as a stream when it is longer than this.
OPEN_RUN = 1 << 10
#: Words remembered by a worker, and the longest of them.
MEMO_WORDS = 400_000
MEMO_LENGTH = 64
#: Up to so many symbols the least rank is looked for in all pairs; beyond, in a heap.
SHORT = 48
NEVER = 1 << 60
#: A decided word ends before the window's end, and its first characters cannot become a longer contraction.
CONTRACTION = 3
#: Fixed value: the word patterns that this stream knows how to cut.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same pattern over characters whose kind no version of Unicode changes, that normal form C leaves as they
#: are among themselves, and that are lower-cased one by one.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f\u0400-\u0481\u048a-\u052f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
SPACES, NUMBERS = "\t-\r \x85\xa0", "0-9\xb2\xb3\xb9\xbc-\xbe"
PLAIN = re.compile(f"[\x00-\xff\u2010-\u2027\u3001\u3002{LETTERS}]*")
PLAIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")


#: Fixed value: the byte-level alphabet shows printable bytes as themselves, the others from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SHOWN = {chr(b): b for b in PRINTABLE} | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}
SHOWS = {b: c for c, b in SHOWN.items()}


class Bpe:
    """What encoding needs of a tokenizer file: merges by pair, ids, and the merge list's sufficient lookahead."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        model = spec["model"]
        self._check(spec, model)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.ranks: dict[tuple[str, str], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault((left, right), rank)
        self.lookahead = sufficient_lookahead([(*pair, rank) for pair, rank in self.ranks.items()], self.suffix)
        whole = Tokenizer.from_str(definition)
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_at = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.name = f"bpe-{zlib.crc32(definition.encode())}-{len(definition)}"
        size = max([*self.ids.values(), *self.added.values()], default=-1) + 1
        self.tokens = [""] * size
        for token, i in [*self.ids.items(), *self.added.items()]:
            self.tokens[i] = token
        self.joined_by_space = spec["decoder"] is None

    @staticmethod
    def _check(spec: dict, model: dict) -> None:
        """Refuse files whose settings this transducer does not follow."""
        parts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        kinds = [p["type"] for p in parts]
        norms = spec["normalizer"] or {}
        steps = [n["type"] for n in norms.get("normalizers", [norms] if norms else [])]
        strange = [key for key in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(key)]
        if model["type"] != "BPE" or strange:
            raise ValueError(f"not a plain BPE model: {strange or model['type']}")
        if kinds != ["Split", "ByteLevel"] or parts[0]["pattern"].get("Regex") != PATTERN or parts[1]["use_regex"] or parts[1]["add_prefix_space"]:
            raise ValueError("the pre-tokenizer has to cut runs of letters, single digits and runs of signs, then map bytes")
        if set(steps) - {"NFC", "Lowercase", "Replace"} or any(n["type"] == "Replace" and n["pattern"] != {"Regex": "\\s+"} for n in norms.get("normalizers", [])):
            raise ValueError(f"a normalizer that may look further than one character: {steps}")
        if (spec["decoder"] or {"type": "ByteLevel"})["type"] != "ByteLevel" or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("a decoder or added tokens of another kind")

    def merged(self, symbols: list[str]) -> list[str]:
        """Tokens of a whole run of symbols."""
        return self._short(symbols) if len(symbols) <= SHORT else self._long(symbols)

    def _short(self, symbols: list[str]) -> list[str]:
        tokens, find = list(symbols), self.ranks.get
        ranks = [find(pair, NEVER) for pair in zip(tokens, tokens[1:])]
        while ranks and (least := min(ranks)) < NEVER:
            i = ranks.index(least)
            tokens[i: i + 2] = [tokens[i] + tokens[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = find((tokens[i], tokens[i + 1]), NEVER)
            if i:
                ranks[i - 1] = find((tokens[i - 1], tokens[i]), NEVER)
        return tokens

    def _long(self, symbols: list[str]) -> list[str]:
        tokens: list[str | None] = list(symbols)
        n, find = len(tokens), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i) for i, pair in enumerate(zip(tokens, tokens[1:])) if (rank := find(pair)) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if tokens[i] is None or j >= n or find((tokens[i], tokens[j])) != rank:
                continue  # the pair that stood here has changed since
            tokens[i], tokens[j] = tokens[i] + tokens[j], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := find((tokens[i], tokens[k]))) is not None:
                    heappush(heap, (rank, i))
            h = before[i]
            if h >= 0 and (rank := find((tokens[h], tokens[i]))) is not None:
                heappush(heap, (rank, h))
        return [t for t in tokens if t is not None]


def sufficient_lookahead(rules: Iterable[tuple[str, str, int]], suffix: str = "") -> int | None:
    """Symbols behind a token that must have arrived before it is stable, whatever follows; None if there is no such number.

    There is one where every token is made by one rule only, after its two parts: ranks then rise in the order in which merges
    happen, on which the bound rests.
    """
    rules = sorted(rules, key=lambda rule: rule[2])
    made = {u + v: rank for u, v, rank in rules}
    if len(made) < len(rules) or any(made.get(part, -1) >= rank for u, v, rank in rules for part in (u, v)):
        return None
    most: dict[str, int] = {}
    bound = 0
    for u, v, _ in rules:
        inner = v.removesuffix(suffix) if suffix else v
        chain = len(u) + max((most.get(v[:end], 0) for end in range(1, len(inner) + 1)), default=0)
        most[u] = max(most.get(u, 0), chain)
        bound = max(bound, chain)
    return bound


class Transducer:
    """Ids of one word whose characters arrive bit by bit; symbols are the bytes of their UTF-8, as the tokenizer shows them."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.held: list[str] = []

    def feed(self, chars: str) -> list[int]:
        """Take characters; the ids of the tokens that no later one can change."""
        self.held.extend(map(SHOWS.__getitem__, chars.encode()))
        ahead = self.bpe.lookahead
        if ahead is None or len(self.held) <= 4 * ahead + 1:
            return []
        out: list[int] = []
        place, stable = 0, len(self.held) - 1 - ahead  # the last symbol may yet be the end of the word
        for token in self.bpe.merged(self.held[:-1]):
            if place + len(token) > stable:
                break
            place += len(token)
            out.append(self.bpe.ids[token])
        del self.held[:place]
        return out

    def finish(self) -> list[int]:
        """The ids of what is left; the word ends here."""
        if not self.held:
            return []
        self.held[-1] += self.bpe.suffix
        tokens = self.bpe.merged(self.held)
        self.held = []
        return [self.bpe.ids[t] for t in tokens]


def divides(char: str) -> bool:
    """Whether normal form C never joins or reorders ``char`` with what stands before it."""
    if char < "̀":
        return True
    if "ᄀ" <= char <= "ᇿ" or "ힰ" <= char <= "퟿":
        return False
    return unicodedata.category(char)[0] in "LNPSZ" and unicodedata.combining(char) == 0


class TextStream:
    """Ids, as little-endian 32-bit integers, of a text that arrives bit by bit.

    The strings of added tokens become those tokens. What stands between is normalized and cut into words by the tokenizer's
    own normalizer and pre-tokenizer, a window at a time: windows end where normalization joins nothing, and a word open at a
    window's end waits, or goes on through its own transducer when it is long. Words that are complete go through a transducer
    when they are new to the worker and are remembered, up to a bounded number.
    """

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.words: dict[str, bytes] = worker_memo(bpe.name)
        self.asked = self.new = 0  # words looked up, and of these the ones not remembered
        self._begin()

    def _begin(self) -> None:
        self.raw = self.normal = self.open = ""
        self.run: Transducer | None = None

    def feed(self, chars: str) -> bytes:
        out = []
        for start in range(0, len(chars), WINDOW):
            self.raw += chars[start: start + WINDOW]
            out.append(self._added())
            if len(self.raw) >= WINDOW:
                out.append(self._window())
        return b"".join(out)

    def finish(self) -> bytes:
        """The ids of what is left; the next text begins."""
        out = self._cut(self.raw, True)
        self._begin()
        return out

    def _added(self) -> bytes:
        if self.bpe.added_at is None:
            return b""
        out, place = [], 0
        for found in self.bpe.added_at.finditer(self.raw):
            out.append(self._cut(self.raw[place: found.start()], True))
            out.append(array("I", [self.bpe.added[found.group()]]).tobytes())
            place = found.end()
        self.raw = self.raw[place:]
        return b"".join(out)

    def _window(self) -> bytes:
        """Cut the characters at hand, but for an end that may be the beginning of an added token or joins what follows."""
        end = len(self.raw)
        for token in self.bpe.added:
            for size in range(1, len(token)):
                if self.raw.endswith(token[:size]):
                    end = min(end, len(self.raw) - size)
        end = min(end, len(self.raw) - 1)
        while end > 0 and not divides(self.raw[end]):
            end -= 1
        window, self.raw = self.raw[:end], self.raw[end:]
        return self._cut(window, False) if window else b""

    def _cut(self, window: str, last: bool) -> bytes:
        """Ids of the words that are complete after ``window``; all are where it is the ``last`` before an added token or the end."""
        plain = PLAIN.fullmatch(window) is not None
        if plain and last and not self.run and not self.normal:
            return self._words(PLAIN_WORDS.findall(window.lower()))
        if window and self.bpe.normalizer:
            window = window.lower() if plain else self.bpe.normalizer.normalize_str(window)
        self.normal += window
        shown = self.open + self.normal  # an open run shows by one character of its kind
        if PLAIN.fullmatch(shown):
            spans = [m.span() for m in PLAIN_WORDS.finditer(shown)]
        else:
            spans = [span for _, span in self.bpe.pre_tokenizer.pre_tokenize_str(shown)]
        out: list[bytes] = []
        if self.run:
            _, end = spans.pop(0)
            out.append(array("I", self.run.feed(shown[1:end])).tobytes())
            if end == len(shown) and not last:
                self.normal = ""
                return out[0]
            out.append(array("I", self.run.finish()).tobytes())
            self.run, self.open = None, ""
        whole = len(spans)
        if not last:
            while whole and (spans[whole - 1][1] == len(shown) or spans[whole - 1][0] + CONTRACTION > len(shown)):
                whole -= 1
        out.append(self._words([shown[a:b] for a, b in spans[:whole]]))
        self.normal = shown[spans[whole][0]:] if whole < len(spans) else ""
        if len(self.normal) > OPEN_RUN and whole == len(spans) - 1:
            self.run = Transducer(self.bpe)
            out.append(array("I", self.run.feed(shown[slice(*spans[-1])])).tobytes())
            self.open = "a" if len(self.bpe.pre_tokenizer.pre_tokenize_str("a" + self.normal[0])) == 1 else "!"
            self.normal = ""
        return b"".join(out)

    def _words(self, words: list[str]) -> bytes:
        ids = list(map(self.words.get, words))
        self.asked += len(words)
        if None in ids:
            trim(self.words, MEMO_WORDS)
            run = Transducer(self.bpe)
            for i, word in enumerate(words):
                if ids[i] is None and (known := self.words.get(word)) is not None:
                    ids[i] = known
                elif ids[i] is None:
                    self.new += 1
                    ids[i] = array("I", run.feed(word) + run.finish()).tobytes()
                    if len(word) <= MEMO_LENGTH:
                        self.words[word] = ids[i]
        return b"".join(ids)


class TextDecoder:
    """Text of ids that arrive bit by bit: bytes of tokens go through a UTF-8 state machine that holds an open character.

    Without a decoder in the tokenizer file, the text is the tokens' own strings with a space between, as the library has it;
    with the byte-level one, it is the bytes that the tokens stand for.
    """

    def __init__(self, bpe: Bpe):
        if bpe.joined_by_space:
            parts = [b" " + t.encode() for t in bpe.tokens]
        else:
            parts = [bytes(SHOWN[c] for c in t) if all(c in SHOWN for c in t) else t.encode() for t in bpe.tokens]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(parts), np.uint8)
        self.lead = int(bpe.joined_by_space)
        self.finish()

    def feed(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        got = self.flat[places].tobytes()
        skip, self.skip = self.skip, 0
        return self.machine.decode(got[skip:])

    def finish(self) -> str:
        """What an unfinished character leaves; the next text begins."""
        left = self.machine.decode(b"", final=True) if hasattr(self, "machine") else ""
        self.machine, self.skip = codecs.getincrementaldecoder("utf-8")("replace"), self.lead
        return left


# ---- tables ----


def _shipped(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    Bpe(definition)  # a file of another kind fails here, not in every task
    return docs.sparkSession.sparkContext.broadcast(definition)


def _loaded(definition: str) -> Bpe:
    """The tables of a tokenizer file, built once a worker: they are many small objects, kept out of the collector's rounds."""
    kept = worker_memo("bpe-files")
    if definition not in kept:
        kept[definition] = Bpe(definition)
        gc.freeze()
    return kept[definition]


def _chars(scalar: pa.Scalar) -> Iterator[str]:
    text = scalar.as_py() or ""
    for start in range(0, len(text), WINDOW):
        yield text[start: start + WINDOW]


def _with_column(docs: DataFrame, column: str, kind: T.DataType) -> tuple[DataFrame, list[str], T.StructType]:
    """``docs`` without ``column`` under plain names, the names they had, and the schema with one more column."""
    kept = [c for c in docs.columns if c != column]
    rows = docs.select(*[F.col(f"`{c.replace('`', '``')}`") for c in kept]).toDF(*[f"c{i}" for i in range(len(kept))])
    return rows, kept, T.StructType([*rows.schema.fields, T.StructField("added", kind)])


def encoded(docs: DataFrame, path: str, column: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each whole ``text`` as array<int> in ``column``, which replaces one of that name.

    Null and empty texts have no ids. Rows are kept as they are, repeated ones and those with nulls elsewhere too.
    """
    shipped = _shipped(docs, path)
    rows, kept, schema = _with_column(docs, column, T.ArrayType(T.IntegerType()))
    place = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = TextStream(_loaded(shipped.value))
        for batch in batches:
            parts = [b"".join([*map(stream.feed, _chars(t)), stream.finish()]) for t in batch.column(place)]
            ends = np.cumsum([0, *map(len, parts)]) // 4
            ids = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(np.frombuffer(b"".join(parts), np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=schema.names)

    return rows.mapInArrow(run, schema).toDF(*kept, column)


def decoded(docs: DataFrame, path: str, ids: str = "token_ids", column: str = "decoded") -> DataFrame:
    """``docs`` with the text of the array ``ids`` in ``column``, which replaces one of that name. Null ids give a null text."""
    shipped = _shipped(docs, path)
    rows, kept, schema = _with_column(docs, column, T.StringType())
    place = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = TextDecoder(_loaded(shipped.value))
        for batch in batches:
            texts = [
                decoder.feed(row.values.to_numpy(zero_copy_only=False)) + decoder.finish() if row.is_valid else None
                for row in batch.column(place)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema).toDF(*kept, column)


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """Encode every whole text of ``docs (doc_id, text)`` and decode its ids, window by window; one row per row.

    ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit integers) and ``decoded_sha256`` (of the decoded
    text in UTF-8). Null and empty texts have no ids and decode to the empty text. Null ids and repeated rows are kept; an empty
    table gives an empty result. Other columns are not read.
    """
    shipped = _shipped(docs, path)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(shipped.value)
        stream, decoder = TextStream(bpe), TextDecoder(bpe)
        for batch in batches:
            counts, sums, texts = [], [], []
            for scalar in batch.column(1):
                n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
                for got in (*map(stream.feed, _chars(scalar)), stream.finish()):
                    n += len(got) // 4
                    of_ids.update(got)
                    of_text.update(decoder.feed(np.frombuffer(got, "<u4")).encode())
                of_text.update(decoder.finish().encode())
                counts.append(n)
                sums.append(of_ids.hexdigest())
                texts.append(of_text.hexdigest())
            columns = [pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
