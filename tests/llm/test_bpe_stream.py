"""The BPE transducer against the tokenizers library, and its lookahead against brute force over small merge lists."""

import hashlib
import itertools
import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from finlake.llm import bpe_stream
from finlake.llm.queries import QUERIES
from tests.oracle import connect

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "a", "b", "th", "ing", "'", "'s", "'re", "!", "?", ".", " ", "\n", "é", "é", "İ", "日本", "1", "٣", "<|endoftext|>", "<|end", "x",
    "가", " ", "\u0085", "़", "क", "\U0001f600", "ß", "Σ", "‍", "\U00016d67", "ﬁ", "́", "ᅡ", "ᄀ",
]


@pytest.fixture(scope="module")
def bpe():
    with open(PATH, encoding="utf-8") as file:
        return bpe_stream.Bpe(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(bpe, chunks):
    stream = bpe_stream.TextStream(bpe)
    return np.frombuffer(b"".join([*map(stream.feed, chunks), stream.finish()]), "<u4").tolist()


@pytest.mark.parametrize("window, open_run", [(1 << 16, 1 << 10), (16, 8), (40, 16)])
def test_ids_are_the_library_s_however_the_text_arrives(bpe, library, monkeypatch, window, open_run):
    monkeypatch.setattr(bpe_stream, "WINDOW", window)
    monkeypatch.setattr(bpe_stream, "OPEN_RUN", open_run)
    rng = random.Random(window)
    for _ in range(400):
        text = "".join(rng.choices(PARTS, k=rng.randrange(60)))
        cuts = sorted(rng.randrange(len(text) + 1) for _ in range(rng.randrange(5)))
        chunks = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(bpe, [text]) == ids_of(bpe, chunks) == want
        decoder = bpe_stream.TextDecoder(bpe)
        parts = [decoder.feed(np.array(want[i: i + 3], np.int64)) for i in range(0, len(want), 3)]
        assert "".join(parts) + decoder.finish() == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["x" * 60_000, "the" * 20_000, "!'" * 20_000, "日本語" * 8_000, "é" * 9_000, "tionaleers" * 6_000])
def test_long_words_leave_the_transducer_while_they_arrive(bpe, library, text, monkeypatch):
    most = 0
    feed = bpe_stream.Transducer.feed

    def watched(self, chars):
        nonlocal most
        out = feed(self, chars)
        most = max(most, len(self.held))
        return out

    monkeypatch.setattr(bpe_stream.Transducer, "feed", watched)
    monkeypatch.setattr(bpe_stream, "WINDOW", 4096)
    assert ids_of(bpe, [text]) == library.encode(text, add_special_tokens=False).ids
    assert most <= 4 * bpe.lookahead + 4 * 4096


def random_merges(rng, size):
    tokens, rules = list("ab"), []
    while len(rules) < size:
        u, v = rng.choice(tokens), rng.choice(tokens)
        if u + v not in tokens:
            rules.append((u, v))
            tokens.append(u + v)
    return rules


def plain(rules, text):
    tokens = list(text)
    for u, v in rules:
        i, out = 0, []
        while i < len(tokens):
            pair = tokens[i: i + 2] == [u, v]
            out.append(u + v if pair else tokens[i])
            i += 2 if pair else 1
        tokens = out
    return tokens


def test_tokens_behind_the_lookahead_never_change():
    rng = random.Random(7)
    for _ in range(150):
        rules = random_merges(rng, rng.randrange(1, 9))
        bound = bpe_stream.sufficient_lookahead([(u, v, i) for i, (u, v) in enumerate(rules)])
        text = "".join(rng.choices("ab", k=bound + 8))
        for more in map("".join, itertools.product("ab", repeat=5)):
            place = 0
            longer = plain(rules, text + more)
            for i, token in enumerate(plain(rules, text)):
                place += len(token)
                if place <= len(text) - bound:
                    assert longer[i] == token


def test_no_lookahead_where_a_token_is_made_in_two_ways():
    rules = [("a", "b", 0), ("b", "a", 1), ("ab", "a", 2), ("a", "ba", 3)]
    assert bpe_stream.sufficient_lookahead(rules) is None
    assert bpe_stream.sufficient_lookahead([("ab", "a", 0), ("a", "b", 1)]) is None
    assert bpe_stream.sufficient_lookahead([]) == 0


def test_both_merge_searches_agree(bpe):
    rng = random.Random(3)
    for _ in range(200):
        symbols = rng.choices("etaoinshrdlu", k=rng.randrange(1, 120))
        assert bpe._short(symbols) == bpe._long(symbols)


def test_files_of_another_kind_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        with pytest.raises(ValueError, match="pre-tokenizer"):
            bpe_stream.Bpe(file.read())
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"]["dropout"] = 0.1
    with pytest.raises(ValueError, match="dropout"):
        bpe_stream.Bpe(json.dumps(spec))


def test_byte_level_decoder_holds_an_open_character():
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["decoder"] = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}
    definition = json.dumps(spec)
    bpe, library = bpe_stream.Bpe(definition), Tokenizer.from_str(definition)
    rng = random.Random(9)
    for _ in range(300):
        ids = rng.choices(range(600), k=12) + library.encode("héé 日本 <|endoftext|>", add_special_tokens=False).ids
        decoder = bpe_stream.TextDecoder(bpe)
        assert "".join(decoder.feed(np.array([i])) for i in ids) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


def test_query_gives_the_library_s_digests(spark, sf, library):
    texts = dict(connect(sf).execute("select doc_id, coalesce(text, '') from documents").fetchall())
    rows = QUERIES["op11_bpe_stream"](spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_edges(spark, library):
    rows = [(1, "Hello  World"), (1, "Hello  World"), (2, None), (3, ""), (None, "x"), (4, "y" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"token_ids": F.lit("old"), "n_tokens": F.lit(None), "a.b": F.lit(1), "m": F.create_map(F.lit("k"), F.lit("v"))}
    )
    digests = bpe_stream.round_trips(docs, PATH).collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in digests][:5] == [(1, 2), (1, 2), (2, 0), (3, 0), (None, 1)]
    assert digests[2]["ids_sha256"] == digests[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    ids = bpe_stream.encoded(docs, PATH)
    assert sorted(ids.columns) == sorted(docs.columns)
    back = bpe_stream.decoded(ids.withColumn("decoded", F.lit(0)), PATH).collect()
    assert [r["decoded"] for r in back][:5] == ["hello</w> world</w>"] * 2 + ["", "", "x</w>"]
    assert [r["token_ids"] for r in back] == [library.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    assert bpe_stream.round_trips(docs.limit(0), PATH).count() == 0
    assert bpe_stream.decoded(ids.withColumn("token_ids", F.lit(None).cast("array<int>")), PATH).where("decoded is null").count() == 6
