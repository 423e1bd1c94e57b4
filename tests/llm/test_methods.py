"""Methods without Spark: against plain versions, libraries and round trips."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece as library
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from finlake.llm import near_text, pages, quality, sentencepiece, token_files

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = ["the", "house", " ", "  ", "\n", "\t", "a", "ing", "été", "Straße", "12", "7½", "don't", "''", "_x", "日本", "😀", "\x85", "…", "“q”", "²", "\u2028", "<|endoftext|>"]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(WORDS) + rng.choice(["", " "]) for _ in range(rng.randrange(12))) for _ in range(n)]


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece.Vocabulary.load(PIECES)


def test_viterbi_agrees_with_the_unigram_library(vocabulary):
    model = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        if p.type == sentencepiece.NORMAL:
            p.score = vocabulary.pieces[p.piece][0] / sentencepiece.UNIT
    unigram = library.SentencePieceProcessor(model_proto=model.SerializeToString())
    encoder = sentencepiece.Encoder(vocabulary)
    for text in [*texts(600, 1), "internationalization of houses", "x" * 50]:
        got = np.frombuffer(encoder.encode(text), np.int32).tolist()
        want = unigram.encode(text)
        # The library adds in single precision, so of cuts with nearly equal sums it may take another.
        score = lambda ids: sum(unigram.get_score(i) for i in ids)
        assert got == want or score(got) == pytest.approx(score(want), rel=1e-5), text


def test_stream_is_the_same_however_the_text_arrives_and_memory_is_bounded(vocabulary):
    for text in [*texts(100, 2), "hahahahah " * 300 + "tentententen, " * 300, "abcdefgh" * 2000, "▁" * 300, "", " "]:
        whole = list(sentencepiece.encode_stream(vocabulary, [text]))
        bits = list(sentencepiece.encode_stream(vocabulary, list(text)))
        memo = np.frombuffer(sentencepiece.Encoder(vocabulary).encode(text), np.int32).tolist()
        assert whole == bits == memo
        assert sentencepiece.decode(vocabulary, whole) == text.replace("▁", " ")
    stream, most = sentencepiece.Stream(vocabulary), 0
    for _ in range(5000):
        list(stream.feed("interesting"))
        most = max(most, len(stream.text))
    assert most < 20 * vocabulary.longest


def test_ids_by_word_are_the_ids_of_the_whole_text():
    with open(BYTES, encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    plain = ["", " ", "a", "\n", " a", "a ", "\na", "Ä é.ß1 2x\ny__ (z)\n", "×a ÷b", "a\u0241 b", "don't", "a\x00b \x7f"]
    some = [*plain, *texts(1500, 3), *(chr(c) + "a" + chr(c) + " " + chr(c) for c in [*range(0x20, 0x300), *range(0x300, 0x3100, 7)])]
    assert encoder.encode(pa.array([None, *plain[:6]], pa.string())) == [b"", *encoder.encode(pa.array(plain[:6]))]
    for text, got in zip(some, encoder.encode(pa.array(some))):
        assert np.frombuffer(got, np.int32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_new_pieces_go_through_the_library_many_to_a_text(monkeypatch):
    tokenizer = Tokenizer.from_file(BYTES)
    encoder = token_files.Encoder(tokenizer.to_str(), added=True)
    whole, sent = encoder.whole, []
    monkeypatch.setattr(encoder, "whole", lambda texts: (sent.extend(texts), whole(texts))[1])
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgXYZ\u00e9\u00df0123.,#_\x00", k=rng.randint(1, 9))) for _ in range(6000)]
    some = [["", " ", "\n"][i % 3].join(["", " ".join(words[i: i + 50]), ""]) for i in range(0, 6000, 50)]
    some += [" ", "\n", "a\n", " a", "a ", "long" * 20_000]
    want = [e.ids for e in tokenizer.encode_batch(some, add_special_tokens=False)]
    assert [np.frombuffer(got, np.int32).tolist() for got in encoder.encode(pa.array(some))] == want
    assert len(sent) * 20 < len({p for text in some for p in encoder.cut(text)})
    encoder.feed = None  # as for tokenizers that do not keep line feeds apart
    assert encoder.new([b" ", b"ab", b"\n", b" 12"]) == whole([" ", "ab", "\n", " 12"])


def test_added_tokens_that_hold_a_line_feed_are_not_made_by_joining_pieces():
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.add_tokens(["\nab"])
    encoder = token_files.Encoder(tokenizer.to_str(), added=True)
    some = ["x ab", "ab cd ab", "x\nab y"]
    want = [e.ids for e in tokenizer.encode_batch(some, add_special_tokens=False)]
    assert [np.frombuffer(got, np.int32).tolist() for got in encoder.encode(pa.array(some))] == want


def test_late_rounds_count_only_pairs_with_new_symbols(monkeypatch):
    rng = np.random.default_rng(4)
    words = [rng.integers(0, 20_000, rng.integers(1, 9)) for _ in range(30_000)]
    tokens = np.concatenate([words[i] for i in rng.zipf(1.1, 100_000) % 30_000]).astype(np.int32)
    counted, factorize = [], token_files.pd.factorize
    monkeypatch.setattr(token_files.pd, "factorize", lambda x: (counted.append(len(x)), factorize(x))[1])
    rules, sequence = token_files.compress(tokens, 20_000)
    assert len(counted) > 5 and sum(counted[-3:]) * 10 < max(counted)
    pairs = Counter(zip(sequence.tolist(), sequence[1:].tolist()))
    assert max(pairs.values()) < token_files.LEAST_COUNT
    shard = token_files.Shard(token_files.pack([1], [tokens.tobytes()], 20_000))
    assert shard.tokens().tolist() == tokens.tolist() and len(shard.rules) == len(rules)


@pytest.mark.parametrize("bits", [1, 2, 7, 8, 16, 17, 31, 32])
def test_symbols_of_any_width_are_packed(bits):
    symbols = np.random.default_rng(bits).integers(0, 1 << bits, token_files.PACKED + 123)
    data = token_files.packed_bits(symbols, bits)
    places = np.repeat(symbols, bits) >> np.tile(np.arange(bits), len(symbols)) & 1
    assert data == np.packbits(places.astype(np.uint8), bitorder="little").tobytes()
    assert token_files.unpacked_bits(np.frombuffer(data, np.uint8), bits, len(symbols)).tolist() == symbols.tolist()


def test_rules_are_measured_many_at_a_time():
    tokens = (np.random.default_rng(2).zipf(1.3, 200_000) % 500).astype(np.int32)
    rules, _ = token_files.compress(tokens, 500)
    lengths = []
    for pair in rules.tolist():
        lengths.append(sum(1 if x < 500 else lengths[x - 500] for x in pair))
    assert token_files.rule_lengths(rules, 500).tolist() == lengths
    assert len(list(token_files._runs(rules, 500))) * 50 < len(rules)
    with pytest.raises(ValueError, match="later"):
        token_files.rule_lengths(np.array([[1, 2], [3, 12]]), 10)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=60), max_size=12))
def test_shards_expand_to_their_tokens(docs):
    parts = [np.array(d * 40, np.int32) for d in docs]
    ids = [None if i == 0 else i for i in range(len(parts))]
    shard = token_files.Shard(token_files.pack(ids, [p.tobytes() for p in parts], 10))
    assert shard.tokens().tolist() == [x for p in parts for x in p.tolist()]
    assert [shard.document(i).tolist() for i in range(len(parts))] == [p.tolist() for p in parts]
    assert np.where(shard.has_id, shard.ids, -1).tolist() == [-1 if i is None else i for i in ids]


def test_frequent_pairs_become_rules():
    tokens = np.tile(np.array([5, 6, 7, 8], np.int32), 5000)
    rules, sequence = token_files.compress(tokens, 10)
    assert len(sequence) < len(tokens) / 50
    flat, begin, lengths = token_files.expansions(rules, 10)
    out = [t for s in sequence.tolist() for t in ([s] if s < 10 else flat[begin[s - 10]: begin[s - 10] + lengths[s - 10]].tolist())]
    assert out == tokens.tolist()


def test_shingle_sets_are_those_of_the_words():
    some = ["", "  \n", "One two", "a b c d e", "A b c d E f a b c d e f", "x\u00a0y z\x0bw v u", "É é É é É é", "a b c d e " * 200]
    raw = "".join(some).encode()
    at = np.cumsum([0, *(len(t.encode()) for t in some)])
    sets = list(near_text.distinct_sets(np.frombuffer(raw, np.uint8), at))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, got in zip(some, sets):
        words = [w for w in text.translate(lower).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
        want = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        assert len(got) == len(want), text
    alone = list(near_text.distinct_sets(np.frombuffer(b"A B c D e", np.uint8), np.array([0, 9])))
    assert alone[0].tolist() == sets[3].tolist()


def test_isotonic_levels_rise_and_keep_the_mean():
    y, w = np.array([0.2, 0.1, 0.5, 0.4, 0.9]), np.array([1.0, 1, 2, 1, 1])
    levels = quality.isotonic(y, w)
    assert (np.diff(levels) >= 0).all() and (levels * w).sum() == pytest.approx((y * w).sum())
    assert levels.tolist() == pytest.approx([0.15, 0.15, 1.4 / 3, 1.4 / 3, 0.9])


LONG = "This is the sentence that the reader of the page has come for, and it is long enough to be judged by itself. " * 2


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize("body, want", [
    (f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{LONG}</p><p>Short end.</p></article><footer>(c)</footer>", ["Title", LONG, "Short end."]),
    (f"<div class='ad box'>Buy</div><div><p>{LONG}</p><p>Tail.</p></div><div id=comments><p>{LONG}</p></div>", [LONG, "Tail."]),
    (f"<header>Site of the year</header><main><p>{LONG}</p><form><p>Mail</p></form><aside>More</aside></main>", [LONG]),
    ("<article><p>One &amp; two&nbsp;&#51;<br>four</p></article>", ["One & two 3 four"]),
    ("<article><script>var t='</p>';</script><p>a<!-- no -->b</p></article>", ["ab"]),
    ("<article><p>cut &am", ["cut &am"]),
    ("<p>Only this.</p>", ["Only this."]),
    (f"<ul><li><a href=a>one link here</a></li></ul><p>{LONG}</p>", [LONG]),
    (f"<article><p>{LONG}</p><div class='cookie-notice'>We use cookies</div><p>1 < 2 and 3 > 2</p></article>", [LONG, "1 < 2 and 3 > 2"]),
    ("<nav>x</nav>", []), ("", []),
])
def test_main_text(body, want):
    assert pages.extract(page(body)) == "\n\n".join(" ".join(w.split()) for w in want)
