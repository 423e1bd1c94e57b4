"""Inputs that once lost or changed data: look-alike words, wide vocabularies, vectors of several lengths, odd columns, cut texts."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from finlake.llm import knn, mixing, near_text, sentencepiece, token_files
from finlake.llm.shared import Words, stretch_hashes, text_bytes
from tests.llm.test_methods import BYTES, PIECES


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [8, 64, 1024, 2048, 8192])
def test_words_that_mirror_each_other_have_two_hashes(n):
    words = Words(*text_bytes(pa.array([*thue_morse(n), " ".join(thue_morse(n))])))
    assert len(set(words.hashes[:2].tolist())) == 2 and words.hashes[:2].tolist() == words.hashes[2:].tolist()


def test_hashes_tell_stretches_apart_by_every_byte_and_length():
    raw = np.frombuffer(bytes(40) + bytes(range(200)), np.uint8)
    first, sizes = zip(*[(i, n) for i in (0, 40, 41, 90) for n in range(1, 40)])
    hashes = stretch_hashes(raw, np.array(first), np.array(sizes)).tolist()
    assert len(set(hashes)) == len({raw[a: a + n].tobytes() for a, n in zip(first, sizes)})


@pytest.mark.parametrize("n", [1024, 2048])
def test_token_files_of_words_that_mirror_each_other(spark, n):
    tokenizer = Tokenizer.from_file(BYTES)
    texts = list(thue_morse(n))
    want = [zlib.crc32(np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes()) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert [r["ids_crc32"] for r in token_files.written_and_read(docs, BYTES).orderBy("doc_id").collect()] == want


@pytest.mark.parametrize("n", [1024, 2048])
def test_texts_that_share_no_word_are_not_linked(spark, n):
    docs = spark.createDataFrame(list(enumerate(thue_morse(n))), "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in near_text.near_duplicates(docs).collect()} == {(0, 0, True), (1, 1, True)}


@pytest.mark.parametrize("terminals", [10, 65_536, 70_000, 1 << 20])
def test_shards_hold_ids_of_any_vocabulary(terminals):
    rng = np.random.default_rng(terminals)
    parts = [rng.integers(terminals - 9, terminals, n).astype(np.int32) for n in (0, 1, 5000, 40_000)]
    shard = token_files.Shard(token_files.pack([1, 2, None, 4], [p.tobytes() for p in parts], terminals))
    assert shard.tokens().tolist() == np.concatenate(parts).tolist()
    assert [shard.document(i).tolist() for i in range(4)] == [p.tolist() for p in parts]
    with pytest.raises(ValueError, match="beyond"):
        token_files.pack([1], [np.array([terminals], np.int32).tobytes()], terminals)


def test_pairs_become_rules_as_soon_as_they_pay():
    tokens = np.concatenate([[5, 6, 100 + i] for i in range(7)]).astype(np.int32)
    assert token_files.compress(tokens, 200)[0].tolist() == [[5, 6]]
    assert len(token_files.compress(tokens[:-3], 200)[0]) == 0


def test_token_files_stay_where_they_are_written(spark, folder):
    docs = spark.createDataFrame([(2, "b"), (1, "a")], "doc_id long, text string")
    token_files.write(docs, BYTES, f"{folder}/tokens")
    rows = token_files.read(spark.read.parquet(f"{folder}/tokens")).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in rows] == [(1, 0, 2), (2, 2, 2)]


def test_vectors_of_every_length_find_their_like(spark):
    rng = np.random.default_rng(5)
    vectors = {i: rng.normal(size=2 if i % 3 else 3).tolist() for i in range(60)} | {100: [], 101: [1.0], 150: [2.0]}
    rows = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = Counter(map(tuple, knn.top_k(rows, F.col("vec_id") % 10 == 0, 4).collect()))
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in vectors.items()}
    want = Counter()
    for q, v in whole.items():
        scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in whole.items() if i != q and len(x) == len(v))
        want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:4]) if q % 10 == 0)
    assert got == want


def test_products_beyond_double_precision_are_exact_and_beyond_64_bits_an_error():
    rng = np.random.default_rng(1)
    big = np.floor(rng.normal(size=(3, 4)) * 2.0**30)
    want = [[sum(int(a) * int(b) for a, b in zip(p, q)) for q in big] for p in big]
    assert knn._products(big, big).tolist() == want
    with pytest.raises(OverflowError):
        knn._products(np.full((1, 2), 2.0**40), np.full((1, 2), 2.0**40))


ODD = {"__id": 1, "__rows": 2, "__n": 3, "__take": "t", "__row": 4, "of_id": 5, "times": 6, "taken": 7, "copy": 8, "rows": 9, "id": 10, "a.b": 11, "c0": 12}


@pytest.fixture()
def odd(spark):
    rows = [(i, f"{i} one two three four five six " * 20, "s%d" % (i % 2)) for i in range(40)]
    rows += [(3, "again " * 90, "s1"), (3, rows[3][1], "s1"), (None, "no id " * 30, None), (None, "no id " * 30, None), (50, None, "s1"), (51, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({k: F.lit(v) for k, v in ODD.items()})
    return docs.withColumn("tags", F.create_map(F.lit("k"), F.col("text")))


@pytest.mark.parametrize("stage", [near_text.one_of_each_group, mixing.mixed, lambda d: sentencepiece.encoded(d.withColumn("token_ids", F.lit(1)), PIECES).drop("token_ids")])
def test_stages_take_columns_of_any_name_and_type(odd, stage):
    out = stage(odd)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    rows = out.collect()
    given = {(r["doc_id"], r["text"]) for r in odd.collect()}
    assert rows and {(r["doc_id"], r["text"]) for r in rows} <= given
    assert all(r["tags"] == {"k": r["text"]} and r["__id"] == 1 and r["a.b"] == 11 for r in rows)
    assert stage(odd.limit(0)).count() == 0


@pytest.mark.parametrize("most", [10**6, 0])
def test_the_mix_takes_whole_documents_near_its_quota(spark, monkeypatch, most):
    monkeypatch.setattr(mixing, "BROADCAST_IDS", most)
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 90))) + f"  end{i}", "s%d" % (i * i % 5)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    texts = {i: t for i, t, _ in rows}
    plan = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    got = Counter()
    for r in mixing.mixed(docs).collect():
        assert r["text"] == texts[r["doc_id"]]
        got[r["doc_id"]] += 1
    assert max(got.values()) <= 3
    for source in {s for *_, s in rows}:
        mine = [r for r in plan.values() if r["source"] == source]
        words = sum(got[r["doc_id"]] * r["size"] for r in mine)
        assert abs(words - sum(r["taken"] for r in mine)) <= max(r["size"] for r in mine)
    assert all(abs(got[i] * r["size"] - r["taken"]) <= r["size"] / 2 for i, r in plan.items())
