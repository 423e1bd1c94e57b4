"""Ranked search against its SQL on the given tables and against a plain search on random ones."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from finlake.llm import lexical
from finlake.llm.shared import stored, table

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k):
    bags = [(doc_id, Counter(TERM.findall((text or "").translate(LOWER)))) for doc_id, text in docs]
    bags = [(doc_id, bag, bag.total()) for doc_id, bag in bags if bag]
    n_docs, words = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item_id, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for doc_id, bag, n in bags:
            m = 75 + 25 * n * n_docs // words
            score = 0
            for term, times in asked.items():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += times * w * (1_000_000_000 * bag[term] // (1000 * bag[term] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, doc_id, -s) for i, (s, _, _, doc_id) in enumerate(sorted(scored)[:k])]
    return out


def made(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "日本", "A1", "a1", "ZZ"]
    heavy = [1 / (i + 1) for i in range(len(vocabulary))]
    return [" ".join(rng.choices(vocabulary, heavy, k=rng.choice([0, 1, 3, 20, 200]))) for _ in range(n)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("passes, unpacked", [(500_000, 1 << 25), (60, 64)])
def test_ranks_are_those_of_a_plain_search(spark, monkeypatch, passes, unpacked):
    monkeypatch.setattr(lexical, "PASS_TERMS", passes)
    monkeypatch.setattr(lexical, "UNPACKED_BYTES", unpacked)
    monkeypatch.setattr(lexical, "MOST_DOCS", 16)
    texts = made(1, 300, 150)
    docs = [(i % 250, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "?!"), (None, texts[4]), (None, texts[5]), (903, "w1 " * 4000)]
    items = [(i, t) for i, t in enumerate(made(2, 12, 150))] + [(3, "W1 w2 w1"), (None, "w3"), (50, None), (51, "absent"), (52, "É日本")]
    got = lexical.ranked(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumns({"item": F.lit(1), "rank": F.lit("x"), "score": F.lit(0)}),
        spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit(7)), 20,
    )
    assert rows_of(got) == sorted(plain(docs, items, 20), key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    none = "x long, text string"
    assert lexical.ranked(docs, spark.createDataFrame([], none).toDF("item_id", "text")).count() == 0
    assert lexical.ranked(spark.createDataFrame([], none).toDF("doc_id", "text"), items).count() == 0
    assert lexical.ranked(docs.withColumn("text", F.lit("?")), items).count() == 0


def test_bitmaps_overestimate_and_exclude_most(spark):
    """No document that has a term is missing from its bitmaps, and few others are in them."""
    texts = made(4, 400, 3000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    false = marked = 0
    for row in lexical.index(docs).collect():
        slices = np.frombuffer(row["slices"], np.uint8).reshape(row["rows"], -1)
        terms, counts = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["counts"], "<u4")
        starts = row["starts"]
        every = np.unique(terms)
        for i, level in enumerate(lexical.LEVELS):
            shown = np.unpackbits(lexical.bitmaps(slices, every, i), axis=1, count=len(row["ids"])).astype(bool)
            there = np.zeros_like(shown)
            for d in range(len(row["ids"])):
                part = slice(starts[d], starts[d + 1])
                there[np.searchsorted(every, terms[part][counts[part] >= level]), d] = True
            assert not (there & ~shown).any()
            false, marked = false + (shown & ~there).sum(), marked + shown.size
    assert false < 0.05 * marked


def test_documents_are_excluded_by_bounds_alone(spark, monkeypatch):
    """The bounds of excluded documents are below the last rank's score: scoring everything gives the same rows."""
    sf = "/root/testdata/sf0.01"
    docs, items = table(spark, sf, "documents").limit(400), table(spark, sf, "benchmark").limit(10)
    docs = stored(docs, "lexical-test")
    pruned = rows_of(lexical.ranked(docs, items, 5))
    monkeypatch.setattr(lexical._Item, "bounds", lambda self, slices, steps: np.full(steps.shape[1], 1e18))
    assert rows_of(lexical.ranked(docs, items, 5)) == pruned


def test_rows_of_the_index_stay_small_and_are_searched_side_by_side(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 50_000, rng.choice([5, 300, 2500]))) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = lexical.index(docs).collect()
    assert max(len(r["terms"]) + len(r["counts"]) + len(r["slices"]) + 16 * len(r["ids"]) for r in rows) < 1 << 19
    assert sum(len(r["ids"]) for r in rows) == 1500
    batches = lexical.index(docs).toArrow().to_batches()
    together = list(lexical._side_by_side(iter(batches)))
    assert len(together) < len(rows) // 4
    assert sorted(i for parts in together for ids, sizes, *_ in parts for i in ids[sizes > 0].tolist()) == list(range(1500))
