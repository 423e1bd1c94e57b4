"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator and stage."""

import heapq
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from finlake.llm import chat, graph, knn, mixing, near_text, near_vectors, pages, quality, sentencepiece, token_files, urls
from tests.llm.test_methods import BYTES, PIECES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = {"node": 1, "component": "x", "token": 2, "score": None, "size": 9, "key": "k", "a": 1, "text_": "t", "quota": 0, "label": "l", "rank": 3}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    words = ["w%d" % rng.randrange(400) for _ in range(3000)]
    base = " ".join(words[:200])
    changed = " ".join(words[:195] + ["new"] * 5)
    rows = [
        (1, base, "en", "s1", 1), (2, base, "en", "s1", 1), (2, base, "en", "s1", 1), (3, changed, "en", "s2", 1),
        (4, None, None, None, None), (5, "", "en", "s2", 0), (6, " \n ", "en", None, 3), (None, "no id here at all", "en", "s1", 1),
        (7, " ".join(words * 30), "en", "s3", 1), (8, "one two", "en", "s3", 1), (9, "ONE two", "en", "s3", 1), (10, "x" * 300_000, "en", "s1", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({k: F.lit(v) for k, v in EXTRA.items()})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0), (8, 0, 0), (9, None, 0), (None, 1, 0), (10, 5, 0)], "doc_id long, quality int, toxic int")


def test_quality(spark, docs, labels):
    rows = quality.classified(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
    assert quality.classified(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in quality.classified(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.accepted(docs, labels).columns == docs.columns


def test_near_text(spark, docs):
    rows = near_text.near_duplicates(docs).collect()
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["kept"]) for r in rows) == sorted([
        (1, 196, 1, True), (2, 196, 1, False), (2, 196, 1, False), (3, 196, 1, False), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
        (-1, 1, None, True), (7, 3000, 7, True), (8, 1, 8, True), (9, 1, 8, False), (10, 1, 10, True),
    ])
    assert near_text.near_duplicates(docs.limit(0)).count() == 0
    kept = near_text.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 4, 5, 6, 7, 8, 10]


def test_near_text_against_all_pairs(spark):
    """Groups of edited copies with similarities on both sides of the threshold, and passages shared by unlike documents."""
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(80)}" for _ in range(rng.choice([8, 30, 120]))]
        for _ in range(rng.choice([1, 3, 25])):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 12))):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            texts.append(copy + (passage if rng.random() < 0.3 else []))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = [{tuple(t[i:i + 5]) for i in range(max(1, len(t) - 4))} for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 4 * both >= 3 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r["component_id"] for r in near_text.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: find(i) for i in range(len(texts))}


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, 2), (2, 1), (3, 3), (None, 4), (7, 2), (500, 501)]
    rows = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert dict(map(tuple, rows)) == {**{i: 100 for i in range(100, 141)}, 1: 1, 2: 1, 7: 1, 500: 500, 501: 500}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mix(spark, docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert {(r["source"], r["size"]) for r in rows if r["doc_id"] in (4, 6)} == {(None, 0)}
    assert mixing.mix(docs.limit(0)).count() == 0
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    whole = [str(r) for r in docs.collect()]
    taken = out.collect()
    assert {str(r) for r in taken} <= set(whole)
    assert abs(sum(len((r["text"] or "").split()) for r in taken) - sum(r["taken"] for r in rows)) <= sum(r["size"] for r in rows) / 2


def test_highest_quotients(spark):
    rng = random.Random(5)
    units = [(g, u, float(rng.choice([0, 1, 3, 50, 1000])), rng.choice([2, 40, 10**6]), {0: 7, 1: 500, 2: 0}[g]) for g in range(3) for u in range(12)]
    got = {(r["g"], r["u"]): r["quota"] for r in mixing.apportioned(spark.createDataFrame(units, "g int, u int, votes double, most long, seats long"), ["g"], ["u"]).collect()}
    for g in range(3):
        mine = [(u, v, m) for gg, u, v, m, _ in units if gg == g]
        seats = {0: 7, 1: 500, 2: 0}[g]
        want = dict.fromkeys((u for u, _, _ in mine), 0)
        heap = [(-v, u, 0, v, m) for u, v, m in mine if v > 0 and m > 0]
        heapq.heapify(heap)
        limited = any(m < 10**6 for _, _, m in mine)
        while heap and seats:
            _, u, k, v, m = heapq.heappop(heap)
            want[u], seats = k + 1, seats - 1
            if k + 1 < m:
                heapq.heappush(heap, (-v / (2 * k + 3), u, k + 1, v, m))
        if not limited:
            assert {u: got[g, u] for u in want} == want
        assert all(got[g, u] <= m for u, _, m in mine)


def test_targets_near(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randrange(1, 400), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(900)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in ("a", "b", "c", None):
        mine = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 4 * mixing.BLOCK
    assert sum({r["source"]: r["target"] for r in got}.values()) == pytest.approx(sum(r["size"] for r in got))


def test_sentencepiece(spark, docs):
    rows = sentencepiece.round_trips(docs, PIECES).collect()
    assert len(rows) == docs.count() and all(r["same"] for r in rows)
    assert {r["n_ids"] for r in rows if r["doc_id"] in (4, 5)} == {0}
    out = sentencepiece.encoded(docs, PIECES)
    assert out.columns == [*docs.columns, "token_ids"]
    assert sentencepiece.encoded(docs.limit(0), PIECES).count() == 0
    assert sentencepiece.round_trips(docs.limit(0), PIECES).count() == 0


def test_token_files(spark, docs):
    rows = token_files.written_and_read(docs, BYTES).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    placed = sorted(rows, key=lambda r: r["start"])
    assert [r["start"] for r in placed] == np.cumsum([0, *(r["n_tokens"] for r in placed)])[:-1].tolist()
    assert {(r["n_tokens"], r["ids_crc32"]) for r in rows if r["doc_id"] in (4, 5)} == {(1, zlib.crc32(bytes(4)))}
    assert token_files.written_and_read(docs.limit(0), BYTES).count() == 0


def test_token_files_take_added_tokens_as_the_library_does(spark):
    texts = ["a<|endoftext|>b", "<|endoftext|>", "été <|endoftext|> don't<|endoftext|>", "a<|endoftext|", "plain text", None]
    tokenizer = Tokenizer.from_file(BYTES)
    want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    assert want[0] == [64, 50256, 65, 0]
    rows = token_files.written_and_read(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), BYTES).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["ids_crc32"]) for r in rows] == [(len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for ids in want]


def test_pages(spark):
    rows = [(1, "u", None), (None, None, ""), (2, "u", "<p>Hello there.</p>"), (2, "u", "<p>Hello there.</p>"), (3, "u", "<article><p>" + "the word of it " * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({k: F.lit(v) for k, v in EXTRA.items()})
    got = pages.main_text(df).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 12, 12, 15 * 50_000 - 1]
    assert pages.main_text(df.limit(0)).count() == 0


def test_urls(spark):
    rules = urls.rule_table(spark, [
        ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
        ("allow", "net", "/es/"), ("block", "deep.net", ""),
    ])
    cases = [
        ("http://a.com/x", "com/", "allow"), ("http://WWW.Example.COM/en/1?x#y", "www.example.com/en/", "allow"), ("s://b.example.com/en/", "example.com/en/", "block"),
        ("s://example.com/En/", "com/", "allow"), ("s://notexample.com/en/", "com/", "allow"), ("s://a.com", None, "allow"), ("s://x.net/es/", "net/es/", "block"),
        ("s://x.net/es", None, "allow"), ("s://a.deep.net?q", "deep.net", "block"), (None, None, "allow"), ("no scheme", None, "allow"), ("s://", None, "allow"),
        ("s://com/", "com/", "allow"), ("s://..com/", "com/", "allow"), ("s://a.com:80/en/", None, "allow"), ("s://x.net/es/", "net/es/", "block"),
    ]
    df = spark.createDataFrame([(i if i else None, u) for i, (u, _, _) in enumerate(cases)], "page_id long, url string").withColumns({k: F.lit(v) for k, v in EXTRA.items()})
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.filtered(df, rules).collect()}
    assert got == {i if i else None: (r, v) for i, (_, r, v) in enumerate(cases)}
    assert urls.filtered(df.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urls.filtered(df, rules.limit(0), "block").collect()} == {"block"}


def test_chat_branches(spark):
    rows = [
        ("t", 1, None, 0.0, "user", "root"), ("t", 2, 1, 5.0, "assistant", "best <|im_end|> <\\|x|"), ("t", 3, 1, 1.0, "assistant", "other"), ("t", 4, 3, 9.0, "ro\nle%0A", None),
        ("t", 5, 2, None, "user", "<|im_start|>user\n<"), ("c", 1, 2, 1.0, "user", "cycle"), ("c", 2, 1, 1.0, "user", "cycle"), ("c", 3, 2, 1.0, "user", "below"), ("s", 7, 99, 1.0, None, "alone"),
    ]
    messages = spark.createDataFrame(rows, "tree string, node long, parent long, score double, role string, text string")
    out = chat.conversations(messages, branches=2)
    got = {(r["tree"], r["branch"]): r for r in out.collect()}
    assert {k: r["leaf"] for k, r in got.items()} == {("t", 1): 4, ("t", 2): 5, ("s", 1): 7}
    read = {(r["tree"], r["leaf"], r["turn"]): (r["role"], r["text"], r["learned"]) for r in chat.turns_of(out).collect()}
    assert read["t", 4, 3] == ("ro\nle%0A", "", None)
    assert read["t", 5, 2] == ("assistant", "best <|im_end|> <\\|x|", "best <|im_end|> <\\|x|")
    assert read["t", 5, 3] == ("user", "<|im_start|>user\n<", None)
    assert got["t", 2]["formatted"].count("<|im_start|>") == 3


def test_chat_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 1, "assistant", "é<|im_end|>"), (2, 1, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({k: F.lit(v) for k, v in EXTRA.items()})
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in chat.read_back(df).collect()}
    assert got == {1: (3, 0), None: (1, 11), 2: (1, 0)}
    assert chat.read_back(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((20, 16))
    x = np.concatenate([base[rng.integers(0, 20, 400)] + 0.1 * rng.standard_normal((400, 16)), rng.standard_normal((300, 16))]).astype(np.float32)
    x[50:80] = x[50]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    odd = [(1000, None, 0), (1001, [nan] * 16, 0), (1002, [None] * 16, 0), (1003, [0.0] * 16, 0), (1004, [inf] * 16, 0), (None, x[0].tolist(), 0), (1005, [], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    return x, df.withColumns({k: F.lit(v) for k, v in EXTRA.items()})


def test_near_vectors(spark, vectors):
    x, df = vectors
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, 0)
    want = (cosine >= 0.9).sum(1)
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(df).collect()}
    assert [got[i]["n_links"] for i in range(len(x))] == want.tolist()
    assert all(got[i]["component_id"] == i and got[i]["kept"] and got[i]["n_links"] == 0 for i in range(1000, 1006))
    for i in range(len(x)):
        assert all(got[int(j)]["component_id"] == got[i]["component_id"] for j in np.flatnonzero(cosine[i] >= 0.9))
    assert near_vectors.near_duplicates(df.limit(0)).count() == 0


def test_bounded_windows_still_find_nearly_all_links(spark, vectors):
    x, df = vectors
    few = near_vectors.near_duplicates(df, window=40).agg(F.sum("n_links")).head()[0]
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    assert few >= 0.9 * ((unit @ unit.T >= 0.9).sum() - len(x))


def test_dense_groups_keep_all_their_links(spark):
    """One group of distinct vectors, all linked: more partners than the windows of all passes hold."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal(16) + 1e-5 * rng.standard_normal((900, 16))
    y = rng.standard_normal((700, 16))
    y[:300] = y[0] + 0.02 * rng.standard_normal((300, 16))
    unit = np.vstack([x, y])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(df, window=40).collect()}
    assert [got[i]["n_links"] for i in range(900)] == want[:900].tolist()
    assert {got[i]["component_id"] for i in range(900)} == {got[0]["component_id"]}
    assert [got[i]["n_links"] for i in range(900, 1200)] == want[900:1200].tolist()


def test_passes_grow_with_the_rows():
    plans = [near_vectors.planned(n) for n in (1, 512, 50_000, 5_000_000)]
    assert [leading for leading, _ in plans] == [0, 0, 7, 14]
    for leading, passes in plans:
        assert (1 - (1 - np.arccos(0.9) / np.pi) ** leading) ** passes <= 1e-4


def test_top_k(spark, vectors, monkeypatch):
    x, df = vectors
    monkeypatch.setattr(knn, "BLOCK_ROWS", 64)
    z = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    rows = [*range(len(x)), 1003]
    z = np.vstack([z, np.zeros((1, 16), np.int64)])
    scores = z @ z.T
    got = {}
    for r in knn.top_k(df, F.col("vec_id") % 50 == 0, 5).collect():
        got[r["query_id"], r["rank"]] = (r["vec_id"], r["score"])
    want = {}
    for i, q in enumerate(rows):
        if q % 50 == 0:
            best = sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-scores[i, j], rows[j]))[:5]
            want.update({(q, n + 1): (rows[j], int(scores[i, j])) for n, j in enumerate(best)})
    assert got == want
    assert knn.top_k(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0
    assert knn.top_k(df.where("vec_id in (0, 1)"), F.col("vec_id") % 50 == 0, 5).count() == 1


def test_pipeline_stages_keep_the_columns_and_empty_tables(spark, docs, sf):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        out.write.format("noop").mode("overwrite").save()
        assert stage(spark, docs.limit(0), sf).count() == 0, name


def test_pipeline(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    good = corpus_pipeline.good_quality(spark, documents, sf)
    rejected = quality.classified(documents, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 0")
    assert good.join(rejected, "doc_id").count() == 0 and good.count() + rejected.count() == documents.count()
    single = corpus_pipeline.one_per_group(spark, good, sf)
    groups = near_text.near_duplicates(good)
    assert single.count() == groups.select("component_id").distinct().count()
    out = corpus_pipeline.run(spark, sf).collect()
    assert out and {r["doc_id"] for r in out} <= {r["doc_id"] for r in single.collect()}
    vocabulary = sentencepiece.Vocabulary.load(PIECES)
    assert all(sentencepiece.decode(vocabulary, r["token_ids"]) == r["text"] for r in out)


@pytest.mark.parametrize("rows", [20_000, 20])
def test_ranges_hold_each_rule_once_however_many_questions(spark, monkeypatch, rows):
    monkeypatch.setattr(urls, "SWEEP_ROWS", rows)
    seen, ranged = [], urls.ranged

    def watched(keyed, asked):
        both = ranged(keyed, asked)
        seen.append((both.where("stack is not null").count(), both.select("range").distinct().count()))
        return both

    monkeypatch.setattr(urls, "ranged", watched)
    rng = random.Random(6)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net"] + [f"h{i}.com" for i in range(200)]
    rules = {(rng.choice(hosts), rng.choice(["", "/", "/a", "/a/", "/a/b", f"/{i}"])): rng.choice(["allow", "block"]) for i in range(150)}
    rules[("com", "/")] = "block"
    table = urls.rule_table(spark, [(v, h, p) for (h, p), v in rules.items()])
    asked = [(i, f"s://{rng.choice(['', 'www.', 'b.'])}{rng.choice(hosts)}{rng.choice(['/', '/a/b/c', '/a', '', f'/{i % 150}'])}") for i in range(1500)]

    def plain(url):
        rest = url.split("://")[1]
        host, path = rest.partition("/")[0], "/" + rest.partition("/")[2] if "/" in rest else ""
        fit = [(len(h + p), h + p, v) for (h, p), v in rules.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[1:] if fit else (None, "allow")

    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.filtered(spark.createDataFrame(asked, "page_id long, url string"), table).collect()}
    assert got == {i: plain(u) for i, u in asked}
    assert seen[0][0] == len(rules) and (rows > 20 or seen[0][1] > 50)
