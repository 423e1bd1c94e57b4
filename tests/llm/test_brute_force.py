"""The classifier against one dense solve, and every stage of the pipeline against a plain version."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from finlake.llm import quality
from finlake.llm.queries import SQL_MIX
from finlake.llm.sentencepiece import Vocabulary, encode_stream
from finlake.llm.shared import held_out, stored, table, text_bytes
from tests.oracle import connect

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("many", [False, True])
def test_the_summed_fit_is_that_of_one_dense_solve(spark, sf, monkeypatch, many):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.fit(stored(quality.measured(docs.repartition(6)), "test"), labels)
    rows = docs.join(labels, "doc_id").where(~held_out("doc_id")).selectExpr(
        "doc_id", "text", "quality", "cast(pmod(floor(crc32(cast(doc_id as string)) / 3), %d) as int) as fold" % quality.FOLDS
    ).toPandas()
    x = quality.statistics(*text_bytes(pa.array(rows["text"].tolist(), pa.string()))).astype(np.float32).astype(float)
    y, fold = rows["quality"].to_numpy(float), rows["fold"].to_numpy()
    mean, scale = x.mean(0), np.where(x.std(0) > 1e-6, x.std(0), 1.0)
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, scale)
    z = quality.fourier(x, mean, scale)

    def ridge(chosen):
        a = z[chosen].T @ z[chosen] + quality.RIDGE * max(chosen.sum(), 1) * np.eye(z.shape[1]) / quality.FEATURES
        return np.linalg.solve(a, z[chosen].T @ y[chosen])

    assert np.allclose(model.weights, ridge(np.ones(len(y), bool)), rtol=1e-6, atol=1e-8)
    score = np.array([z[i] @ w for i, w in enumerate(np.stack([ridge(fold != k) for k in range(quality.FOLDS)])[fold])])
    place = np.clip(np.floor(score * quality.BINS), -quality.BINS, 2 * quality.BINS)
    # Monotone least squares by its definition: the greatest of least means.
    bins = np.unique(place)
    n, total = np.array([(place == b).sum() for b in bins]), np.array([y[place == b].sum() for b in bins])
    level = [max(min(total[i: j + 1].sum() / n[i: j + 1].sum() for j in range(k, len(bins))) for i in range(k + 1)) for k in range(len(bins))]
    assert np.allclose(model.levels, level)
    # The filter of the pipeline gives the verdicts of the classifier, whichever rows it measures.
    monkeypatch.setattr(quality, "BROADCAST_IDS", 0 if many else 10**6)
    kept = Counter(r["doc_id"] for r in quality.accepted(docs, labels).collect())
    assert kept == Counter(r["doc_id"] for r in quality.classified(docs, labels).where("predicted = 1").collect())


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def one_per_group(docs):
    ids = sorted(docs)
    sets = {i: shingles(docs[i]["text"]) for i in ids}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i for i in ids if find(i) == i}


def test_every_stage_gives_the_rows_of_a_plain_version(spark, sf):
    docs = table(spark, sf, "documents")
    by_id = {r["doc_id"]: r for r in docs.collect()}
    good = stored(corpus_pipeline.good_quality(spark, docs, sf), "good")
    verdict = {r["doc_id"] for r in quality.classified(docs, table(spark, sf, "labels")).where("predicted = 1").collect()}
    assert {tuple(r) for r in good.collect()} == {tuple(by_id[i]) for i in verdict}
    single = stored(corpus_pipeline.one_per_group(spark, good, sf), "single")
    left = one_per_group({i: by_id[i] for i in verdict})
    assert Counter(map(tuple, single.collect())) == Counter(tuple(by_id[i]) for i in left)
    mix = stored(corpus_pipeline.source_mix(spark, single, sf), "mix")
    con = connect(sf)
    con.register("kept", pa.table({"doc_id": pa.array(sorted(left), pa.int64())}))
    con.execute("create temp view single as select * from documents where doc_id in (select doc_id from kept)")
    want = Counter()
    for row in con.execute(SQL_MIX.replace("from documents)", "from single)")).fetchall():
        doc_id, _, size, _, _, taken = row
        if size:
            want[doc_id] = (2 * taken + size) // (2 * size)
    assert Counter(map(tuple, mix.collect())) == Counter({tuple(by_id[i]): n for i, n in want.items() if n})
    vocabulary = Vocabulary.load(corpus_pipeline.PIECES)
    for row in corpus_pipeline.token_ids(spark, mix, sf).collect():
        assert row["token_ids"] == list(encode_stream(vocabulary, [row["text"] or ""]))
        assert tuple(row)[:-1] == tuple(by_id[row["doc_id"]])
