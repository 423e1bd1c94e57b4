"""Exact top-k where ids repeat."""

import numpy as np
from pyspark.sql import functions as F

from finlake.llm import knn


def test_rows_of_the_query_itself_do_not_prune_its_answers(spark):
    rows = [(0, [1.0, 0.0])] * 6 + [(i, [0.1 - i / 1000, 0.0]) for i in range(1, 6)]
    got = knn.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 5).collect()
    want = sorted(((256 * int(np.floor(256 * v[0])), i) for i, v in rows if i), key=lambda x: (-x[0], x[1]))
    assert [(r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == want


def test_repeated_ids_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(2)
    base = 20 * rng.standard_normal((5, 4))
    x = base[rng.integers(0, 5, 300)] + 0.05 * rng.standard_normal((300, 4))
    ids = [0] * 90 + [int(i) for i in rng.integers(1, 60, 210)]
    x[:90] = base[0] + 0.01 * rng.standard_normal((90, 4))
    z = np.floor(256 * x).astype(np.int64)
    want = {}
    for q in (0, 50):
        v = z[min((i for i in range(300) if ids[i] == q), key=lambda i: z[i].astype(float).tobytes())]
        best = sorted((-int(v @ z[i]), ids[i]) for i in range(300) if ids[i] != q)[:5]
        want.update({(q, n + 1): (vec_id, -score) for n, (score, vec_id) in enumerate(best)})
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in knn.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()}
    assert got == want
