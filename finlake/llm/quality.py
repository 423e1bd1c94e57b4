"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated by isotonic steps.

Statistics of whole texts are taken once per document. Random Fourier features approximate a Gaussian kernel over the
standardised statistics. Each partition adds up its part of the normal equations, per fold; sums of partitions are summed
again by Spark, and only the sums (their size is set by the number of features) come to the driver. Since folds are sums too,
out-of-fold scores cost one small solve each; they train the calibration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.shared import BROADCAST_IDS, Words, blocks, held_out, rows_with_ids, small_batches, stored, text_bytes

FEATURES = 256
BANDWIDTH = 4.0
RIDGE = 1e-3
FOLDS = 5
BINS = 2000
#: Share of the uncalibrated score in the result: it keeps the order of documents inside a step of the calibration.
KEEP_ORDER = 1e-3

UPPER, LOWER_CASE, DIGIT, SPACE, LINE, STOP, SIGN, HIGH = range(8)
CLASS = np.full(256, SIGN, np.uint8)
CLASS[65:91], CLASS[97:123], CLASS[48:58], CLASS[128:] = UPPER, LOWER_CASE, DIGIT, HIGH
CLASS[[9, 11, 12, 13, 32]], CLASS[10] = SPACE, LINE
CLASS[[ord(c) for c in ".,;:?'\"()-"]] = STOP
COLUMNS = 8 + 11


def statistics(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of statistics per text of a block; an empty text has zeros."""
    n = len(at) - 1
    out = np.zeros((n, COLUMNS))
    size = np.diff(at)
    full = size > 0
    if full.any():
        kinds = CLASS[raw]
        for kind in range(8):
            out[full, kind] = np.add.reduceat(kinds == kind, at[:-1][full], dtype=np.int64) / size[full]
    words = Words(raw, at)
    start = 0
    for i, count in enumerate(words.counts):
        if count:
            hashes, lengths = words.hashes[start: start + count], words.lengths[start: start + count]
            _, repeats = np.unique(hashes, return_counts=True)
            _, pairs = np.unique(hashes[1:] * np.uint64(31) + hashes[:-1], return_counts=True)
            out[i, 8:] = (
                np.log1p(count), lengths.mean(), lengths.std(), (lengths <= 3).mean(), (lengths >= 10).mean(),
                len(repeats) / count, len(repeats) / count**0.75, repeats.max() / count,
                (hashes[1:] == hashes[:-1]).sum() / count, len(pairs) / count, np.log1p(lengths.max()),
            )
            start += count
    return out


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = text_bytes(batch.column(1))
        for first, end, part, part_at in blocks(raw, at):
            x = statistics(part, part_at).astype(np.float32)
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * COLUMNS, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), lists], names=["doc_id", "x"])


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)``: the statistics of every row's whole text."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ids.mapInArrow(_statistics, "doc_id long, x array<float>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw_scores(self, x: np.ndarray) -> np.ndarray:
        return fourier(x, self.mean, self.scale) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores from 0 to 1; without any label, 0.5 for every text."""
        raw = self.raw_scores(x)
        steps = np.interp(raw, self.knots, self.levels)
        return np.clip((1 - KEEP_ORDER) * steps + KEEP_ORDER * np.clip(raw, 0, 1), 0, 1)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """A constant and FEATURES random cosines of the standardised statistics."""
    random = np.random.default_rng(11)
    directions = random.standard_normal((x.shape[1], FEATURES)) / BANDWIDTH
    phases = random.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((x - mean) / scale, -8, 8)
    return np.hstack([np.ones((len(x), 1)), np.sqrt(2 / FEATURES) * np.cos(z @ directions + phases)])


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing levels nearest to ``y`` in weighted squares (pool adjacent violators)."""
    pools: list[list[float]] = []
    for value, w in zip(y, weight):
        pools.append([value, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, w2, n = pools.pop()
            u, w1, m = pools[-1]
            pools[-1] = [(u * w1 + v * w2) / (w1 + w2), w1 + w2, m + n]
    return np.concatenate([np.full(int(n), v) for v, _, n in pools])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, COLUMNS).astype(np.float64)


def fit(rows: DataFrame, labels: DataFrame) -> Model:
    """A model of ``labels (doc_id, quality)`` from measured ``rows (doc_id, x)``.

    Labels of held-out rows are not read. A quality other than 0 and 1 is no label; contradicting labels of a document average.
    Without labels of both kinds the model gives every text the share of label 1 (0.5 if there is no label).
    """
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out("doc_id") & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("y"))
    fold = F.pmod(F.floor(F.crc32(F.col("doc_id").cast("string")) / 3), F.lit(FOLDS)).cast("int")
    train = stored(rows.join(known, "doc_id").select(fold.alias("fold"), "x", "y"), "train")
    columns = [F.col("x")[i] for i in range(COLUMNS)]
    sums = train.agg(F.count(F.lit(1)), F.avg("y"), *[f(c) for f in (F.avg, F.stddev_pop) for c in columns]).head()
    mean, scale = np.array([v or 0.0 for v in sums[2: 2 + COLUMNS]]), np.array([v or 0.0 for v in sums[2 + COLUMNS:]])
    scale = np.where(scale > 1e-6, scale, 1.0)
    share = 0.5 if sums[1] is None else sums[1]
    if share in (0.0, 1.0) or not sums[0]:
        return Model(mean, scale, np.append(share, np.zeros(FEATURES)), np.array([0.0]), np.array([share]))
    width = FEATURES + 2

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, width, width))
        for batch in batches:
            folds = batch.column("fold").to_numpy()
            both = np.hstack([fourier(_matrix(batch), mean, scale), batch.column("y").to_numpy()[:, None]])
            for k in range(FOLDS):
                part = both[folds == k]
                total[k] += part.T @ part
        rows = [(k, i, total[k, i].tobytes()) for k in range(FOLDS) for i in range(width)]
        k, i, v = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(i, pa.int32()), pa.array(v, pa.binary())], names=["k", "i", "v"])

    def added(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width)
        for v in group["v"]:
            total += np.frombuffer(v)
        return pd.DataFrame({"k": group["k"].iloc[:1], "i": group["i"].iloc[:1], "v": [total.tobytes()]})

    schema = "k int, i int, v binary"
    gram = np.zeros((FOLDS, width, width))
    for k, i, v in train.mapInArrow(equations, schema).groupBy("k", "i").applyInPandas(added, schema).collect():
        gram[k, i] = np.frombuffer(v)

    def solved(total: np.ndarray) -> np.ndarray:
        a = total[:-1, :-1] + RIDGE * max(total[0, 0], 1.0) * np.eye(width - 1) / FEATURES
        return np.linalg.solve(a, total[:-1, -1])

    everything = gram.sum(0)
    by_fold = np.stack([solved(everything - gram[k]) for k in range(FOLDS)])

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = fourier(_matrix(batch), mean, scale)
            score = np.einsum("ij,ij->i", z, by_fold[batch.column("fold").to_numpy()])
            place = np.clip(np.floor(score * BINS), -BINS, 2 * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column("y")], names=["bin", "y"])

    binned = train.mapInArrow(bins, "bin int, y double").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"))
    place, n, y = (np.array(c, float) for c in zip(*sorted(map(tuple, binned.collect()))))
    return Model(mean, scale, solved(everything), (place + 0.5) / BINS, isotonic(y, n))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, predicted)`` of measured rows."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.scores(_matrix(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"],
            )

    return rows.mapInArrow(apply, "doc_id long, score double, predicted int")


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs (doc_id, text)``.

    Null and empty texts are scored by their statistics (all zero). Rows that repeat an id are scored each by its own text; a
    null id is never held out and never labelled. An empty table gives an empty result. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = stored(measured(docs), "statistics")
    return scored(rows, fit(rows, labels)).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted 1, with all their columns, judged where they are read: no text is exchanged.

    The model is fitted on the labelled rows alone, so each text's statistics are made once for its verdict and, if it is labelled,
    once for the fit. Null and empty texts are judged by statistics of zero; null ids and repeated rows are judged each by its own
    text; without labels all scores are 0.5, which counts as 1. Columns may have any names and types; an empty table gives an empty
    result.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out("doc_id") & F.col("doc_id").isNotNull())
    ids = stored(known.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "labelled")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Many labels would move the texts; then all are measured instead.
    few = ids.count() <= BROADCAST_IDS
    model = fit(stored(measured(rows_with_ids(texts, "doc_id", ids) if few else texts), "statistics"), labels)
    names = docs.columns
    place = names.index("text")
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_bytes(batch.column(place))
            good = [model.scores(statistics(part, part_at)) >= 0.5 for _, _, part, part_at in blocks(raw, at)]
            yield batch.filter(pa.array(np.concatenate(good) if good else np.zeros(0, bool)))

    return rows.mapInArrow(keep, rows.schema).toDF(*names)
