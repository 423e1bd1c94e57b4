"""Exact top-k by inner product: a Voronoi join of queries and data grouped by pivots.

Vectors fall into the cells of a bounded number of pivots for each length. From a summary of each cell (its size, radius, norms, and the
``k + 1`` ids nearest its pivot) follow, for each cell of queries, a score that every one of its queries surely reaches
k times and the most that any vector of a data cell can score. Data goes only to the query cells whose bound it can
reach, in blocks of bounded size, so a cell that holds a third of all rows is many tasks; each block is solved by itself
and the blocks' results are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.shared import small_batches, stored

SCALE = 256
PIVOTS = 16
BLOCK_ROWS = 16_384


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = [], []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if vec_id is None or vector is None or None in vector:
                continue
            x = np.array(vector, np.float64)
            if np.isfinite(x).all():
                ids.append(vec_id)
                out.append(np.floor(SCALE * x).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "v"])


def integers(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)``: floor(256 x) of each component, as doubles in binary; only whole finite vectors with an id."""
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return stored(ids.mapInArrow(_integers, "vec_id long, v binary"), "vectors")


def _matrix(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; one of more than 63 bits is an error."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    most = float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1]
    if most < 2**53:
        return (q @ x.T).astype(np.int64)
    if most < 2**62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    exact = whole(q) @ whole(x).T
    if max(abs(int(exact.max())), abs(int(exact.min()))) >= 2**63:
        raise OverflowError("an inner product does not fit 64 bits")
    return exact.astype(np.int64)


class Pivots:
    """The centres of all cells. Vectors meet vectors of their own length only, so each length has pivots of its own."""

    def __init__(self, vectors: list[bytes]):
        found = sorted({(len(v), v) for v in vectors})
        self.centres = [np.frombuffer(v, np.float64) for _, v in found]
        self.of_length: dict[int, list[int]] = {}
        for cell, (size, _) in enumerate(found):
            self.of_length.setdefault(size, []).append(cell)

    def alike(self, cell: int) -> list[int]:
        """The cells of vectors as long as this one's."""
        return self.of_length[self.centres[cell].nbytes]


def _cells(rows: DataFrame, pivots: Pivots) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            cell, away, norm2 = np.zeros(len(vectors), np.int32), np.zeros(len(vectors)), np.zeros(len(vectors))
            sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                own = pivots.of_length[size]
                x, p = _matrix([vectors[i] for i in at.tolist()]), np.stack([pivots.centres[c] for c in own])
                norm2[at] = (x**2).sum(1)
                far = np.sqrt(np.maximum(norm2[at][:, None] + (p**2).sum(1) - 2 * x @ p.T, 0))
                best = far.argmin(1)
                cell[at], away[at] = np.array(own)[best], far[np.arange(len(at)), best]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(cell), pa.array(away), pa.array(norm2)],
                names=["vec_id", "v", "cell", "away", "norm2"],
            )

    return rows.mapInArrow(assign, "vec_id long, v binary, cell int, away double, norm2 double")


def _needed(pivots: Pivots, data: pd.DataFrame, nearest: pd.DataFrame, queries: pd.DataFrame, k: int) -> list[tuple[int, int]]:
    """Pairs (query cell, data cell) in which a query may have one of its k best.

    With 2 <q, x> = |q|^2 + |x|^2 - |q - x|^2 and triangles through the pivots.
    """
    slack = 1e-6
    out = []
    close = {int(cell): rows[["vec_id", "away"]].values.tolist() for cell, rows in nearest.groupby("cell")}
    for i, radius, low2, high2 in queries[["cell", "radius", "low2", "high2"]].itertuples(index=False):
        own = pivots.centres[int(i)]
        alike = [j for j in pivots.alike(int(i)) if j in data.index]
        gap = {j: float(np.sqrt(((pivots.centres[j] - own) ** 2).sum())) for j in alike}
        least = []
        for j in alike:
            for vec_id, away in close.get(j, []):
                least.append(((low2 + data.loc[j, "low2"] - (radius + gap[j] + away) ** 2) / 2, vec_id))
        of_id: dict[int, float] = {}
        for score, vec_id in sorted(least, reverse=True):
            of_id.setdefault(vec_id, score)
        reached = list(of_id.values())[k] if len(of_id) > k else -np.inf  # k + 1 ids: one may be the query's own
        for j in alike:
            r = data.loc[j, "radius"]
            most = (high2 + data.loc[j, "high2"] - max(0.0, gap[j] - radius - r) ** 2) / 2
            dot = own @ pivots.centres[j] + radius * np.linalg.norm(pivots.centres[j]) + (np.linalg.norm(own) + radius) * r
            if min(most, dot) * (1 + slack) + 1 >= reached or not np.isfinite(reached):
                out.append((int(i), j))
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of all other rows for each query row, ties to the smaller id.

    Null vectors and those that hold null or non-finite components take no part, nor do rows without an id. Vectors of
    different length do not meet. Rows that
    repeat an id are candidates each, but never of a query with that id; such a query asks once, with the smallest of its
    vectors. With fewer than k candidates all are returned; an empty table gives an empty result. Other columns are not read.
    """
    small_batches(vectors.sparkSession)
    spark = vectors.sparkSession
    rows = integers(vectors)
    some = F.row_number().over(Window.partitionBy(F.length("v")).orderBy(F.xxhash64("vec_id"), "vec_id", "v"))
    taken = rows.withColumn("n", some).where(F.col("n") <= PIVOTS).select("v").collect()
    result = "query_id long, vec_id long, score long"
    pivots = Pivots([r["v"] for r in taken])
    cells = stored(_cells(rows, pivots).withColumn("place", F.monotonically_increasing_id()), "cells")
    asking = cells.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "cell", "away", "norm2", "place")).alias("first"))
    queries = stored(asking.select("vec_id", "first.*"), "queries")
    summary = lambda df: df.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"), F.min("norm2").alias("low2"), F.max("norm2").alias("high2"),
    ).toPandas()
    data_cells, query_cells = summary(cells), summary(queries)
    place = F.row_number().over(Window.partitionBy("cell").orderBy("away"))
    ids = cells.groupBy("cell", "vec_id").agg(F.min("away").alias("away"))  # rows that repeat an id are one
    nearest = ids.withColumn("place", place).where(F.col("place") <= k + 1).toPandas()
    needed = _needed(pivots, data_cells.set_index("cell"), nearest, query_cells, k)
    blocks = {int(c): -(-int(n) // BLOCK_ROWS) for c, n in zip(data_cells["cell"], data_cells["n"])}
    parts = {int(c): -(-int(n) // BLOCK_ROWS) for c, n in zip(query_cells["cell"], query_cells["n"])}
    # A task per query part and data block. The driver makes a row per pair of cells; parts and blocks are numbered by Spark.
    pairs = [(i, j, parts[i], blocks[j]) for i, j in needed]
    pairs = spark.createDataFrame(pairs, "qc int, dc int, parts int, blocks int")
    met = lambda rows, of: rows.join(pairs, rows["cell"] == pairs[of]).drop("cell")
    # A row's place salts its block, so rows that repeat an id are dealt over all blocks.
    own = lambda many: F.pmod(F.xxhash64("vec_id", "place"), F.col(many)).cast("int")
    every = lambda many: F.explode(F.expr(f"sequence(0, {many} - 1)"))
    data = met(cells.select("cell", "vec_id", "v", "place"), "dc").select("qc", every("parts").alias("qp"), "dc", own("blocks").alias("db"), "vec_id", "v")
    asked = met(queries.select("cell", "vec_id", "v", "place"), "qc").select(
        F.col("qc").alias("asked_qc"), own("parts").alias("asked_qp"), F.col("dc").alias("asked_dc"), every("blocks").alias("asked_db"),
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"),
    )

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("vec_id", kind="stable")
        ids, x = right["vec_id"].to_numpy(), _matrix(right["v"].tolist())
        found: list[tuple[int, int, int]] = []
        for start in range(0, len(left), 512):
            some = left.iloc[start: start + 512]
            scores = _products(_matrix(some["q"].tolist()), x) if len(ids) else np.zeros((len(some), 0), np.int64)
            for query, row in zip(some["query_id"].tolist(), scores):
                other = np.flatnonzero(ids != query)
                row = row[other]
                if len(row) > k:
                    limit = np.partition(row, len(row) - k)[len(row) - k]
                    above = np.flatnonzero(row > limit)
                    keep = np.concatenate([above, np.flatnonzero(row == limit)[: k - len(above)]])
                else:
                    keep = np.arange(len(row))
                found.extend((query, int(ids[other[n]]), int(row[n])) for n in keep)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    of_query = asked.groupBy("asked_qc", "asked_qp", "asked_dc", "asked_db")
    solved = of_query.cogroup(data.groupBy("qc", "qp", "dc", "db")).applyInPandas(solve, result)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return solved.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
