"""Embedding near-duplicates by sorted projection passes.

In each pass vectors are ordered by the concatenated signs of random projections (ties by a hash of the pass's own), and
every vector is compared with the ``WINDOW`` next ones in that order. Vectors with equal leading signs, about
log2(rows / WINDOW) of them, are a run: one longer than the window is compared whole, in salted blocks, so that no
partner in a dense group is cut off. Pairs whose cosine reaches the threshold are links, and their union over all passes makes
the components. A pair that several passes bring together counts in the first of them: each vector carries its ranks and runs
in all passes. Links themselves leave no task, only their number for each vector and a forest that connects what they do.

Two vectors at cosine 0.9 agree in a sign with probability 0.86, so the chance of meeting in a pass follows from the leading
signs, and the number of passes from the rows: as many as leave such a pair apart with a chance of at most ``MISSED`` (7 signs
and 23 passes for fifty thousand rows). Pairs of higher cosine are found more surely.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.graph import components
from finlake.llm.shared import mix, small_batches, stored

THRESHOLD = 0.9
MISSED = 1e-4
WINDOW = 512
SIGNS = 48
BLOCK = 4096
STEP = 512


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[bytes | None] = []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x = np.array(vector, np.float64) if vec_id is not None and vector and None not in vector else np.zeros(0)
            size = np.abs(x).max(initial=0)
            out.append(x.tobytes() if np.isfinite(x).all() and size > 0 else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])


def _unit(column: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def planned(rows: int, window: int = WINDOW, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Leading signs that make a run of about ``window`` rows, and the passes that bring pairs at the threshold together."""
    leading = min(max(0, math.ceil(math.log2(max(rows, 1) / window))), 31)
    meet = (1 - math.acos(threshold) / math.pi) ** leading
    return leading, 1 if meet == 1 else math.ceil(math.log(MISSED) / math.log1p(-meet))


def _ranks(vectors: DataFrame, passes: int, leading: int) -> DataFrame:
    """``(key, ranks, runs)``: the place of each vector in the order of each pass, counted through all passes, and its run."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column("v").to_pylist())
            own = batch.column("key").to_numpy().astype(np.uint64)
            for p in range(passes):
                directions = np.random.default_rng([7, p, x.shape[1]]).standard_normal((x.shape[1], SIGNS))
                signs = (x @ directions > 0).astype(np.int64) @ (np.int64(1) << np.arange(SIGNS - 1, -1, -1, dtype=np.int64))
                tie = mix(own + np.uint64((p + 1) * 0x9E3779B97F4A7C15 % 2**64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p, np.int32)), pa.array(signs), pa.array(tie), batch.column("key")], names=["pass", "signs", "tie", "key"])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seen, seen + n)), batch.column("pass"), batch.column("signs"), batch.column("key")],
                names=["part", "place", "pass", "signs", "key"],
            )
            seen += n

    order = ["pass", "signs", "tie"]
    # One width a batch: the vectors of a batch make one matrix.
    keyed = vectors.mapInArrow(lambda batches: keys(_by_width(batches)), "pass int, signs long, tie long, key long")
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(numbered, "part int, place long, pass int, signs long, key long")
    placed = stored(placed, "places")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per task
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = placed.join(sizes.select("part", before.alias("before")), "part").withColumn("rank", F.col("before") + F.col("place"))
    ranked = ranked.withColumn("run", F.shiftright("signs", SIGNS - leading).cast("int"))
    of = lambda column: F.array(*[F.max(F.when(F.col("pass") == p, F.col(column))) for p in range(passes)])
    return ranked.groupBy("key").agg(of("rank").alias("ranks"), of("run").alias("runs"))


def _by_width(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        width = np.array([len(v) for v in batch.column("v").to_pylist()], np.int64)
        for size in np.unique(width):
            yield batch.filter(pa.array(width == size))


def _joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` (each place's root) after the edges between the places ``a`` and ``b``."""
    while True:
        one, two = parent[a], parent[b]
        apart = one != two
        if not apart.any():
            return parent
        a, b, one, two = a[apart], b[apart], one[apart], two[apart]
        np.minimum.at(parent, np.maximum(one, two), np.minimum(one, two))
        while not np.array_equal(up := parent[parent], parent):
            parent = up


class _Group:
    """Rows that are compared with each other, and what their links add up to."""

    def __init__(self, group: pd.DataFrame):
        self.keys, self.nodes, self.m, self.turn, self.rank = (group[c].to_numpy() for c in ("key", "node", "m", "pass", "rank"))
        self.ranks, self.runs = (np.ascontiguousarray(np.stack(group[c].to_numpy()).T) for c in ("ranks", "runs"))
        self.v, self.width = group["v"].tolist(), group["width"].to_numpy()
        self.others, self.parent = np.zeros(len(group), np.int64), np.arange(len(group))

    def unit(self, places: np.ndarray) -> np.ndarray:
        return _unit([self.v[i] for i in places])

    def add(self, a: np.ndarray, b: np.ndarray, window: int) -> None:
        """Count the links between the places ``a`` and ``b`` that no earlier pass has brought together."""
        for q in range(int(self.turn.max())):
            met = (np.abs(self.ranks[q][a] - self.ranks[q][b]) <= window) | (self.runs[q][a] == self.runs[q][b])
            new = ~met | (self.turn[a] <= q)
            a, b = a[new], b[new]
        for one, two in ((a, b), (b, a)):
            self.others += np.bincount(one, self.m[two], len(self.others)).astype(np.int64)
        self.parent = _joined(self.parent, a, b)

    def result(self) -> pd.DataFrame:
        some = self.others > 0
        return pd.DataFrame({"key": self.keys[some], "others": self.others[some], "a": self.nodes[some], "b": self.nodes[self.parent[some]]})


def found_links(vectors: DataFrame, window: int = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """``(key, others, a, b)``: rows to be added up to the number of rows each of ``vectors (key, node, v, m)`` is linked to.

    ``m`` is how many rows a vector stands for; the edges (a, b) between nodes connect what the links do.
    """
    leading, passes = planned(vectors.count(), window, threshold)
    ranked = stored(vectors.withColumn("width", F.length("v")).join(_ranks(vectors.select("key", "v"), passes, leading), "key"), "ranked")
    carried = ["key", "node", "m", "v", "width", "ranks", "runs", "pass", "rank"]
    spread = ranked.select(*carried[:-2], F.posexplode("ranks").alias("pass", "rank"))
    block = F.floor(F.col("rank") / BLOCK)
    ahead = F.when((F.col("rank") % BLOCK < window) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    rows = spread.withColumn("block", F.explode(ahead)).select("block", *carried)
    out = "key long, others long, a long, b long"

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rank")
        own = group["rank"].to_numpy() // BLOCK == group["block"].iloc[0]
        found = _Group(group)
        rank, turn = found.rank, found.turn
        for size in np.unique(found.width):
            same = np.flatnonzero(found.width == size)
            x = found.unit(same)
            for start in range(0, len(same), STEP):
                i = same[start: start + STEP]
                end = int(np.searchsorted(rank[same], rank[i[-1]] + window, "right"))
                a, b = np.nonzero(x[start: start + len(i)] @ x[start:end].T >= threshold)
                a, b = i[a], same[start:end][b]
                near = (rank[b] > rank[a]) & (rank[b] - rank[a] <= window) & (turn[a] == turn[b]) & own[a]
                found.add(a[near], b[near], window)
        return found.result()

    near = rows.groupBy("block").applyInPandas(compare, out)
    if not leading:
        return near

    # Runs longer than the window, each two of its blocks in a task; pairs within the window have been compared above.
    run = F.element_at("runs", F.col("pass") + 1)
    sizes = ranked.select(F.posexplode("runs").alias("pass", "run")).groupBy("pass", "run").agg(F.count(F.lit(1)).alias("n"))
    sizes = stored(sizes.where(F.col("n") > window).select("pass", "run", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "runs")
    long = spread.withColumn("run", run).join(sizes, ["pass", "run"]).withColumn("own", F.pmod(F.xxhash64("key", "pass"), "blocks").cast("int"))
    long = long.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "run", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), (F.col("own") > F.col("other")).alias("behind"), *carried,
    )

    def compare_run(group: pd.DataFrame) -> pd.DataFrame:
        inside = group["first"].iloc[0] == group["second"].iloc[0]
        behind = group["behind"].to_numpy()
        found = _Group(group)
        for size in np.unique(found.width):
            left = np.flatnonzero((found.width == size) & ~behind)
            right = left if inside else np.flatnonzero((found.width == size) & behind)
            if not len(left) or not len(right):
                continue
            x, y = found.unit(left), found.unit(right)
            for start in range(0, len(left), STEP):
                first = start if inside else 0
                a, b = np.nonzero(x[start: start + STEP] @ y[first:].T >= threshold)
                a, b = left[start + a], right[first + b]
                far = np.abs(found.rank[a] - found.rank[b]) > window
                if inside:
                    far &= a < b
                found.add(a[far], b[far], window)
        return found.result()

    return near.unionByName(long.groupBy("pass", "run", "first", "second").applyInPandas(compare_run, out))


def near_duplicates(vectors: DataFrame, window: int = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors (vec_id, embedding)``.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id reachable, ``kept`` says that it is
    the row's own. Null, empty and zero vectors, those holding null or non-finite components, and rows without an id link with
    nothing; vectors of different lengths are never linked. Equal vectors are collapsed first and all count as links of
    each other; different vectors under one id are one node of the components. An empty table gives an empty result.
    Other columns are not read.
    """
    small_batches(vectors.sparkSession)
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(ids.mapInArrow(_valid, "vec_id long, v binary"), "vectors")
    nodes = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("m"))
    nodes = stored(nodes.withColumn("key", F.monotonically_increasing_id()), "nodes")
    links = stored(found_links(nodes, window, threshold), "links")
    others = links.groupBy("key").agg(F.sum("others").alias("others"))
    named = nodes.join(others, "key", "left").join(components(links.select("a", "b")), "node", "left")
    named = named.select("v", (F.coalesce("others", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    full = rows.where("v is not null").join(named, "v").select("vec_id", "n_links", "component_id")
    bare = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = full.unionByName(bare)
    return out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
