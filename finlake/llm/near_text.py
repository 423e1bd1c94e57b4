"""MinHash near-duplicate documents by an inverted join over signature coordinates.

Each distinct shingle set is posted under its coordinate-value pairs. A pair of sets with at least ``T`` of ``K`` equal
coordinates must meet in the first ``K - T + 1`` pairs of either one when all pairs are taken in one global order, so only
that prefix is joined. The order is rarest pair first: pairs that many documents share (common passages) stand last and are
skipped, except for documents made of little else. A first round over ``K1`` coordinates leaves out the sets that share
fewer than ``T1`` of them with any other.

No posting list is multiplied with itself. Its members meet the member with the most shared pairs (in a group of copies, the
text they were copied from), and whoever is linked to it is done. The members left over are compared, inside tasks and in
blocks of bounded size, with the documents of that component and with each other; only links and likely pairs leave a
task. Every link is confirmed on full shingle sets.

A pair with similarity 0.75 has 96 of 128 equal coordinates on average; below 76 it falls with a chance of 3 in 100 000, and
below 8 of 24 with less than that. More similar pairs are missed far less often. Nothing below the threshold is linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.graph import components
from finlake.llm.shared import Words, blocks, grouped, mix, rows_with_ids, small_batches, stored, text_bytes

WORDS = 5
K, T = 128, 76
K1, T1 = 24, 8
#: Similarity of at least NUMERATOR / DENOMINATOR.
NUMERATOR, DENOMINATOR = 75, 100

_RANDOM = np.random.default_rng(20240531)
MULTIPLIERS = _RANDOM.integers(1, 2**63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RANDOM.integers(0, 2**63, K, dtype=np.uint64)
STEPS = _RANDOM.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(raw: np.ndarray, at: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a block of texts, repeats included, and the offsets of each text's.

    A text with fewer words has its whole sequence as one shingle; one without words has none.
    """
    found = Words(raw, at)
    w, counts = found.hashes, found.counts
    ends = np.cumsum(counts)
    starts = ends - counts
    n = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    out_at = np.concatenate([[0], np.cumsum(n)])
    if not len(w):
        return np.zeros(0, np.uint64), out_at
    first = np.arange(out_at[-1]) - np.repeat(out_at[:-1] - starts, n)
    length = np.repeat(np.minimum(counts, words), n)
    sums = length.astype(np.uint64)
    for j in range(words):
        there = np.minimum(first + j, len(w) - 1)
        sums = sums + np.where(length > j, w[there] * STEPS[j], np.uint64(0))
    return mix(sums), out_at


def distinct_sets(raw: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, part, part_at in blocks(raw, at):
        hashes, out_at = shingles(part, part_at)
        for i in range(len(out_at) - 1):
            yield np.unique(hashes[out_at[i]: out_at[i + 1]])


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """The first coordinates, of 32 bits each, of non-empty sets."""
    at = np.cumsum([0, *map(len, sets)])[:-1]
    joined = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    out = np.empty((len(sets), coordinates), np.uint32)
    if not len(sets):
        return out
    for k in range(coordinates):
        out[:, k] = np.minimum.reduceat(joined * MULTIPLIERS[k] + SHIFTS[k], at) >> np.uint64(32)
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = text_bytes(batch.column(1))
        for first, end, part, part_at in blocks(raw, at):
            sets = list(distinct_sets(part, part_at))
            full = [s for s in sets if len(s)]
            signature = iter(signatures(full, K1))
            size = [len(s) for s in sets]
            digests = np.zeros((2, len(sets)), np.uint64)
            for i, s in enumerate(sets):
                digests[0, i], digests[1, i] = np.add.reduce(mix(s)), np.bitwise_xor.reduce(mix(s + np.uint64(1)), initial=np.uint64(0))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, end - first), pa.array(size, pa.int64()),
                pa.array(digests[0].view(np.int64)), pa.array(digests[1].view(np.int64)),
                pa.array([next(signature).tobytes() if n else None for n in size], pa.binary()),
            ], names=["doc_id", "n_shingles", "d1", "d2", "signature"])


def features(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, d1, d2, signature)`` per row: set size, a 128-bit digest of the set, its first coordinates."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ids.mapInArrow(_features, "doc_id long, n_shingles long, d1 long, d2 long, signature binary")


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(batch.num_rows, -1)
        width = values.shape[1]
        tokens = (values.astype(np.uint64) | (np.arange(width, dtype=np.uint64) << np.uint64(32))).ravel().view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(np.repeat(batch.column("node").to_numpy(), width))], names=["token", "node"])


def _shared(signed: DataFrame) -> DataFrame:
    """``(token, node, df)``: the coordinate-value pairs of ``signed (node, signature)`` that occur more than once."""
    posted = signed.select("node", "signature").mapInArrow(_postings, "token long, node long")
    return posted.join(posted.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "token")


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = text_bytes(batch.column(1))
        for first, end, part, part_at in blocks(raw, at):
            sets = list(distinct_sets(part, part_at))
            rows = [i for i, s in enumerate(sets) if len(s)]
            values = signatures([sets[i] for i in rows], K)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, end - first).take(pa.array(rows, pa.int64())), pa.array([len(sets[i]) for i in rows], pa.int64()),
                pa.array([v.tobytes() for v in values], pa.binary()),
            ], names=["node", "n", "signature"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = text_bytes(batch.column(1))
        for first, end, part, part_at in blocks(raw, at):
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, end - first), pa.array([s.tobytes() for s in distinct_sets(part, part_at)], pa.binary()),
            ], names=["node", "hashes"])


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``docs`` that carry the id of a node: ``(node, text)``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    return rows_with_ids(texts, "node", nodes.select("node"))


def _sizes_fit(a: str, b: str) -> str:
    return f"{DENOMINATOR} * least({a}, {b}) >= {NUMERATOR} * greatest({a}, {b})"


def _linked(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if DENOMINATOR * min(len(one), len(two)) < NUMERATOR * max(len(one), len(two), 1):
        return False
    place = np.minimum(np.searchsorted(one, two), len(one) - 1)
    both = int((one[place] == two).sum())
    return DENOMINATOR * both >= NUMERATOR * (len(one) + len(two) - both)


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, K) for c in ("sa", "sb"))
            likely = pa.array((a == b).sum(1) >= T)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(likely)


def _likely(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The distinct pairs with at least T equal coordinates."""
    of = lambda c, s: signed.select(F.col("node").alias(c), F.col("signature").alias(s))
    joined = pairs.select("a", "b").distinct().join(of("a", "sa"), "a").join(of("b", "sb"), "b")
    return joined.select("a", "b", "sa", "sb").mapInArrow(_matches, "a long, b long")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = [[np.frombuffer(v, np.uint64) for v in batch.column(c).to_pylist()] for c in ("ha", "hb")]
        keep = pa.array([_linked(one, two) for one, two in zip(*sides)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(keep)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    of = lambda c, h: sets.select(F.col("node").alias(c), F.col("hashes").alias(h))
    joined = pairs.join(of("b", "hb"), "b").join(of("a", "ha"), "a")
    return joined.select("a", "b", "ha", "hb").mapInArrow(_confirm, "a long, b long").distinct()


def _matrix(group: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(-1, K)


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _across(group: pa.Table) -> Iterator[pa.RecordBatch]:
    """Links between a block of a component and a block of documents left over beside it."""
    out = np.array(group.column("outside").to_pylist())
    nodes, values, hashes = group.column("node").to_numpy(), _matrix(group), group.column("hashes")
    inner = np.flatnonzero(~out)
    found = []
    for i in np.flatnonzero(out):
        one = np.frombuffer(hashes[i].as_py(), np.uint64)
        for j in inner[(values[inner] == values[i]).sum(1) >= T]:
            if _linked(one, np.frombuffer(hashes[j].as_py(), np.uint64)):
                found.append((int(nodes[i]), int(nodes[j])))
    if found:
        yield _pair_batch(found)


def _among(group: pa.Table) -> Iterator[pa.RecordBatch]:
    """Likely pairs of different components in a block, or between two blocks, of the documents left over of one list.

    A pair is given out by the first list that both are left over of.
    """
    nodes, parts, values = group.column("node").to_numpy(), group.column("part").to_numpy(), _matrix(group)
    side, lists, token = group.column("side").to_numpy(), group.column("lists").to_pylist(), group.column("token")[0].as_py()
    same_block = group.column("first")[0].as_py() == group.column("second")[0].as_py()
    found = []
    for i in range(len(nodes)) if same_block else np.flatnonzero(side == 0):
        others = np.arange(i + 1, len(nodes)) if same_block else np.flatnonzero(side == 1)
        others = others[(parts[others] != parts[i]) & (nodes[others] != nodes[i])]
        for j in others[(values[others] == values[i]).sum(1) >= T]:
            if min(set(lists[i]).intersection(lists[j])) == token:
                found.append((int(nodes[i]), int(nodes[j])))
    if found:
        yield _pair_batch(found)


BLOCK = 1024


def _blocks(rows: DataFrame, key: str) -> DataFrame:
    """``(key, blocks)``: in how many blocks the rows of a key are compared."""
    return rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")


def links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Confirmed links ``(a, b)`` between distinct sets that connect all that any pair over the threshold connects.

    ``nodes (node, signature)``: the id of one document for each distinct set, and its first coordinates. Pairs inside a
    component that earlier links connect are not made: they change no component.
    """
    coarse = _shared(nodes).groupBy("node").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= T1)
    signed = stored(_texts(docs, stored(coarse.select("node"), "survivors")).mapInArrow(_signed, "node long, n long, signature binary"), "signatures")
    # Of c shared pairs, the c - T + 1 rarest belong to the prefix; pairs that occur once fill the rest of it and join nothing.
    by_node = _shared(signed).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("pairs"), F.sum("df").alias("weight"))
    by_node = by_node.where(F.size("pairs") >= T)
    prefix = by_node.join(signed.select("node", "n"), "node").select("node", "n", "weight", F.explode(F.expr(f"slice(pairs, 1, size(pairs) - {T - 1})")).alias("pair"))
    prefix = stored(prefix.select("pair.token", "node", "n", "weight"), "prefix")
    sets = stored(_texts(docs, stored(prefix.select("node").distinct(), "posted")).mapInArrow(_sets, "node long, hashes binary"), "sets")

    lists = prefix.groupBy("token").agg(
        F.max(F.struct("weight", (-F.col("node")).alias("minus"), "n")).alias("lead"), F.count(F.lit(1)).alias("m"),
    ).where("m > 1").select("token", (-F.col("lead.minus")).alias("leader"), F.col("lead.n").alias("leader_n"))
    met = prefix.join(lists, "token")
    stars = met.where("node <> leader").where(_sizes_fit("n", "leader_n")).select(F.col("leader").alias("a"), F.col("node").alias("b"))
    first = stored(_confirmed(_likely(stars, signed), sets), "links")
    parts = stored(components(first), "parts")

    label = lambda c: parts.select(F.col("node").alias(c), F.col("component").alias(f"{c}_part"))
    told = met.join(label("leader"), "leader", "left").join(label("node"), "node", "left").select(
        "token", "node", F.coalesce("node_part", "node").alias("part"), F.coalesce("leader_part", "leader").alias("main"),
    )
    left = stored(told.where("part <> main"), "left-over")

    # Documents left over against the component of their list's leader (a leader alone has met them already).
    beside = stored(left.select(F.col("main").alias("component"), "node").distinct().join(parts.select("component").distinct(), "component"), "beside")
    out_blocks, in_blocks = _blocks(beside, "component"), _blocks(parts, "component").withColumnRenamed("blocks", "inner")
    sizes = stored(out_blocks.join(in_blocks, "component"), "blocks")
    outer = beside.join(sizes, "component").select(
        "component", "node", _block("blocks").alias("ob"), F.explode(F.expr("sequence(0, inner - 1)")).alias("ib"), F.lit(True).alias("outside"),
    )
    inner = parts.join(sizes, "component").select(
        "component", "node", F.explode(F.expr("sequence(0, blocks - 1)")).alias("ob"), _block("inner").alias("ib"), F.lit(False).alias("outside"),
    )
    full = sets.join(signed.select("node", "signature"), "node")
    second = grouped(outer.unionByName(inner).join(full, "node"), ["component", "ob", "ib"], _across, "a long, b long")

    # Documents left over of one list against each other.
    many = stored(_blocks(left, "token").join(left.groupBy("token").count().where("count > 1").select("token"), "token"), "lists")
    rest = left.join(many, "token")
    of_node = rest.groupBy("node").agg(F.collect_list("token").alias("lists"))
    own = rest.join(of_node, "node").join(signed.select("node", "signature"), "node").withColumn("own", _block("blocks"))
    pairs = own.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "token", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "node", "part", "signature", "lists",
    )
    likely = grouped(pairs, ["token", "first", "second"], _among, "a long, b long")
    third = _confirmed(likely, sets)
    return first.unionByName(second).unionByName(third)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs (doc_id, text)``.

    Documents are linked when ``100 * common >= 75 * united`` distinct 5-word shingles; ``component_id`` is the smallest id
    reachable, ``kept`` marks the row that carries it. Null and blank texts have no shingles and link with nothing;
    rows without an id link with nothing, their ``component_id`` is null and they are kept. Rows that share an id are one
    document for ``kept``. Other columns are ignored, an empty table gives an empty result. Copies (equal sets) are
    collapsed by an aggregate before anything else, so their number costs one row each.
    """
    small_batches(docs.sparkSession, "4m")
    rows = stored(features(docs), "features")
    sets = rows.where("n_shingles > 0 and doc_id is not null")
    nodes = stored(sets.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("node"), F.min("signature").alias("signature")), "nodes")
    linked = components(links(docs, nodes.select("node", "signature")))
    named = nodes.select("n_shingles", "d1", "d2", "node").join(linked, "node", "left")
    named = named.select("n_shingles", "d1", "d2", F.coalesce("component", "node").alias("component"))
    full = rows.select("doc_id", "n_shingles", "d1", "d2").where("doc_id is not null and n_shingles > 0").join(named, ["n_shingles", "d1", "d2"])
    bare = rows.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    out = full.select("doc_id", "n_shingles", "component").unionByName(bare)
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group of near duplicates, all its columns.

    Of rows that repeat an id, one stays (the smallest by its columns as JSON); rows without an id stay as they are. Columns may
    have any names and types.
    """
    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own = rows.columns[names.index("doc_id")]
    kept = near_duplicates(docs).where("kept and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    chosen = rows.join(kept.withColumnRenamed("doc_id", "of_id"), F.col(own).cast("long") == F.col("of_id"))
    single = chosen.where("rows = 1").select(*rows.columns)
    rest = F.struct(*[c for c in rows.columns if c != own])
    several = chosen.where("rows > 1").groupBy(own).agg(F.min_by(rest, F.to_json(rest)).alias("row")).select(own, "row.*")
    out = single.unionByName(several.select(*rows.columns)).unionByName(rows.where(F.col(own).isNull()))
    return out.toDF(*names)
