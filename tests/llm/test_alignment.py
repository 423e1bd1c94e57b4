"""Token alignment against a plain version over the libraries' own ids."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from finlake.llm import alignment
from finlake.llm.queries import QUERIES
from tests.oracle import connect

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    "a", "the ", "ing", "'s", "!", " ", "  ", "\n", "\n\n", "é", "日本", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "▁", "x", "가", "\t",
    "\r", "\x00", "\U0001f600", "́", " hello", " World", "0123", "ﬁ", " ",
]


@pytest.fixture(scope="module")
def libraries():
    bpe = Tokenizer.from_file(BYTES)
    bpe.encode_special_tokens = True
    return bpe, sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def aligner():
    with open(BYTES, encoding="utf-8") as bpe, open(PIECES, "rb") as pieces:
        return alignment.Aligner(bpe.read(), pieces.read())


def plain(libraries, text):
    """(n_a, n_b, n_groups, n_links, digest, links per id pair) of one text."""
    bpe, pieces = libraries
    nothing = (0, 0, 0, 0, "", {})
    if not text:
        return nothing
    a, b = bpe.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
    of_a = [bytes(alignment.SHOWN[c] for c in bpe.id_to_token(i)) for i in a]
    of_b = [
        bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b
    ]
    if not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
        return nothing
    ends_a, ends_b = np.cumsum(list(map(len, of_a))).tolist(), np.cumsum(list(map(len, of_b))).tolist()
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    links = Counter(u << 32 | v for x, y in groups for u in x for v in y)
    shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    return len(a), len(b), len(groups), links.total(), hashlib.sha256(shown.encode()).hexdigest(), dict(links)


def corpus_rows(libraries, docs):
    found = [plain(libraries, text) for _, text in docs]
    counts = Counter(pair for *_, links in found for pair in links)
    best = defaultdict(int)
    for pair, n in counts.items():
        best[pair >> 32] = max(best[pair >> 32], n)
    return Counter(
        (doc_id, *f[:4], sum(t for p, t in f[5].items() if counts[p] == best[p >> 32]), sum(t * counts[p] for p, t in f[5].items()), f[4])
        for (doc_id, _), f in zip(docs, found)
    )


@pytest.mark.parametrize("joined", [1 << 21, 40])
def test_texts_are_aligned_as_the_libraries_cut_them(libraries, aligner, monkeypatch, joined):
    monkeypatch.setattr(alignment, "JOINED_PAIRS", joined)
    rng = random.Random(joined)
    texts = [None, "", " ", "\n", "x" * 4000, "a▁b"] + ["".join(rng.choices(PARTS, k=rng.randrange(40))) for _ in range(300)]
    columns = [c.to_pylist() for c in aligner.align(pa.array(texts, pa.string()))]
    for i, text in enumerate(texts):
        assert (*(c[i] for c in columns[:5]), dict(zip(columns[5][i], columns[6][i]))) == plain(libraries, text)


def test_whole_texts_where_pieces_reach_over_words(libraries, aligner, monkeypatch):
    monkeypatch.setattr(aligner.pieces, "apart", False)
    texts = ["one two  three", "", "x\ny "]
    columns = aligner.align(pa.array(texts))
    assert [c[2].as_py() for c in columns[:4]] == list(plain(libraries, texts[2])[:4])


def test_query_gives_the_rows_of_a_plain_version(spark, sf, libraries):
    docs = connect(sf).execute("select doc_id, text from documents").fetchall()
    assert Counter(map(tuple, QUERIES["op13_token_alignment"](spark, sf).collect())) == corpus_rows(libraries, docs)


def test_edges_and_both_joins(spark, libraries):
    docs = [(1, "hello world"), (1, "hello world"), (2, None), (3, ""), (None, "the end"), (4, "the " * 20_000), (5, "a▁b")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"row": F.lit(1), "pair": F.lit("x"), "n_a": F.lit(None), "times": F.lit(2)})
    want = corpus_rows(libraries, docs)
    assert Counter(map(tuple, alignment.alignments(df.repartition(3), BYTES, PIECES).collect())) == want
    stored = alignment.aligned(df, BYTES, PIECES)
    exchanged = alignment.summed(stored, alignment.pair_counts(stored), broadcast_rows=0)
    assert Counter(map(tuple, exchanged.collect())) == want
    assert "SortMergeJoin [pair" in exchanged._jdf.queryExecution().sparkPlan().toString()
    assert alignment.alignments(df.limit(0), BYTES, PIECES).count() == 0


def test_counts_handed_on_in_parts(spark, libraries, monkeypatch):
    docs = [(i, f"the {i} of {i * 7}") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    stored = alignment.aligned(df, BYTES, PIECES)
    whole = sorted(map(tuple, alignment.pair_counts(stored).collect()))
    monkeypatch.setattr(alignment, "COUNTED_PAIRS", 4)
    assert sorted(map(tuple, alignment.pair_counts(stored).collect())) == whole


def test_counts_are_summed_up_in_order_of_pair_whatever_the_batches():
    rng = np.random.default_rng(3)
    pair = np.sort(rng.integers(0, 6, 400) << 32 | rng.integers(0, 9, 400))
    n = rng.integers(1, 5, 400)
    total = Counter()
    for p, x in zip(pair.tolist(), n.tolist()):
        total[p] += x
    most = {a: max(x for p, x in total.items() if p >> 32 == a) for a in {p >> 32 for p in total}}
    want = [(p, x, x == most[p >> 32]) for p, x in sorted(total.items())]
    for size in (1, 7, 400):
        parts = [pa.RecordBatch.from_arrays([pa.array(pair[i: i + size]), pa.array(n[i: i + size])], names=["pair", "n"]) for i in range(0, 400, size)]
        got = [tuple(row.values()) for batch in alignment._best(iter([parts[0].slice(0, 0), *parts])) for row in batch.to_pylist()]
        assert got == want
    assert list(alignment._best(iter([]))) == []


def test_runs_in_order_of_pair_one_after_the_other():
    """Partitions of the exchange share no byte-level id; a task takes several of them, an earlier id may come later."""
    runs = [[(5, 1), (5, 1), (5, 2), (9, 0)], [(2, 3), (7, 1), (7, 1)], [], [(1, 1), (1, 2), (1, 2), (8, 4)]]
    pair = np.array([a << 32 | b for run in runs for a, b in run])
    n = np.arange(1, len(pair) + 1)
    total = Counter()
    for p, x in zip(pair.tolist(), n.tolist()):
        total[p] += x
    most = {a: max(x for p, x in total.items() if p >> 32 == a) for a in {p >> 32 for p in total}}
    for size in (1, 2, 3, 5, len(pair)):
        parts = [pa.RecordBatch.from_arrays([pa.array(pair[i: i + size]), pa.array(n[i: i + size])], names=["pair", "n"]) for i in range(0, len(pair), size)]
        told = list(alignment._best(iter(parts)))
        got = [tuple(row.values()) for batch in told for row in batch.to_pylist()]
        assert size > 1 or len(told) == len(most)  # each id's pairs leave when the next id comes
        assert sorted(got) == [(p, x, x == most[p >> 32]) for p, x in sorted(total.items())]


@pytest.fixture()
def many_partitions(spark):
    """Exchanges of 64 partitions, none merged, as a session may plan them."""
    wanted = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_files_are_as_few_as_the_alignment_needs(spark, libraries, many_partitions):
    """Each file that an executor's JVM stores may fork children of it, so partitions of a few rows do not make files."""
    docs = [(i, f"the {i} of {i * 7} and " + "x" * (i % 5)) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    stored = alignment.aligned(df, BYTES, PIECES)
    counts = alignment.pair_counts(stored)
    tasks = spark.sparkContext.defaultParallelism
    assert len(stored.inputFiles()) == 3 and len(counts.inputFiles()) <= tasks
    for broadcast_rows in (0, alignment.BROADCAST_PAIRS):
        sums = alignment.summed(stored, counts, broadcast_rows)
        assert sums.rdd.getNumPartitions() <= tasks
        assert Counter(map(tuple, sums.collect())) == corpus_rows(libraries, docs)


def test_more_parts_of_the_alignment_are_summed_up_by_more_tasks(spark, many_partitions, monkeypatch):
    df = spark.createDataFrame([(i, f"the {i}") for i in range(80)], "doc_id long, text string").repartition(20)
    stored = alignment.aligned(df, BYTES, PIECES)
    monkeypatch.setattr(alignment, "PARTS_A_TASK", 1)
    assert alignment._tasks(stored) == len(stored.inputFiles()) == 20 > spark.sparkContext.defaultParallelism
    assert alignment.summed(stored, alignment.pair_counts(stored)).rdd.getNumPartitions() == 20


def test_few_rows_are_decoded_at_a_time(spark):
    """A task holds the texts and lists of pairs of so many rows as arrays of the JVM."""
    spark.conf.unset("spark.sql.parquet.columnarReaderBatchSize")
    alignment.aligned(spark.createDataFrame([(1, "a")], "doc_id long, text string"), BYTES, PIECES)
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) == alignment.READ_ROWS <= 512


def test_a_worker_reads_the_vocabularies_once():
    with open(BYTES, encoding="utf-8") as bpe, open(PIECES, "rb") as pieces:
        both = bpe.read(), pieces.read()
    assert alignment.Aligner.of_worker(*both) is alignment.Aligner.of_worker(*both)


def test_broadcast_counts_leave_rows_in_their_tasks(spark):
    """Links and the other columns are summed up together: no sort, and one exchange of a row per text."""
    docs = [(i, f"the {i} of {i * 7}") for i in range(40)] + [(40, ""), (None, None)]
    stored = alignment.aligned(spark.createDataFrame(docs, "doc_id long, text string"), BYTES, PIECES)
    counts = alignment.pair_counts(stored)
    sums = alignment.summed(stored, counts)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Sort [" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert Counter(map(tuple, sums.collect())) == Counter(map(tuple, alignment.summed(stored, counts, broadcast_rows=0).collect()))


def test_forgotten_stretches_are_encoded_anew():
    raw = np.frombuffer(b"".join(b"%04d" % (i * i % 700) for i in range(4000)), np.uint8)
    first = np.arange(0, len(raw), 4)
    asked = []

    def encode(new):
        asked.extend(new)
        return [np.array([int(s), 7][: 1 + int(s) % 2], np.int32).tobytes() for s in new]

    known = alignment.Remembered(places=64, room=100)
    for begin in range(0, len(raw), 80):
        part = raw[begin: begin + 80]
        ids, ends = known.ids(part, first[:20], encode)
        numbers = [int(bytes(part[i: i + 4])) for i in range(0, 80, 4)]
        assert ids.tolist() == [x for n in numbers for x in [n, 7][: 1 + n % 2]]
        assert ends.tolist() == np.cumsum([1 + n % 2 for n in numbers]).tolist()
        assert known.used <= 100
    assert len(set(asked)) < len(asked) < 4000
    ids, _ = known.ids(raw, first, encode)  # more than the whole room at once
    assert ids[0] == 0 and known.used <= 100
