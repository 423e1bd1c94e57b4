"""Restatement, joins over time, mergeable summaries, account trees, differences, incremental ingestion."""

import os
import random
import zipfile
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from finlake.lake import Lake
from finlake.operators import accounts, sketches, snapshots, temporal
from finlake.sinks.merge import merge_rows
from finlake.sinks.tables import YEAR, replace_years
from finlake.sources.tables import read_table
from finlake.streaming import bronze
from tests import bronze_fixture as fx


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Restatement


VERSIONED = f"k long, s string, v int, x int, {YEAR} int"


def years_files(path):
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in Path(path).glob(f"{YEAR}=*")}


def test_merge_rewrites_only_the_years_it_touches(spark, folder):
    path = f"{folder}/t"
    rows = [(k, "a", 1, k, 2000 + k % 4) for k in range(40)] + [(None, "a", 1, 7, 2001), (1, "b", None, 5, 2001), (2, "a", 1, 99, 2002)]
    replace_years(spark.createDataFrame(rows, VERSIONED), path, range(2000, 2004))
    before = years_files(path)
    updates = [
        (0, "a", 2, -1, 2000), (0, "a", 3, -2, 2000), (4, "a", 1, -3, 2000), (8, "a", 0, -4, 2000), (12, "a", None, -5, 2000),
        (None, "a", 2, -6, 2001), (1, "b", 1, -7, 2001), (2, "a", 2, -8, 2000), (100, "c", 1, -9, 2005),
    ]
    df = spark.createDataFrame(updates, VERSIONED)
    merged = merge_rows(df, path, ["k", "s"], "v")
    assert (merged.inserted, merged.restated) == (1, 4) and set(merged.rows) == {2000, 2001, 2002, 2005}
    want = [r for r in rows if (r[0], r[1]) not in {(0, "a"), (None, "a"), (1, "b"), (2, "a")}]
    want += [(0, "a", 3, -2, 2000), (None, "a", 2, -6, 2001), (1, "b", 1, -7, 2001), (2, "a", 2, -8, 2000), (100, "c", 1, -9, 2005)]
    assert rows_of(read_table(spark, path)) == sorted(want, key=repr)
    after = years_files(path)
    assert after[f"{YEAR}=2003"] == before[f"{YEAR}=2003"] and after[f"{YEAR}=2000"] != before[f"{YEAR}=2000"]
    # The same updates again touch nothing.
    assert merge_rows(df, path, ["k", "s"], "v").rows == {}
    assert years_files(path) == after


def test_merge_into_nothing_and_of_nothing(spark, folder):
    path = f"{folder}/t"
    df = spark.createDataFrame([(1, "a", 1, 5, 2000), (1, "a", 2, 6, 2001)], VERSIONED)
    assert merge_rows(df, path, ["k", "s"], "v").rows == {2001: 1}
    assert merge_rows(df.where("false"), path, ["k", "s"], "v").rows == {}
    assert rows_of(read_table(spark, path)) == [(1, "a", 2, 6, 2001)]


def test_merge_brings_new_columns(spark, folder):
    path = f"{folder}/t"
    replace_years(spark.createDataFrame([(1, "a", 1, 5, 2000), (2, "a", 1, 5, 2001)], VERSIONED), path, [2000, 2001])
    merge_rows(spark.createDataFrame([(1, "a", 2, 6, "new", 2000)], VERSIONED.replace("x int", "x int, y string")), path, ["k", "s"], "v")
    rows = {r["k"]: (r["x"], r["y"]) for r in read_table(spark, path, merge_schema=True).collect()}
    assert rows == {1: (6, "new"), 2: (5, None)}


# Joins over time


def plain_asof(left, right, strict):
    out = []
    for k, t, x in left:
        best = None
        for k2, t2, v in right:
            if k is not None and k == k2 and t is not None and t2 is not None and (t2 < t or not strict and t2 == t):
                best = max(best or (t2, v), (t2, v))
        out.append((k, t, x, best and best[1]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("rows_per_range", [10**6, 7])
def test_asof_join(spark, strict, rows_per_range):
    rng = random.Random(rows_per_range)
    key = lambda: rng.choice([1, 1, 1, 1, 2, 3, None])
    time = lambda: rng.choice([None, *range(-20, 40)])
    left, right = [(key(), time(), i) for i in range(120)] * 2, [(key(), time(), i) for i in range(60)]
    a, b = spark.createDataFrame(left, "k int, t int, state int"), spark.createDataFrame(right, "k int, u int, held int")
    got = temporal.asof_join(a, b, ["k"], "t", "u", {"row": "held"}, strict, rows_per_range)
    assert got.columns == ["k", "t", "state", "row"]
    assert rows_of(got) == plain_asof(left, right, strict)
    assert temporal.asof_join(a.limit(0), b.limit(0), ["k"], "t", "u", {"row": "held"}).count() == 0
    assert {r[3] for r in temporal.asof_join(a, b.limit(0), ["k"], "t", "u", {"row": "held"}).collect()} == {None}


def test_a_hot_key_is_many_tasks_in_an_asof_join(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    got = temporal.asof_join(rows, rows, ["k"], "t", "t", {"seen": "t"}, rows_per_range=1000)
    assert got.where("seen = t - 1").count() == 19_999
    ranges = got.select("t", F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert max(r["count"] for r in ranges) < 20_000


@pytest.mark.parametrize("kind, of", [
    ("timestamp", datetime(2024, 3, 31, 1, 30, 0, 7)), ("timestamp_ntz", datetime(2024, 3, 31, 2, 30, 0, 7)), ("date", date(1960, 5, 1)), ("int", -4),
])
def test_instants(spark, kind, of):
    got = spark.createDataFrame([(of,)], f"t {kind}").select(temporal.instant(F.col("t"), kind)).first()[0]
    since = of if kind == "int" else (of - date(1970, 1, 1)).days if kind == "date" else None
    if since is None:
        since = int((of - datetime(1970, 1, 1)).total_seconds()) * 10**6 + of.microsecond
    assert got == since


def test_interval_join(spark):
    rng = random.Random(3)

    def some(n):
        out = []
        for i in range(n):
            start = rng.choice([None, *range(-300, 300)])
            length = rng.choice([0, 0, 1, 2, 7, 8, 9, 60, 500, -3, None])
            out.append((rng.choice([1, 1, 1, 2, None]), start, None if start is None or length is None else start + length, i))
        return out

    left, right = some(150) + [(1, 0, 0, 900)] * 2, some(150)
    a, b = spark.createDataFrame(left, "k int, x int, y int, id int"), spark.createDataFrame(right, "k int, u int, v int, id int")
    got = temporal.interval_join(a, b, ["k"], ("x", "y"), ("u", "v"))
    assert got.columns == ["k", "x", "y", "id", "right_k", "right_u", "right_v", "right_id"]
    ok = lambda r: None not in r[:3] and r[1] <= r[2]
    want = Counter((*p, *q) for p in left for q in right if ok(p) and ok(q) and p[0] == q[0] and p[1] <= q[2] and q[1] <= p[2])
    assert Counter(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert temporal.interval_join(a.limit(0), b, ["k"], ("x", "y"), ("u", "v")).count() == 0


# Summaries


def test_distinct_counts_of_unions(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 20_000).alias("a"), F.lit(None).cast("string").alias("b"))
    made = sketches.distinct_sketches(df, ["a", "b"], ["g"])
    found = {r["coluna"]: r["distintos"] for r in sketches.distinct_counts(made).collect()}
    assert found["b"] == 0 and abs(found["a"] - 20_000) <= 20_000 * 4 * sketches.DISTINCT_ERROR
    single = {r["g"]: r["distintos"] for r in sketches.distinct_counts(made, ["g"]).where("coluna = 'a'").collect()}
    assert set(single) == {0, 1, 2} and all(abs(n - 20_000) <= 800 for n in single.values())
    assert sketches.distinct_counts(sketches.distinct_sketches(df.limit(0), ["a"], ["g"])).count() == 0


def test_quantiles_of_unions(spark):
    df = spark.range(40_000).select((F.col("id") % 5).alias("g"), ((F.col("id") * 7919) % 40_000).cast("double").alias("x"))
    df = df.unionByName(spark.createDataFrame([(0, float("nan")), (1, None)], "g long, x double"))
    rows = sketches.quantiles(sketches.quantile_sketches(df, ["x"], ["g"]), [0.1, 0.5, 0.99]).collect()
    assert {r["n"] for r in rows} == {40_000}
    assert all(abs(r["valor"] - r["parte"] * 40_000) <= 40_000 * sketches.QUANTILE_ERROR + 1 for r in rows)
    assert sketches.quantiles(sketches.quantile_sketches(df.where("x is null"), ["x"]), [0.5]).count() == 0


def test_histograms(spark):
    values = [0.001, 0.005, 0.006, 3.0, 10.0, 11.0, -1.0, float("nan"), None, float("inf")]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "run int, s double")
    made = sketches.histogram(df, "s", sketches.SECONDS_BOUNDS, ["run"])
    merged = {r["ate"]: r["n"] for r in sketches.merged_histograms(made).collect()}
    assert merged == {0.005: 3, 0.01: 1, 5.0: 1, 10.0: 1, float("inf"): 2}


# Accounts


def test_roll_up_and_unbalanced(spark):
    rows = [("1.01.01", 5), ("1.01.02", 7), ("1.01.02", 1), ("1.01", 13), ("1.02", None), ("1", 14), ("2", 3), (None, 9), ("3.1.1", 2)]
    df = spark.createDataFrame([(2020, c, a) for c, a in rows] + [(None, "1", 5), (None, "1.1", 4)], "y int, c string, a long")
    total = {(r["y"], r["c"]): (r["nivel"], r["total"], r["contas"]) for r in accounts.roll_up(df, "c", "a", ["y"]).collect()}
    assert total[2020, "1"] == (1, 40, 6) and total[2020, "1.01"] == (2, 26, 4) and total[2020, "1.02"] == (2, None, 1)
    assert total[2020, "3"] == (1, 2, 1) and total[None, "1"] == (1, 9, 2)
    off = rows_of(accounts.unbalanced(df, "c", "a", ["y"]))
    assert off == sorted([(2020, "1", 14, 13, 2), (None, "1", 5, 4, 1)], key=repr)
    assert rows_of(accounts.unbalanced(df, "c", "a", ["y"], tolerance=1)) == []


def test_wide(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "b", 3), (1, "a.x", 1), (2, None, 9), (3, "a.x", None)], "k int, c string, v int")
    out = accounts.wide(df, ["k"], "c", "v")
    assert out.columns == ["k", "a.x", "b"] and rows_of(out) == [(1, 1, 5), (2, None, None), (3, None, None)]
    with pytest.raises(ValueError, match="more than 1"):
        accounts.wide(df, ["k"], "c", "v", most=1)
    assert accounts.wide(df.limit(0), ["k"], "c", "v").columns == ["k"]


# Differences


def test_difference(spark):
    before = [(1, "a"), (1, "a"), (2, "b"), (3, None), (4, "d"), (5, "e"), (None, "n"), (6, "x")]
    after = [(1, "a"), (2, "c"), (3, ""), (5, "e"), (5, "e"), (None, "m"), (7, "y"), (6, "x")]
    a, b = spark.createDataFrame(before, "k int, v string"), spark.createDataFrame(after, "k int, v string")
    got = {r[0]: tuple(r)[1:] for r in snapshots.difference(a, b, ["k"]).collect()}
    assert got == {1: (0, 1, 0), 2: (0, 0, 1), 3: (0, 0, 1), 4: (0, 1, 0), 5: (1, 0, 0), None: (0, 0, 1), 7: (1, 0, 0)}
    assert snapshots.difference(a, a, ["k"]).count() == 0
    wider = snapshots.difference(a, a.withColumn("w", F.lit(1)), ["k"])
    assert {tuple(r)[1:] for r in wider.collect()} == {(0, 0, 1), (0, 0, 2)}


# Incremental ingestion


def test_only_years_with_a_newer_archive_are_built(spark, folder):
    root = fx.write_bronze(folder)
    lake, calls = Lake(str(root)), []

    def build(spark, lake, document, years, run_ts=None):
        calls.append(years)
        return bronze.build_silver(spark, lake, document, years, ["DRE_con"], run_ts)

    first = bronze.ingest_new_archives(spark, lake, "DFP", build=build)
    assert {y: [o.ok for o in found] for y, found in first.items()} == {2020: [True], 2021: [True]}
    assert bronze.ingest_new_archives(spark, lake, "DFP", build=build) == {}
    untouched = sorted(os.listdir(f"{lake.silver('DRE_con')}/{YEAR}=2020"))
    fx.write_zip(fx.snapshot(root, fx.DFP, 2021, "2024-02-01", "10-00-00", "dfp"), fx.dfp_members(2021, fx.DRE_2020))
    fx.write_zip(fx.snapshot(root, fx.DFP, 2020, "2023-01-01", "10-00-00", "dfp"), fx.dfp_members(2020, fx.DRE_2020[:1]))
    again = bronze.ingest_new_archives(spark, lake, "DFP", build=build)
    assert calls == [[2020, 2021], [2021]] and [o.rows for o in again[2021]] == [6]
    assert sorted(os.listdir(f"{lake.silver('DRE_con')}/{YEAR}=2020")) == untouched
    with zipfile.ZipFile(fx.snapshot(root, fx.DFP, 2020, "2023-01-01", "10-00-00", "dfp")) as archive:
        assert archive.namelist()


def test_a_failed_rebuild_comes_again(spark, folder):
    Path(folder, "in/ano=7").mkdir(parents=True)
    Path(folder, "in/ano=7/a.zip").write_bytes(b"x")
    year, calls = F.regexp_extract("path", r"/ano=(\d+)/", 1), []

    def rebuild(newest):
        calls.append(set(newest))
        if len(calls) == 1:
            raise RuntimeError("lost")

    def run():
        return bronze.rebuild_changed(spark, f"{folder}/in", ".zip", year, F.col("path"), f"{folder}/state", rebuild)

    with pytest.raises(Exception, match="lost"):
        run()
    assert set(run()) == {"7"} and calls == [{"7"}, {"7"}]
    assert run() == {} and len(calls) == 2
