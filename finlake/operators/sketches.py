"""Summaries that merge: distinct counts, quantiles and histograms kept per year, so spans of years need no second scan.

A summary is a small binary value, or a few counts, per group. Those of several groups make that of their union, and a year that
is rewritten replaces its own only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.text import quoted

#: Registers of a distinct-count sketch are two to this power; its standard error is 1.04 over their root, below 0.9 %.
DISTINCT_BITS = 14
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_BITS / 2)
#: Size of a quantile sketch, and the share of rows by which the rank of a quantile is off at most, with 99 % confidence.
QUANTILE_SIZE = 400
QUANTILE_ERROR = 0.01
#: Upper bounds, in seconds, of the buckets that processing times are counted in.
SECONDS_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def _long(df: DataFrame, by: Sequence[str], columns: dict[str, Column], value: str) -> DataFrame:
    """One aggregate over all columns, then a row per group and column."""
    made = df.groupBy(*map(quoted, by)).agg(*[c.alias(f"s{i}") for i, c in enumerate(columns.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("coluna"), F.col(f"s{i}").alias(value)) for i, name in enumerate(columns)])
    return made.select(*map(quoted, by), F.inline(rows))


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., coluna, esboco)``: a distinct-count sketch of each column per group. NULLs do not count."""
    return _long(df, by, {c: F.hll_sketch_agg(quoted(c).cast("string"), F.lit(DISTINCT_BITS)) for c in columns}, "esboco")


def distinct_counts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., coluna, distintos)`` of the union of stored sketches. Groups without a value count 0."""
    union = F.hll_union_agg("esboco", F.lit(False))
    return sketches.groupBy(*map(quoted, by), "coluna").agg(F.coalesce(F.hll_sketch_estimate(union), F.lit(0)).alias("distintos"))


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., coluna, esboco)``: a quantile sketch of each numeric column per group. NULL and NaN do not count."""
    finite = lambda c: F.when(~F.isnan(quoted(c).cast("double")), quoted(c).cast("double"))
    return _long(df, by, {c: F.kll_sketch_agg_double(finite(c), F.lit(QUANTILE_SIZE)) for c in columns}, "esboco")


def quantiles(sketches: DataFrame, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., coluna, n, parte, valor)`` of the union of stored sketches; a group without a value has no rows."""
    union = sketches.groupBy(*map(quoted, by), "coluna").agg(F.kll_merge_agg_double("esboco").alias("esboco"))
    union = union.withColumn("n", F.kll_sketch_get_n_double("esboco")).where("n > 0")
    parts = union.withColumn("parte", F.explode(F.array(*map(F.lit, shares))))
    value = reduce(
        lambda other, share: F.when(F.col("parte") == share, F.kll_sketch_get_quantile_double("esboco", F.lit(float(share)))).otherwise(other),
        shares, F.lit(None).cast("double"),
    )
    return parts.select(*map(quoted, by), "coluna", "n", "parte", value.alias("valor"))


def histogram(df: DataFrame, column: str, bounds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., ate, n, soma)``: rows of each bucket up to and with its bound ``ate``, and the sum of their values. The last
    bucket's bound is infinite; NULL and NaN are not counted, buckets without rows are absent."""
    value = quoted(column).cast("double")
    limits = [*sorted(set(map(float, bounds))), float("inf")]
    upper = F.array_min(F.filter(F.array(*map(F.lit, limits)), lambda b: b >= value))
    rows = df.where(value.isNotNull() & ~F.isnan(value)).withColumn("ate", upper)
    return rows.groupBy(*map(quoted, by), "ate").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("soma"))


def merged_histograms(histograms: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Histograms of several groups, or runs, as one per ``by``."""
    return histograms.groupBy(*map(quoted, by), "ate").agg(F.sum("n").alias("n"), F.sum("soma").alias("soma"))
