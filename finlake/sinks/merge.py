"""Row-level restatement of a table stored by year: only the years that a change touches are rewritten."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.text import quoted
from finlake.operators.rows import newest
from finlake.session import scratch_dir
from finlake.sinks.tables import YEAR, remove, replace_years, stored_years
from finlake.sources.tables import read_table


@dataclass(frozen=True)
class Merged:
    """Rows now stored in each rewritten year, and how many keys were new or restated."""

    rows: dict[int, int]
    inserted: int
    restated: int


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [quoted(x).eqNullSafe(quoted(y)) for x, y in pairs])


def merge_rows(updates: DataFrame, path: str, keys: Sequence[str], version: str, year: str = YEAR) -> Merged:
    """Put ``updates`` into the table at ``path``: per key, the row with the greatest ``version`` is stored.

    A key that is not stored is inserted. One that is stored is restated by a greater version (any beats a NULL one), which
    replaces all its rows, also where its year changes; an equal or older version changes nothing, so the same updates can come
    again. NULL keys are keys. Rows of the other keys stay as they are, repeated ones too.

    The stored keys are read once, with no other column than version and year, to find the years to rewrite; files of all other
    years are not touched. Updates of one key are reduced to the newest before anything else.
    """
    spark, keys = updates.sparkSession, list(keys)
    if not stored_years(spark, path, year):
        rows = newest(updates, keys, [version])
        years = [r[0] for r in rows.select(F.col(year).cast("int")).distinct().collect()]
        written = replace_years(rows, path, years, year)
        return Merged(written, sum(written.values()), 0)
    stored = read_table(spark, path, merge_schema=True)
    new = newest(updates, keys, [version])
    place = [f"__key{i}" for i in range(len(keys))]
    asked = new.select(*[quoted(k).alias(p) for k, p in zip(keys, place)])
    held = stored.select(*map(quoted, keys), quoted(version).alias("__version"), quoted(year).alias("__year"))
    held = held.join(asked, _same(list(zip(keys, place))), "left_semi").groupBy(*map(quoted, keys)).agg(
        F.max("__version").alias("__version"), F.collect_set("__year").alias("__years")
    )
    held = held.select(*[quoted(k).alias(p) for k, p in zip(keys, place)], "__version", "__years")
    newer = F.col("__years").isNull() | F.coalesce(quoted(version) > F.col("__version"), F.col("__version").isNull() & quoted(version).isNotNull())
    scratch = scratch_dir(spark, "merge")
    try:
        new.join(held, _same(list(zip(keys, place))), "left").where(newer).write.parquet(scratch)
        won = spark.read.parquet(scratch)
        touched = won.select(F.explode(F.array_union(
            F.array(quoted(year).cast("int")), F.coalesce(F.col("__years"), F.array().cast("array<int>")))).alias("y")).distinct().collect()
        counts = won.agg(F.count_if(F.col("__years").isNull()).alias("new"), F.count_if(F.col("__years").isNotNull()).alias("old")).first()
        if not touched:
            return Merged({}, 0, 0)
        years = sorted(r["y"] for r in touched)  # one row per year
        gone = won.select(*[quoted(k).alias(p) for k, p in zip(keys, place)])
        stay = stored.where(quoted(year).isin(years)).join(gone, _same(list(zip(keys, place))), "left_anti")
        rows = stay.unionByName(won.select(*map(quoted, updates.columns)), allowMissingColumns=True)
        return Merged(replace_years(rows, path, years, year), counts["new"], counts["old"])
    finally:
        remove(spark, scratch)
