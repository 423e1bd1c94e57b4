"""Row selection by key, built on aggregates that combine before their exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions.text import quoted

# A dimension with more rows than this is never broadcast; callers also check its bytes.
BROADCAST_ROWS = 1_000_000


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values per key."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*map(quoted, rest)), F.struct(*map(quoted, order))).alias("__row")
    return df.groupBy(*map(quoted, keys)).agg(best).select(*map(quoted, keys), "__row.*").select(*df.columns)


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, always the same one: the greatest by the other columns in their order."""
    return newest(df, keys, [c for c in df.columns if c not in keys])


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups that occur more than once, with their row count ``n``. NULL keys group together."""
    return df.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _join_on_key(fact: DataFrame, fact_key: str, keys: DataFrame, how: str, broadcast: bool) -> DataFrame:
    """Join on ``__key``. Without a broadcast both sides are exchanged right before the join, so Spark splits the
    partitions of keys with many rows at run time and leaves the others alone.
    """
    return fact.join(F.broadcast(keys) if broadcast else keys, quoted(fact_key) == F.col("__key"), how)


def repeat_per_match(
    fact: DataFrame, fact_key: str, dimension: DataFrame, key: str, dimension_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Fact rows whose key is in the dimension, once per matching dimension row.

    Only the dimension's key column takes part. It is broadcast only when the caller knows it has at most
    ``broadcast_rows`` rows.
    """
    keys = dimension.select(quoted(key).alias("__key")).where("__key is not null")
    small = dimension_rows is not None and dimension_rows <= broadcast_rows
    return _join_on_key(fact, fact_key, keys, "inner", small).drop("__key")


def with_match(
    fact: DataFrame, fact_key: str, dimension: DataFrame, key: str, dimension_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Fact rows whose key is in the dimension, each once whatever the dimension repeats."""
    keys = dimension.select(quoted(key).alias("__key")).where("__key is not null")
    small = dimension_rows is not None and dimension_rows <= broadcast_rows
    return _join_on_key(fact, fact_key, keys, "left_semi", small)
