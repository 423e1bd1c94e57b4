"""What changed between two states of a table, repeated rows included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.text import quoted


def row_digest(columns: Sequence[str]) -> Column:
    """A digest of the given columns, NULLs and names included."""
    return F.sha2(F.to_json(F.struct(*map(quoted, columns)), {"ignoreNullFields": "false"}), 256)


def difference(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys..., incluidas, excluidas, alteradas)`` of every key whose rows differ, as numbers of rows.

    Rows are compared as multisets: a row that occurs twice and then once is one removed. Of the rows of a key that are gone and
    those that are new, as many as there are of both count as altered. NULL keys are keys. A column that one state lacks is NULL
    there.

    Both states go through one exchange of keys and digests, combined inside each task first; rows themselves stay where they are.
    """
    columns = sorted({*before.columns, *after.columns} - set(keys))

    def counted(df: DataFrame, sign: int) -> DataFrame:
        whole = df.withColumns({c: F.lit(None).cast("string") for c in columns if c not in df.columns})
        return whole.select(*map(quoted, keys), row_digest(columns).alias("__digest"), F.lit(sign).alias("__n"))

    net = counted(before, -1).unionByName(counted(after, 1)).groupBy(*map(quoted, keys), "__digest").agg(F.sum("__n").alias("__n"))
    per_key = net.where("__n <> 0").groupBy(*map(quoted, keys)).agg(
        F.sum(F.greatest("__n", F.lit(0))).alias("__more"), F.sum(F.greatest(-F.col("__n"), F.lit(0))).alias("__less")
    )
    both = F.least("__more", "__less")
    return per_key.select(
        *map(quoted, keys), (F.col("__more") - both).alias("incluidas"), (F.col("__less") - both).alias("excluidas"), both.alias("alteradas")
    )
