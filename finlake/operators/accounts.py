"""Statements as trees and as wide tables: roll-up along dotted account codes, and accounts as columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.text import quoted

#: Accounts that a wide statement may have as columns.
MOST_COLUMNS = 1000


def ancestors(code: Column) -> Column:
    """A dotted code and all codes above it, the shortest first; NULL for NULL."""
    parts = F.split(code, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))


def parent(code: Column) -> Column:
    """The code above; NULL for one without a dot."""
    return F.when(F.contains(code, F.lit(".")), F.regexp_replace(code, r"\.[^.]*$", ""))


def roll_up(df: DataFrame, code: str, amount: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., code, nivel, total, contas)``: the amounts of each account and all below it, and how many rows they are.

    Rows are summed per account before they are handed to the accounts above, so the expansion grows with the accounts and
    not with the rows. Rows without a code take no part; NULL amounts are rows without an amount.
    """
    own = df.where(quoted(code).isNotNull()).groupBy(*map(quoted, by), quoted(code)).agg(
        F.sum(quoted(amount)).alias("__total"), F.count(F.lit(1)).alias("__rows")
    )
    spread = own.select(*map(quoted, by), F.explode(ancestors(quoted(code))).alias("__code"), "__total", "__rows")
    out = spread.groupBy(*map(quoted, by), "__code").agg(F.sum("__total").alias("total"), F.sum("__rows").alias("contas"))
    return out.select(*map(quoted, by), F.col("__code").alias(code), F.size(F.split("__code", r"\.")).alias("nivel"), "total", "contas")


def unbalanced(df: DataFrame, code: str, amount: str, by: Sequence[str] = (), tolerance: float = 0) -> DataFrame:
    """``(by..., code, valor, filhas, n_filhas)`` of accounts whose filed amount is not the sum of their direct children's.

    Several rows of an account count as their sum. Accounts without children, and children without a filed parent, are not
    reported; NULL amounts count as none.
    """
    own = df.where(quoted(code).isNotNull()).groupBy(*map(quoted, by), quoted(code)).agg(F.sum(quoted(amount)).alias("valor"))
    below = own.select(*[quoted(b).alias(f"__by{i}") for i, b in enumerate(by)], parent(quoted(code)).alias("__parent"), "valor")
    below = below.where("__parent is not null").groupBy(*[f"__by{i}" for i in range(len(by))], "__parent").agg(
        F.sum("valor").alias("filhas"), F.count(F.lit(1)).alias("n_filhas")
    )
    same = [quoted(b).eqNullSafe(F.col(f"__by{i}")) for i, b in enumerate(by)]
    met = own.join(below, reduce(lambda a, b: a & b, [*same, quoted(code) == F.col("__parent")]))
    off = F.abs(F.coalesce("valor", F.lit(0)) - F.coalesce("filhas", F.lit(0))) > tolerance
    return met.where(off).select(*map(quoted, by), quoted(code), "valor", "filhas", "n_filhas")


def wide(df: DataFrame, by: Sequence[str], column: str, amount: str, most: int = MOST_COLUMNS) -> DataFrame:
    """A row per ``by``, a column per value of ``column`` with the sum of its amounts, columns in the order of their names.

    The columns are found first; more than ``most`` of them are an error, not a cut. Amounts are then summed per row and column
    before they are laid side by side. A NULL value has no column.
    """
    found = df.select(quoted(column).cast("string").alias("v")).where("v is not null").distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    names = sorted(r["v"] for r in found)
    rows = df.select(*map(quoted, by), quoted(column).cast("string").alias("__column"), quoted(amount).alias("__amount"))
    if not names:
        return rows.select(*map(quoted, by)).distinct()
    return rows.groupBy(*map(quoted, by)).pivot("__column", names).agg(F.sum("__amount"))
