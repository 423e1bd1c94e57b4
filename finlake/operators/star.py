"""Star-schema tables as declarations: which columns, under which names, from which cleaned tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.text import account_level, quoted
from finlake.operators.rows import one_row_per_key, repeat_per_match, with_match
from finlake.sinks.tables import YEAR


@dataclass(frozen=True)
class Dimension:
    """Distinct projection of one table; ``tags`` are constant columns."""

    name: str
    source: str
    columns: Mapping[str, str]
    tags: Mapping[str, object] = field(default_factory=dict)
    key: str | None = None


@dataclass(frozen=True)
class Fact:
    """Union of renamed projections, one per source table with the source's own constant columns.

    ``present`` must not be NULL, ``level_of`` names the code whose depth becomes ``nivel``, ``default_zero``
    columns turn NULL into 0, ``difference`` adds ``name = left - right``, and ``company`` keeps only rows
    whose key is in the company dimension.
    """

    name: str
    sources: Mapping[str, Mapping[str, object]]
    columns: Mapping[str, str]
    tags: Mapping[str, object] = field(default_factory=dict)
    present: str | None = None
    level_of: str | None = None
    default_zero: tuple[str, ...] = ()
    difference: tuple[str, str, str] | None = None
    company: str | None = None


def renamed(df: DataFrame, columns: Mapping[str, str], tags: Mapping[str, object] | None = None) -> DataFrame:
    """Project ``source`` columns under their new names, plus constant columns."""
    constants = [F.lit(value).alias(name) for name, value in (tags or {}).items()]
    return df.select(*[quoted(source).alias(name) for name, source in columns.items()], *constants)


def build_dimension(df: DataFrame, dim: Dimension, unique: bool = False, tags: Mapping | None = None) -> DataFrame:
    """Distinct rows of the projection, or with ``unique`` exactly one row per ``dim.key``."""
    rows = renamed(df, dim.columns)
    rows = one_row_per_key(rows, [dim.key]) if unique and dim.key else rows.distinct()
    constants = {**dim.tags, **(tags or {})}
    return rows.withColumns({n: F.lit(v) for n, v in constants.items()}) if constants else rows


def build_fact(
    tables: Mapping[str, DataFrame], fact: Fact, companies: DataFrame | None = None,
    company_rows: int | None = None, fan_out: bool = True,
) -> DataFrame:
    """One fact over however many years the tables hold.

    ``fan_out`` repeats a row once per matching company row, as a plain inner join does; without it each row
    is kept once.
    """
    parts = []
    for table, tags in fact.sources.items():
        df = tables[table]
        if fact.present:
            df = df.where(quoted(fact.columns[fact.present]).isNotNull())
        parts.append(renamed(df, {**fact.columns, YEAR: YEAR}, {**fact.tags, **tags}))
    rows = reduce(DataFrame.unionByName, parts)
    if fact.company:
        if companies is None:
            raise ValueError(f"{fact.name} needs the company dimension")
        keep = repeat_per_match if fan_out else with_match
        rows = keep(rows, fact.company, companies, "cnpj", company_rows)
    extra: dict[str, Column] = {c: F.coalesce(quoted(c), F.lit(0)) for c in fact.default_zero}
    if fact.level_of:
        extra["nivel"] = account_level(quoted(fact.level_of))
    rows = rows.withColumns(extra) if extra else rows
    if fact.difference:
        name, left, right = fact.difference
        rows = rows.withColumn(name, quoted(left) - quoted(right))
    return rows.withColumn(YEAR, F.col(YEAR).cast("int"))
