"""Table cleaning driven by a declarative description. Every step is one lazy ``DataFrame -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.functions.dates import parse_date
from finlake.functions.numbers import scale_units, to_bigint, to_double
from finlake.functions.text import NULL_TOKENS, quoted, strip_id, tidy_strings
from finlake.sinks.tables import YEAR


@dataclass(frozen=True)
class RowRule:
    """A row filter that applies only where all the columns it needs arrived.

    ``proves`` names columns that cannot be NULL in the rows it keeps.
    """

    needs: tuple[str, ...]
    keep: Callable[[], Column]
    proves: tuple[str, ...] = ()


@dataclass(frozen=True)
class UnitRule:
    """Scale ``value`` when ``unit`` says thousands; ``except_when`` keeps rows as filed."""

    value: str
    unit: str
    except_when: Callable[[], Column] | None = None


@dataclass(frozen=True)
class TableSpec:
    """One source table: where it comes from, how it is cleaned, what its quality checks expect.

    Column lists name what may arrive; absent columns are skipped. ``ids`` pairs a new column with the
    identifier it is stripped from, the last present source winning.
    """

    name: str
    document: str
    member: str
    rules: tuple[RowRule, ...] = ()
    doubles: tuple[str, ...] = ()
    bigints: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    ids: tuple[tuple[str, str], ...] = ()
    unit: UnitRule | None = None
    distinct: bool = False
    trim: bool = True
    drop_empty: bool = True
    tokens: tuple[str, ...] = NULL_TOKENS
    required: tuple[str, ...] | None = None
    key: tuple[str, ...] = ()


def cleaned_schema(spec: TableSpec, columns: Iterable[str]) -> T.StructType:
    """Types of cleaned columns by name, so that stored tables are read without looking into their files."""
    kinds = {c: T.DoubleType() for c in spec.doubles} | {c: T.LongType() for c in spec.bigints}
    kinds |= {c: T.DateType() for c in spec.dates} | {YEAR: T.IntegerType()}
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in dict.fromkeys([*columns, YEAR])])


def keep_rows(df: DataFrame, rules: Iterable[RowRule]) -> DataFrame:
    """Conjunction of the rules whose columns are present."""
    present = set(df.columns)
    for rule in rules:
        if present.issuperset(rule.needs):
            df = df.where(rule.keep())
    return df


def typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast the known columns in place and add the stripped identifiers, in one projection."""
    present = set(df.columns)
    exprs: dict[str, Column] = {c: quoted(c) for c in df.columns}
    exprs |= {c: to_double(quoted(c)) for c in spec.doubles if c in present}
    exprs |= {c: parse_date(quoted(c)) for c in spec.dates if c in present}
    exprs |= {c: to_bigint(quoted(c)) for c in spec.bigints if c in present}
    if spec.unit and present.issuperset((spec.unit.value, spec.unit.unit)):
        exempt = spec.unit.except_when() if spec.unit.except_when else None
        exprs[spec.unit.value] = scale_units(exprs[spec.unit.value], quoted(spec.unit.unit).cast("string"), exempt)
    exprs |= {target: strip_id(quoted(source)) for target, source in spec.ids if source in present}
    return df.select(*[e.alias(name) for name, e in exprs.items()])


def drop_empty(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows without any value dropped, the reference year aside.

    Needless, and left out, when a rule that applied proves a text column present: casts never empty those.
    """
    cast = {*spec.doubles, *spec.bigints, *spec.dates}
    applied = [r for r in spec.rules if set(df.columns).issuperset(r.needs)]
    if any(c not in cast for r in applied for c in r.proves):
        return df
    return df.dropna(how="all", subset=[f"`{c}`" if "." in c else c for c in df.columns if c != YEAR])


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Text tidied, rows filtered, columns typed, empty rows dropped, copies removed.

    Everything up to the last step is narrow. Copies are removed by a whole-row aggregate, which combines
    within each task before its exchange, so a row that makes up a third of the table shuffles once per task.
    """
    tidy = tidy_strings(df, spec.trim, spec.tokens)
    rows = typed(keep_rows(tidy, spec.rules), spec)
    if spec.drop_empty:
        rows = drop_empty(rows, spec)
    return rows.dropDuplicates() if spec.distinct else rows


def with_lineage(df: DataFrame, spec: TableSpec, run_ts, year: Column | int | None = None) -> DataFrame:
    """Reference year, run timestamp (one literal for the whole run) and document type."""
    columns = {"data_processamento": F.lit(run_ts).cast("timestamp"), "document_type": F.lit(spec.document)}
    if year is not None:
        column = year if isinstance(year, Column) else F.lit(year)
        columns[YEAR] = column.cast("int")
    return df.withColumns(columns)
