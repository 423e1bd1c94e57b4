"""Quality profile of a cleaned table as rows ``tabela, ano, metrica, coluna, valor``.

One aggregate pass over all columns gives counts, nulls, invalid and future values and distributions; one
narrow pass over the key columns gives duplicate groups and distinct companies. Both combine inside each task
before their exchange, so neither a hot company nor a hot year reaches one task as raw rows.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.functions.numbers import is_invalid, percentage
from finlake.functions.predicates import after
from finlake.functions.text import quoted

# Metric names, the columns each check looks at, and the null share that counts as an error.
HIGH_NULL_PERCENT = 50
COMPANY_COLUMNS = ("CNPJ_CIA", "CNPJ_Companhia")
INVALID_CHECKS = {
    "VL_CONTA": "invalid_monetary",
    "Dividendo_Distribuido_Total": "invalid_dividend",
    "Valor_Cotacao_Media": "invalid_stock_price",
}
FUTURE_CHECKS = ("DT_REFER", "Data_Fim_Trimestre", "Data_Fim_Exercicio_Social")
DISTRIBUTIONS = {
    "VL_CONTA": ("value_distribution", ("total", "count", "avg", "min", "max")),
    "Dividendo_Distribuido_Total": ("dividend_distribution", ("total", "count", "avg", "min", "max")),
    "Valor_Cotacao_Media": ("stock_price_distribution", ("count", "avg", "min", "max")),
}

# Aggregates are named "measure|column" until they are turned into rows.
MARK = "|"


@dataclass(frozen=True)
class Checks:
    """What to expect of one table. Checks whose columns are absent are skipped."""

    table: str
    required: tuple[str, ...] | None = None
    key: tuple[str, ...] = ()
    company: tuple[str, ...] = COMPANY_COLUMNS
    invalid: Mapping[str, str] = field(default_factory=lambda: INVALID_CHECKS)
    future: tuple[str, ...] = FUTURE_CHECKS
    distributions: Mapping[str, tuple[str, Sequence[str]]] = field(default_factory=lambda: DISTRIBUTIONS)


def missing_columns(df: DataFrame, checks: Checks) -> list[str]:
    """Required columns that did not arrive, known from the schema alone."""
    return [c for c in checks.required or () if c not in df.columns]


def _invalid(df: DataFrame, column: str) -> Column:
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return is_invalid(quoted(column)) if floating else quoted(column).isNull()


def _measures(df: DataFrame, checks: Checks, as_of: date) -> dict[str, Column]:
    """Aggregates of the pass over all columns."""
    present = set(df.columns)
    statistics = {"total": F.sum, "count": F.count, "avg": F.avg, "min": F.min, "max": F.max}
    measures = {f"null_percentage{MARK}{c}": F.count_if(quoted(c).isNull()) for c in df.columns}
    measures |= {
        f"{name}_values{MARK}{c}": F.count_if(_invalid(df, c)) for c, name in checks.invalid.items() if c in present
    }
    measures |= {
        f"future_dates{MARK}{c}": F.count_if(after(quoted(c), as_of)) for c in checks.future if c in present
    }
    for c, (name, wanted) in checks.distributions.items():
        if c in present:
            measures |= {f"{name}.{s}{MARK}{c}": statistics[s](quoted(c)) for s in wanted}
    return measures


def _made_from(measure: str) -> tuple[str, ...]:
    """Names of the metrics a measure turns into, statistics left off."""
    kind = measure.split(MARK)[0].split(".")[0]
    if kind == "null_percentage":
        return ("null_percentage", "null_percentages", "high_null_columns")
    return (kind, kind.replace("_values", "_pct")) if kind.endswith("_values") else (kind,)


def _grouped(df: DataFrame, by: str | None, aggregates: Mapping[str, Column]) -> DataFrame:
    columns = [a.cast("double").alias(n) for n, a in aggregates.items()]
    return df.groupBy(*([quoted(by)] if by else [])).agg(*columns)


def _keyed(df: DataFrame, checks: Checks, by: str | None) -> list[DataFrame]:
    """Duplicate key groups and distinct companies, a NULL company counting as one."""
    group = [by] if by else []
    company = next((c for c in checks.company if c in df.columns), None)
    key = [c for c in checks.key if c in df.columns]
    duplicates, companies = f"duplicates{MARK}", f"unique_companies{MARK}{company}"
    count, more_than_one = F.count(F.lit(1)), F.count_if(F.col("n") > 1)
    parts: list[DataFrame] = []
    if key:
        # The year is part of the group; a key that also names it must not list it twice.
        per_key = df.groupBy(*[quoted(c) for c in dict.fromkeys([*group, *key])]).agg(count.alias("n"))
        if company in key:
            per_company = per_key.groupBy(*[quoted(c) for c in [*group, company]]).agg(more_than_one.alias("d"))
            return [_grouped(per_company, by, {duplicates: F.sum("d"), companies: count})]
        parts.append(_grouped(per_key, by, {duplicates: more_than_one}))
    if company:
        distinct = df.select(*[quoted(c) for c in dict.fromkeys([*group, company])]).distinct()
        parts.append(_grouped(distinct, by, {companies: count}))
    return parts


@dataclass(frozen=True)
class Measured:
    """Measures of one table as rows ``tabela, ano, rows, nome, valor``, and their values where there are no rows."""

    table: str
    rows: DataFrame
    defaults: Mapping[str, float]


def _unpivoted(wide: DataFrame, checks: Checks, label: Column, by: str | None) -> DataFrame:
    rows = F.col("rows") if "rows" in wide.columns else F.lit(0.0)
    values = [c for c in wide.columns if c not in (by, "rows")]
    table = F.lit(checks.table).alias("tabela")
    flat = wide.select(table, label.cast("int").alias("ano"), rows.alias("rows"), *[quoted(c) for c in values])
    return flat.unpivot(["tabela", "ano", "rows"], [quoted(c) for c in values], "nome", "valor")


def measure(
    df: DataFrame, checks: Checks, as_of: date, by: str | None = None, year: int | None = None,
    only: Collection[str] | None = None,
) -> Measured:
    """The raw measures behind a profile; see :func:`profile`."""
    label = quoted(by) if by else F.lit(year)
    constants = {f"total_columns{MARK}": float(len(df.columns))}
    missing = missing_columns(df, checks)
    aggregates, keyed = {}, []
    if missing:
        constants |= {f"missing_columns{MARK}{c}": 1.0 for c in missing}
    else:
        aggregates = _measures(df, checks, as_of)
        keyed = _keyed(df, checks, by)

    def wanted(name: str) -> bool:
        return only is None or any(m in only for m in _made_from(name))

    aggregates = {n: a for n, a in aggregates.items() if wanted(n)}
    counted = F.count(F.lit(1))
    wide = _grouped(df, by, {"rows": counted, f"total_rows{MARK}": counted, **aggregates})
    wides = [wide.withColumns({n: F.lit(v) for n, v in constants.items()})]
    wides += [w for w in keyed if any(MARK in c and wanted(c) for c in w.columns)]
    defaults = {c: constants.get(c, 0.0) for w in wides for c in w.columns if MARK in c}
    rows = reduce(DataFrame.unionByName, [_unpivoted(w, checks, label, by) for w in wides])
    return Measured(checks.table, rows, defaults)


def _every_year(rows: DataFrame, parts: Sequence[Measured], years: Iterable[int]) -> DataFrame:
    """One row per table, year and measure, years without rows included (tables x columns x years, so few)."""
    expected = [(p.table, int(y), n, v) for p in parts for y in years for n, v in p.defaults.items()]
    frame = rows.sparkSession.createDataFrame(expected, "tabela string, ano int, nome string, vazio double")
    full = frame.join(rows, ["tabela", "ano", "nome"], "left")
    return full.withColumns({"rows": F.coalesce("rows", F.lit(0.0)), "valor": F.coalesce("valor", "vazio")})


def metrics_of(
    parts: Sequence[Measured], years: Iterable[int] | None = None, only: Collection[str] | None = None
) -> DataFrame:
    """Metrics of one or many tables. Shares and flags are worked out here, on a handful of rows."""
    rows = reduce(DataFrame.unionByName, [p.rows for p in parts])
    if years is not None:
        rows = _every_year(rows, parts, years)
    kind, value = F.substring_index("nome", MARK, 1), F.coalesce("valor", F.lit(0.0))
    share = percentage(value, F.col("rows"))

    def metrics(*pairs: tuple[Column, Column]) -> Column:
        return F.array(*[F.struct(name.alias("metrica"), v.alias("valor")) for name, v in pairs])

    found = (
        F.when(kind == "null_percentage", metrics(
            (kind, share), (F.lit("null_percentages"), F.round(share, 2)),
            (F.lit("high_null_columns"), F.when(share > HIGH_NULL_PERCENT, share)),
        ))
        .when(kind.endswith("_values"), metrics(
            (kind, value), (F.replace(kind, F.lit("_values"), F.lit("_pct")), F.round(share, 2)),
        ))
        .when(kind == "future_dates", metrics((kind, F.when(value > 0, value))))
        .otherwise(metrics((kind, value)))
    )
    column = F.expr(f"nullif(substr(nome, instr(nome, '{MARK}') + 1), '')").alias("coluna")
    listed = rows.select("tabela", "ano", column, F.inline(found)).where(F.col("valor").isNotNull())
    if only is not None:
        listed = listed.where(F.substring_index("metrica", ".", 1).isin(*only))
    return listed.select("tabela", "ano", "metrica", "coluna", "valor")


def profile(
    df: DataFrame, checks: Checks, as_of: date, by: str | None = None, year: int | None = None,
    years: Iterable[int] | None = None, only: Collection[str] | None = None,
) -> DataFrame:
    """All checks of one table, or those whose metric names are in ``only``.

    ``by`` profiles every year in the same passes; ``years`` then gives exactly those years, with or without
    rows. Without ``by`` the frame is one year, labelled ``year``. When a required column is missing, only the
    row and column totals and the missing names are reported.
    """
    return metrics_of([measure(df, checks, as_of, by, year, only)], years, only)


def errors(profiled: DataFrame) -> DataFrame:
    """Error counts ``tabela, ano, error_type, n``, one row per error type that occurred."""
    metric, column, value = F.col("metrica"), F.col("coluna"), F.col("valor")
    kind = (
        F.when(metric == "high_null_columns", F.lit("high_null_percentage"))
        .when(metric == "future_dates", F.concat(metric, F.lit("_"), column))
        .when(metric.isin("missing_columns", "duplicates") | metric.rlike("^invalid_.*_values$"), metric)
    )
    amount = F.when(metric == "high_null_columns", F.lit(1.0)).otherwise(value)
    found = profiled.select("tabela", "ano", kind.alias("error_type"), amount.alias("n"))
    found = found.where(F.col("error_type").isNotNull() & (F.col("n") > 0))
    return found.groupBy("tabela", "ano", "error_type").agg(F.sum("n").cast("bigint").alias("n"))


def error_totals(error_log: DataFrame) -> DataFrame:
    """Running totals over an error log, as a counter that only grows would show them."""
    return error_log.groupBy("tabela", "ano", "error_type").agg(F.sum("n").alias("n"))


def summary(profiled: DataFrame) -> DataFrame:
    """One row per table and year with the headline figures."""

    def figure(name: str) -> Column:
        return F.max(F.when(F.col("metrica") == name, F.col("valor"))).cast("bigint").alias(name)

    names = ("total_rows", "total_columns", "unique_companies", "invalid_monetary_values", "invalid_dividend_values",
             "invalid_stock_price_values", "duplicates")
    future = F.sum(F.when(F.col("metrica") == "future_dates", F.col("valor")).otherwise(0.0)).cast("bigint")
    return profiled.groupBy("tabela", "ano").agg(
        *[figure(n) for n in names],
        future.alias("future_dates"),
        F.count_if(F.col("metrica") == "high_null_columns").alias("high_null_columns"),
        F.count_if(F.col("metrica") == "missing_columns").alias("missing_columns"),
    )


def report(profiled: DataFrame) -> dict:
    """The profile of one table and year as a nested dictionary (a few rows per column come to the driver)."""
    rows = profiled.collect()
    found: dict = {"csv_key": rows[0]["tabela"], "ano": rows[0]["ano"], "validations": {}}
    validations = found["validations"]
    validations["missing_columns"] = [r["coluna"] for r in rows if r["metrica"] == "missing_columns"]
    if not validations["missing_columns"]:
        validations |= {"null_percentages": {}, "high_null_columns": []}
    for r in rows:
        metric, column, value = r["metrica"], r["coluna"], r["valor"]
        name, _, statistic = metric.partition(".")
        whole = int(value) if value.is_integer() else value
        if metric in ("total_rows", "total_columns"):
            found[metric] = whole
        elif metric == "null_percentages":
            validations[metric][column] = value
        elif metric == "high_null_columns":
            validations[metric].append(column)
        elif metric == "future_dates":
            validations[f"future_dates_{column}"] = whole
        elif statistic:
            validations.setdefault(name, {})[statistic] = whole if statistic == "count" else value
        elif metric not in ("missing_columns", "null_percentage"):
            validations[metric] = value if metric.endswith("_pct") else whole
    return found
