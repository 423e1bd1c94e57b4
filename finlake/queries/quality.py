"""Quality checks over the given tables, with nulls, NaN and future dates derived where checks need them."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.lake import Lake
from finlake.operators.quality import Checks, error_totals, errors, profile, summary
from finlake.operators.rows import duplicate_groups
from finlake.plans.builds import sweep
from finlake.plans.specs import PROFILED
from finlake.queries import filings
from finlake.queries.gold import cleaned
from finlake.queries.registry import query, table
from finlake.session import at_once, scratch_dir
from finlake.sinks.tables import YEAR, overwrite_table, years_in
from finlake.sources.tables import read_table

AS_OF = date(2001, 1, 1)

_OBSERVED = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_suppkey": "case when l_returnflag = 'R' then null else l_suppkey end",
    "l_extendedprice": "case when l_quantity = 1 then null when l_quantity = 2 then cast('NaN' as double) "
                       "else l_extendedprice end",
    "l_tax": "case when l_quantity > 40 then null else l_tax end",
    "l_shipdate": "case when l_quantity = 3 then null else cast(l_shipdate as date) end",
    "l_linestatus": "case when l_quantity > 20 then null else l_linestatus end",
    "ano_referencia": "cast(year(l_shipdate) as int)",
}
_OBSERVED_SQL = "select " + ", ".join(f"{e} as {c}" for c, e in _OBSERVED.items()) + " from lineitem"

CHECKS = Checks(
    "lineitem", required=("l_orderkey", "l_extendedprice"), key=("l_suppkey", "l_orderkey", "l_linenumber"),
    company=("l_suppkey",), invalid={"l_extendedprice": "invalid_monetary"}, future=("l_shipdate",),
    distributions={
        "l_tax": ("value_distribution", ("total", "count", "avg", "min", "max")),
        "l_quantity": ("stock_price_distribution", ("count", "avg", "min", "max")),
    },
)


def observed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*[f"{e} as {c}" for c, e in _OBSERVED.items()])


def _profile(spark: SparkSession, sf: str, *only: str) -> DataFrame:
    return profile(observed(spark, sf), CHECKS, AS_OF, only=only).drop("tabela", "ano")


@query(f"""
    with o as ({_OBSERVED_SQL})
    select 'total_rows' as metrica, cast(null as varchar) as coluna, cast(count(*) as double) as valor from o
    union all select 'total_columns', null, {len(_OBSERVED)}
    union all
    select 'unique_companies', 'l_suppkey', count(distinct l_suppkey) + max(case when l_suppkey is null then 1 else 0 end)
    from o
""")
def row_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf, "total_rows", "total_columns", "unique_companies")


def _null_share(c: str) -> str:
    return f"select '{c}' as coluna, count(*) filter ({c} is null) * 100.0::double / count(*) as valor from o"


@query(f"with o as ({_OBSERVED_SQL}) " + " union all ".join(_null_share(c) for c in _OBSERVED))
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf, "null_percentage").drop("metrica")


@query(f"with o as ({_OBSERVED_SQL}) select * from ("
       + " union all ".join(_null_share(c) for c in _OBSERVED) + ") where valor > 50")
def high_null(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf, "high_null_columns").drop("metrica")


@query(f"""
    with o as ({_OBSERVED_SQL}), i as (
        select count(*) as total, count(*) filter (l_extendedprice is null or coalesce(isnan(l_extendedprice), false)) as n
        from o)
    select 'invalid_monetary_values' as metrica, 'l_extendedprice' as coluna, cast(n as double) as valor from i
    union all select 'invalid_monetary_pct', 'l_extendedprice', round(n * 100.0::double / total, 2) from i
""")
def invalid_values(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf, "invalid_monetary_values", "invalid_monetary_pct")


@query(f"""
    select 'l_shipdate' as coluna, cast(count(*) filter (l_shipdate > date '2001-01-01') as double) as valor
    from ({_OBSERVED_SQL})
""")
def future_dates(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf, "future_dates").drop("metrica")


@query("""
    select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1
""")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"""
    select cast(count(*) as double) as duplicates from (
        select 1 from ({_OBSERVED_SQL}) group by l_suppkey, l_orderkey, l_linenumber having count(*) > 1)
""")
def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf, "duplicates").select(F.col("valor").alias("duplicates"))


@query(f"""
    with o as ({_OBSERVED_SQL})
    select 'value_distribution.total' as metrica, round(sum(l_tax), 4) as valor from o
    union all select 'value_distribution.count', cast(count(l_tax) as double) from o
    union all select 'value_distribution.avg', round(avg(l_tax), 8) from o
    union all select 'value_distribution.min', min(l_tax) from o
    union all select 'value_distribution.max', max(l_tax) from o
""")
def value_distribution(spark: SparkSession, sf: str) -> DataFrame:
    found = _profile(spark, sf, "value_distribution").drop("coluna")
    digits = F.when(F.col("metrica").endswith("avg"), F.round("valor", 8)).otherwise(F.round("valor", 4))
    return found.select("metrica", digits.alias("valor"))


@query("""
    select 'stock_price_distribution.count' as metrica, cast(count(l_quantity) as double) as valor from lineitem
    union all select 'stock_price_distribution.avg', round(avg(l_quantity), 8) from lineitem
    union all select 'stock_price_distribution.min', min(l_quantity) from lineitem
    union all select 'stock_price_distribution.max', max(l_quantity) from lineitem
""")
def value_distribution_nosum(spark: SparkSession, sf: str) -> DataFrame:
    found = profile(table(spark, sf, "lineitem"), CHECKS, AS_OF, only=("stock_price_distribution",))
    return found.select("metrica", F.round("valor", 8).alias("valor"))


@query(f"""
    select 'total_rows' as metrica, cast(null as varchar) as coluna, cast(count(*) as double) as valor from lineitem
    union all select 'total_columns', null, {len(_OBSERVED)}
    union all select 'missing_columns', 'l_clerk', 1
    union all select 'missing_columns', 'l_region', 1
""")
def required_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Missing required columns end the checks: only totals and the missing names are reported."""
    checks = Checks("lineitem", required=("l_orderkey", "l_clerk", "l_region"), key=("l_orderkey",))
    return profile(observed(spark, sf), checks, AS_OF).drop("tabela", "ano")


@query(f"""
    with o as ({_OBSERVED_SQL}),
    d as (select ano_referencia as ano, count(*) as n from (
            select ano_referencia from o group by ano_referencia, l_suppkey, l_orderkey, l_linenumber having count(*) > 1)
          group by all),
    t as (select ano_referencia as ano, count(*) as total,
                 count(*) filter (l_extendedprice is null or coalesce(isnan(l_extendedprice), false)) as invalid,
                 count(*) filter (l_shipdate > date '2001-01-01') as future,
                 {' + '.join(f'(case when count(*) filter ({c} is null) * 2 > count(*) then 1 else 0 end)' for c in _OBSERVED)} as high
          from o group by all)
    select 'lineitem' as tabela, ano, error_type, cast(n as bigint) as n from (
        select ano, 'duplicates' as error_type, n from d
        union all select ano, 'invalid_monetary_values', invalid from t
        union all select ano, 'future_dates_l_shipdate', future from t
        union all select ano, 'high_null_percentage', high from t) where n > 0
""")
def quality_errors(spark: SparkSession, sf: str) -> DataFrame:
    return error_totals(errors(profile(observed(spark, sf), CHECKS, AS_OF, by="ano_referencia")))


@query(f"""
    with o as ({_OBSERVED_SQL}), t as (
        select ano_referencia as ano, count(*) as total_rows,
               count(distinct l_suppkey) + max(case when l_suppkey is null then 1 else 0 end) as unique_companies,
               count(*) filter (l_extendedprice is null or coalesce(isnan(l_extendedprice), false)) as invalid_monetary_values,
               count(*) filter (l_shipdate > date '2001-01-01') as future_dates,
               {' + '.join(f'(case when count(*) filter ({c} is null) * 2 > count(*) then 1 else 0 end)' for c in _OBSERVED)} as high_null_columns
        from o group by all),
    d as (select ano, count(*) filter (n > 1) as duplicates from (
            select ano_referencia as ano, count(*) as n from o group by ano_referencia, l_suppkey, l_orderkey, l_linenumber)
          group by all)
    select ano, total_rows, unique_companies, invalid_monetary_values, duplicates, future_dates, high_null_columns
    from t join d using (ano)
""")
def quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    found = summary(profile(observed(spark, sf), CHECKS, AS_OF, by="ano_referencia"))
    return found.select("ano", "total_rows", "unique_companies", "invalid_monetary_values", "duplicates",
                        "future_dates", "high_null_columns")


# Per profiled table: its rows, key, company column, amount that may be invalid, and date that may lie ahead.
_SWEPT = {
    **{
        t: (filings.statement_sql(t), "CNPJ_CIA, CD_CONTA, DT_REFER", "CNPJ_CIA", "VL_CONTA", "DT_REFER")
        for t in ("DRE_con", "BPA_con", "BPP_con")
    },
    "DFC_DMPL_con": (
        filings.statement_sql("DFC_DMPL_con"), "CNPJ_CIA, COLUNA_DF, DT_REFER", "CNPJ_CIA", "VL_CONTA", "DT_REFER",
    ),
    "volume_valor_mobiliario": (
        filings.QUOTES_SQL, "Nome_Companhia, Especie_Acao, Data_Fim_Trimestre", "CNPJ_Companhia", "Valor_Cotacao_Media",
        "Data_Fim_Trimestre",
    ),
    "distribuicao_dividendos": (
        filings.DIVIDENDS_SQL, "Nome_Companhia, Data_Fim_Exercicio_Social", "CNPJ_Companhia", "Dividendo_Distribuido_Total",
        "Data_Fim_Exercicio_Social",
    ),
    "capital_social": (filings.CAPITAL_SQL, "", "CNPJ_Companhia", "", ""),
}
_SWEPT_YEARS = " union ".join(f"select ano_referencia as ano from ({source})" for source, *_ in _SWEPT.values())


def _sweep_sql(name: str, source: str, key: str, company_column: str, value: str, future: str) -> str:
    count = lambda condition, given: f"coalesce(count(*) filter ({condition}), 0)" if given else "cast(null as bigint)"
    invalid = "coalesce(s.invalid_values, 0)" if value else "null"
    duplicates = f"""
        (select ano, count(*) filter (n > 1) as duplicates
         from (select ano_referencia as ano, count(*) as n from ({source}) group by ano_referencia, {key}) group by all)""" if key else "(select cast(null as int) as ano, null as duplicates)"
    return f"""
    select '{name}' as tabela, y.ano, coalesce(s.total_rows, 0) as total_rows,
           coalesce(s.unique_companies, 0) as unique_companies, cast({invalid} as bigint) as invalid_values,
           cast(coalesce(s.future_dates, 0) as bigint) as future_dates,
           cast({'coalesce(k.duplicates, 0)' if key else 'null'} as bigint) as duplicates
    from ({_SWEPT_YEARS}) y
    left join (select ano_referencia as ano, count(*) as total_rows, count(distinct {company_column}) as unique_companies,
                      {count(f'{value} is null', value)} as invalid_values,
                      {count(f"{future} > date '2001-01-01'", future)} as future_dates
               from ({source}) group by all) s using (ano)
    left join {duplicates} k using (ano)"""


@query(" union all ".join(_sweep_sql(name, *described) for name, described in _SWEPT.items()))
def quality_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Every check of all profiled tables for all years of any of them, years without rows included.

    Each table is cleaned once and stored, as the silver build leaves it, and then read by both passes of its profile.
    """
    lake = Lake(scratch_dir(spark, "sweep"))
    at_once(lambda name: overwrite_table(cleaned(spark, sf, name), lake.silver(name)), PROFILED)
    tables = {name: read_table(spark, lake.silver(name)) for name in PROFILED}
    years = years_in(reduce(DataFrame.unionByName, [t.select(YEAR) for t in tables.values()]))
    found = summary(sweep(tables, years, AS_OF))
    invalid = F.coalesce("invalid_monetary_values", "invalid_dividend_values", "invalid_stock_price_values").alias("invalid_values")
    return found.select("tabela", "ano", "total_rows", "unique_companies", invalid, "future_dates", "duplicates")
