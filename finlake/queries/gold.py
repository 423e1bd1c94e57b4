"""Dimensions and facts built from the cleaned filings, and the reports they exist for."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.dates import calendar_attributes
from finlake.lake import Lake
from finlake.operators.clean import clean
from finlake.operators.rows import newest, one_row_per_key
from finlake.operators.star import build_dimension, build_fact, renamed
from finlake.plans.builds import build_gold
from finlake.plans.specs import SPECS
from finlake.plans.star import COMPANY, FACTS, SECURITY, STANDARD_FACTS
from finlake.queries import filings
from finlake.queries.filings import raw
from finlake.queries.registry import query, table
from finlake.session import at_once, scratch_dir, unsorted_writes
from finlake.sinks.tables import YEAR, overwrite_table, replace_years, years_in
from finlake.sources.archives import LANDING_FILES
from finlake.sources.tables import calendar_between, read_table

_RAW_OF = {
    "DRE_con": "statements", "BPA_con": "statements", "BPP_con": "statements", "DFC_DMPL_con": "statements",
    "volume_valor_mobiliario": "quotes", "distribuicao_dividendos": "dividends", "capital_social": "capital",
    "cad_valor_mobiliario": "securities", "composicao_capital": "shares", "cad_cia_aberta": "register",
}


def cleaned(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return clean(raw(spark, sf, _RAW_OF[name]), SPECS[name])


def company(spark: SparkSession, sf: str, unique: bool = False) -> DataFrame:
    return build_dimension(cleaned(spark, sf, "cad_cia_aberta"), COMPANY, unique)


def fact(spark: SparkSession, sf: str, name: str, fan_out: bool = True) -> DataFrame:
    """A fact as the gold build makes it: the company dimension is stored first, so its row count is known."""
    described = FACTS[name]
    tables = {t: cleaned(spark, sf, t) for t in described.sources}
    if not described.company:
        return build_fact(tables, described)
    path = scratch_dir(spark, "companies")
    company_rows = overwrite_table(company(spark, sf), path)
    return build_fact(tables, described, read_table(spark, path), company_rows, fan_out=fan_out)


@lru_cache
def _company_sql() -> str:
    return f"""
    select distinct CNPJ as cnpj, SETOR_ATIV as setor, DENOM_SOCIAL as denom_social, DENOM_COMERC as denom_comercial,
           SIT as situacao from ({filings.REGISTER_SQL})"""


@query(f"select *, 'cad_cia_aberta' as tipo_demonstracao from ({_company_sql()})")
def dim_company(spark: SparkSession, sf: str) -> DataFrame:
    return company(spark, sf)


@query(f"""
    select * exclude (rn), 'cad_cia_aberta' as tipo_demonstracao from (
        select *, row_number() over (
            partition by cnpj order by setor desc nulls last, denom_social desc nulls last,
            denom_comercial desc nulls last, situacao desc nulls last) as rn
        from ({_company_sql()})) where rn = 1
""")
def dim_company_one_row(spark: SparkSession, sf: str) -> DataFrame:
    return company(spark, sf, unique=True)


@query("""
    select c_nationkey, c_custkey, c_mktsegment from customer
    qualify row_number() over (partition by c_nationkey order by c_custkey desc, c_mktsegment desc) = 1
""")
def one_customer_per_nation(spark: SparkSession, sf: str) -> DataFrame:
    return one_row_per_key(table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_mktsegment"), ["c_nationkey"])


@query(f"""
    select distinct CNPJ as cnpj, Valor_Mobiliario as especie_acao, Sigla_Classe_Acao_Preferencial as sigla_classe_acao,
           Classe_Acao_Preferencial as classe_acao, Codigo_Negociacao as codigo_negociacao, ano_referencia
    from ({filings.SECURITIES_SQL})
""")
def dim_security(spark: SparkSession, sf: str) -> DataFrame:
    return build_dimension(cleaned(spark, sf, "cad_valor_mobiliario"), SECURITY)


_CALENDAR_COLUMNS = """
    cast(year({d}) as int) as ano, cast(month({d}) as int) as mes, cast(quarter({d}) as int) as trimestre,
    cast(case when month({d}) <= 6 then 1 else 2 end as int) as semestre, cast(day({d}) as int) as dia,
    concat(year({d}), '-Q', quarter({d})) as ano_trimestre, strftime({d}, '%Y-%m') as ano_mes,
    (month({d}) % 3 = 0 and {d} = last_day({d})) as eh_fim_trimestre,
    (month({d}) = 12 and day({d}) = 31) as eh_fim_ano"""


@query(f"""
    with shipped as (select cast(l_shipdate as date) as data, count(*) as n from lineitem group by 1),
    days as (select cast(unnest(generate_series(
        (select min(data)::timestamp from shipped), (select max(data)::timestamp from shipped), interval 1 day
    )) as date) as data)
    select data, {_CALENDAR_COLUMNS.format(d='data')}, coalesce(n, 0) as embarques
    from days left join shipped using (data)
""")
def dim_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Every day between the first and last shipment, with how many there were."""
    shipped = table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("data")).agg(
        F.count(F.lit(1)).alias("n")
    )
    days = calendar_between(shipped.agg(F.min("data").alias("first"), F.max("data").alias("last")), "first", "last")
    return days.join(shipped, "data", "left").withColumn("embarques", F.coalesce("n", F.lit(0))).drop("n")


@query(f"""
    select o_orderkey, {_CALENDAR_COLUMNS.format(d='cast(o_orderdate as date)')} from orders
""")
def calendar_columns(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in calendar_attributes(day).items()])


_ACCOUNT_SQL = "CNPJ as cnpj, CD_CONTA as cd_conta, DS_CONTA as ds_conta, DT_REFER as data_referencia, VL_CONTA as valor"
_DEPTH_SQL = "cast(len(string_split(CD_CONTA, '.')) as int) as nivel"
_BALANCE_SQL = f"""
    select {_ACCOUNT_SQL}, {_DEPTH_SQL}, 'BPA' as tipo_balanco, ano_referencia
    from ({filings.statement_sql('BPA_con')}) where VL_CONTA is not null
    union all
    select {_ACCOUNT_SQL}, {_DEPTH_SQL}, 'BPP' as tipo_balanco, ano_referencia
    from ({filings.statement_sql('BPP_con')}) where VL_CONTA is not null"""


@query(_BALANCE_SQL)
def fact_balance(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf, "FATO_BALANCO")


@query(f"""
    select {_ACCOUNT_SQL}, DT_INI_EXERC as data_inicio_exercicio, DT_FIM_EXERC as data_fim_exercicio, ano_referencia,
           {_DEPTH_SQL}
    from ({filings.statement_sql('DRE_con')}) where VL_CONTA is not null
""")
def fact_income(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf, "FATO_DRE")


@query(f"""
    select {_ACCOUNT_SQL}, COLUNA_DF as coluna_df, ano_referencia from ({filings.statement_sql('DFC_DMPL_con')})
""")
def fact_equity(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf, "FATO_DMPL")


_QUOTE_COLUMNS = """cnpj, Especie_Acao as especie_acao, Data_Fim_Trimestre as data_referencia,
    Valor_Cotacao_Media as valor_cotacao_media, Valor_Maior_Cotacao as valor_maior_cotacao,
    Valor_Menor_Cotacao as valor_menor_cotacao, Valor_Volume_Negociado as volume_negociado, ano_referencia"""


@query(f"""
    select {_QUOTE_COLUMNS.replace('cnpj', 'd.cnpj', 1)} from ({filings.QUOTES_SQL}) q
    join ({_company_sql()}) d on q.CNPJ = d.cnpj where Valor_Cotacao_Media is not null
""")
def fact_quotes(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf, "FATO_COTACAO")


@query(f"""
    select {_QUOTE_COLUMNS.replace('cnpj', 'CNPJ as cnpj', 1)} from ({filings.QUOTES_SQL}) q
    where Valor_Cotacao_Media is not null and CNPJ in (select cnpj from ({_company_sql()}))
""")
def fact_quotes_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Each quote once, however often its company is registered."""
    return fact(spark, sf, "FATO_COTACAO", fan_out=False)


@query(f"""
    select d.cnpj, Data_Fim_Exercicio_Social as data_exercicio_social, Dividendo_Distribuido_Total as dividendo_total,
           Lucro_Liquido_Ajustado as lucro_liquido_ajustado, 'Dividendo' as tipo_provento, ano_referencia
    from ({filings.DIVIDENDS_SQL}) v join ({_company_sql()}) d on v.CNPJ = d.cnpj
""")
def fact_dividends(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf, "FATO_DIVIDENDOS")


@query(f"""
    select CNPJ as cnpj, Data_Referencia as data_referencia, Data_Autorizacao_Aprovacao as data_autorizacao_aprovacao,
           Quantidade_Acoes_Preferenciais as qt_acao_preferencial, Quantidade_Acoes_Ordinarias as qt_acao_ordinaria,
           Quantidade_Total_Acoes as qt_acao_total, ano_referencia
    from ({filings.CAPITAL_SQL})
""")
def fact_capital(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf, "FATO_CAPITAL_SOCIAL")


@query(f"""
    select CNPJ as cnpj, DT_REFER as data_referencia, QT_ACAO_TOTAL_CAP_INTEGR as qt_acao_capital_integralizado,
           coalesce(QT_ACAO_TOTAL_TESOURO, 0) as qt_acao_tesouraria, ano_referencia,
           QT_ACAO_TOTAL_CAP_INTEGR - coalesce(QT_ACAO_TOTAL_TESOURO, 0) as qt_acao_circulacao
    from ({filings.SHARES_SQL})
""")
def shares_outstanding(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf, "FATO_COMPOSICAO_CAPITAL")


@query("""
    select o_orderkey as pedido, o_custkey as cliente, o_totalprice as valor, 'orders' as origem,
           cast(year(o_orderdate) as int) as ano_referencia
    from orders
""")
def rename_project(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").withColumn("ano_referencia", F.year("o_orderdate"))
    names = {"pedido": "o_orderkey", "cliente": "o_custkey", "valor": "o_totalprice", "ano_referencia": "ano_referencia"}
    return renamed(rows, names, {"origem": "orders"})


@query("""
    select user_id, event_type, event_id, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
""")
def newest_event(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return newest(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(f"""
    with b as ({_BALANCE_SQL}),
    t as (select cnpj, ano_referencia, sum(case when ds_conta ilike 'ativo circulante' then valor end) as ativo,
                 sum(case when ds_conta ilike 'passivo circulante' then valor end) as passivo
          from b group by all)
    select cnpj, ano_referencia, round(ativo, 2) as ativo_circulante, round(passivo, 2) as passivo_circulante,
           round(ativo / nullif(passivo, 0), 6) as liquidez_corrente
    from t
""")
def current_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Current assets over current liabilities per company and year, from raw statements to the answer."""
    balance = fact(spark, sf, "FATO_BALANCO")

    def total(label: str):
        return F.sum(F.when(F.lower("ds_conta") == label, F.col("valor")))

    sums = balance.groupBy("cnpj", "ano_referencia").agg(
        total("ativo circulante").alias("ativo"), total("passivo circulante").alias("passivo")
    )
    return sums.select(
        "cnpj", "ano_referencia", F.round("ativo", 2).alias("ativo_circulante"),
        F.round("passivo", 2).alias("passivo_circulante"),
        F.round(F.try_divide("ativo", "passivo"), 6).alias("liquidez_corrente"),
    )


@query(f"""
    select concat(year(Data_Fim_Exercicio_Social), '-Q', quarter(Data_Fim_Exercicio_Social)) as ano_trimestre,
           SETOR_ATIV as setor, round(sum(Dividendo_Distribuido_Total), 2) as dividendos, count(*) as pagamentos
    from ({filings.DIVIDENDS_SQL}) v
    join (select CNPJ, max(SETOR_ATIV) as SETOR_ATIV from ({filings.REGISTER_SQL}) group by CNPJ) d using (CNPJ)
    group by all
""")
def dividends_by_quarter(spark: SparkSession, sf: str) -> DataFrame:
    """Dividends per sector and quarter, the quarter taken from the payment's date as the calendar dimension has it."""
    paid = fact(spark, sf, "FATO_DIVIDENDOS", fan_out=False)
    sectors = company(spark, sf, unique=True).select("cnpj", "setor")
    quarter = calendar_attributes(F.col("data_exercicio_social"))["ano_trimestre"]
    per_quarter = paid.groupBy("cnpj", quarter.alias("ano_trimestre")).agg(
        F.sum("dividendo_total").alias("valor"), F.count(F.lit(1)).alias("n")
    )
    return per_quarter.join(sectors, "cnpj").groupBy("ano_trimestre", "setor").agg(
        F.round(F.sum("valor"), 2).alias("dividendos"), F.sum("n").alias("pagamentos")
    )


def _count_sql(name: str, value: str, sql: str) -> str:
    return f"""
    select '{name}' as tabela, ano_referencia as ano, count(*) as linhas,
           cast(sum(cast(round({value} * 100) as bigint)) as bigint) as centavos
    from ({sql}) group by all"""


# Per fact: the amount that is summed, under its source's name and its own, and the rows in SQL.
_FACT_SQL = {
    "FATO_DMPL": ("VL_CONTA", "valor", filings.statement_sql("DFC_DMPL_con")),
    "FATO_BALANCO": ("valor", "valor", _BALANCE_SQL),
    "FATO_DRE": ("VL_CONTA", "valor", f"select * from ({filings.statement_sql('DRE_con')}) where VL_CONTA is not null"),
    "FATO_COTACAO": (
        "Valor_Cotacao_Media", "valor_cotacao_media",
        f"""select q.* from ({filings.QUOTES_SQL}) q join ({_company_sql()}) d on q.CNPJ = d.cnpj
            where Valor_Cotacao_Media is not null""",
    ),
    "FATO_DIVIDENDOS": (
        "Dividendo_Distribuido_Total", "dividendo_total",
        f"select v.* from ({filings.DIVIDENDS_SQL}) v join ({_company_sql()}) d on v.CNPJ = d.cnpj",
    ),
    "FATO_CAPITAL_SOCIAL": ("Quantidade_Total_Acoes", "qt_acao_total", filings.CAPITAL_SQL),
}


@query(f"""
    {' union all '.join(_count_sql(n, value, q) for n, (value, _, q) in _FACT_SQL.items())}
    union all select 'DIM_EMPRESA', null, count(*), null from ({_company_sql()})
    union all select 'DIM_TIPO_ACAO', null, count(*), null from (select distinct * from ({filings.SECURITIES_SQL}))
""")
def gold_build(spark: SparkSession, sf: str) -> DataFrame:
    """The whole star schema built and stored from stored cleaned tables; rows and amounts per table and year read back."""
    lake = Lake(scratch_dir(spark, "gold"))
    sources = dict.fromkeys([SECURITY.source, *[t for f in STANDARD_FACTS for t in FACTS[f].sources]])
    kinds = list(dict.fromkeys(_RAW_OF[name] for name in sources))
    of_kind = dict(zip(kinds, at_once(lambda kind: years_in(raw(spark, sf, kind)), kinds)))
    years = {year for found in of_kind.values() for year in found}

    def store(name: str) -> None:
        if name == COMPANY.source:
            overwrite_table(cleaned(spark, sf, name), lake.silver(name))
        else:  # only a table whose copies were removed comes out of an exchange
            replace_years(cleaned(spark, sf, name), lake.silver(name), of_kind[_RAW_OF[name]], rebalance=SPECS[name].distinct)

    with unsorted_writes(spark, LANDING_FILES):
        at_once(store, [*sources, COMPANY.source])
    failed = [o for o in build_gold(spark, lake, years) if not o.ok]
    if failed:
        raise RuntimeError(f"{failed[0].table} {failed[0].year}: {failed[0].error}")
    cents = lambda c: F.sum(F.round(F.col(c) * 100).cast("bigint"))
    counted = [
        read_table(spark, lake.fact(n)).groupBy(F.col(YEAR).alias("ano"))
        .agg(F.count(F.lit(1)).alias("linhas"), cents(value).alias("centavos"))
        .select(F.lit(n).alias("tabela"), "ano", "linhas", "centavos")
        for n, (_, value, _) in _FACT_SQL.items()
    ]
    counted += [
        read_table(spark, lake.dimension(n)).agg(F.count(F.lit(1)).alias("linhas"))
        .select(F.lit(n).alias("tabela"), F.lit(None).cast("int").alias("ano"), "linhas", F.lit(None).cast("bigint").alias("centavos"))
        for n in (COMPANY.name, SECURITY.name)
    ]
    return reduce(DataFrame.unionByName, counted)
