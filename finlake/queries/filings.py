"""Raw filings derived from the given tables, with the defects real filings have.

Every expression is valid in Spark and in the checking engine, so both sides start from the same raw text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from finlake.queries.registry import table

_LINE_DAY = "cast(cast(l_shipdate as date) as string)"
_ORDER_DAY = "cast(cast(o_orderdate as date) as string)"


def _company(key: str, prefix: str = "'00.'") -> str:
    return f"concat({prefix}, lpad(cast({key} as string), 6, '0'), '/0001-91')"


_STATEMENTS = {
    "CNPJ_CIA": _company("l_suppkey"),
    "DENOM_CIA": "concat('  Cia ', cast(l_suppkey as string), ' ')",
    "DT_REFER": f"case when l_linenumber = 4 and l_returnflag = 'N' then '2024-13-01' else {_LINE_DAY} end",
    "DT_INI_EXERC": f"concat(substr({_LINE_DAY}, 1, 4), '-01-01')",
    "DT_FIM_EXERC": _LINE_DAY,
    "ORDEM_EXERC": "case l_returnflag when 'A' then 'ÚLTIMO' when 'N' then ' último ' else 'PENÚLTIMO' end",
    "ESCALA_MOEDA": "case when l_linestatus = 'O' then 'MIL' when l_linenumber = 2 then 'NA' else 'UNIDADE' end",
    "CD_CONTA": "case l_linenumber when 1 then '1.01' when 2 then '2.01' when 3 then '2.02' when 4 then '2.03' "
                "when 5 then '3.11' when 6 then '3.99.02' else '3.99' end",
    "DS_CONTA": "case l_linenumber when 1 then 'Ativo Circulante' when 2 then ' Passivo Circulante' "
                "when 3 then 'Passivo Não Circulante' when 4 then 'Patrimônio Líquido Consolidado' "
                "when 5 then 'Lucro/Prejuízo Consolidado do Período' when 6 then 'Lucro Diluído por Ação' "
                "else 'Receita de Venda' end",
    "COLUNA_DF": "case when l_tax > 0.04 then 'Patrimônio Líquido' "
                 "when l_tax > 0.02 then 'PATRIMÔNIO LÍQUIDO Consolidado' else 'Capital Social' end",
    "VL_CONTA": "case when l_quantity = 1 then 'abc' when l_quantity = 2 then 'nan' "
                "else cast(l_extendedprice as string) end",
    "ano_referencia": "cast(year(l_shipdate) as int)",
}

_QUOTES = {
    "CNPJ_Companhia": _company("l_suppkey", "case when l_linenumber = 7 then '99.' else '00.' end"),
    "Nome_Companhia": "concat('Cia ', cast(l_suppkey as string))",
    "Valor_Mobiliario": "case l_returnflag when 'A' then 'Ações' when 'N' then ' AÇÕES ' else 'Debêntures' end",
    "Descricao_Outro_Valor_Mobiliario": "''",
    "Mercado_Valor_Mobiliario": "case when l_linestatus = 'O' then 'Bolsa' when l_linenumber < 4 then 'BOLSA' "
                                "else 'Balcão' end",
    "Especie_Acao": "case when l_tax > 0.04 then 'Ordinária' else 'Preferencial' end",
    "Data_Fim_Trimestre": _LINE_DAY,
    "Valor_Cotacao_Media": "case when l_quantity = 1 then ' ' when l_quantity = 2 then 'x' "
                           "else cast(l_extendedprice as string) end",
    "Valor_Maior_Cotacao": "cast(l_extendedprice * 2 as string)",
    "Valor_Menor_Cotacao": "cast(l_extendedprice / 2 as string)",
    "Valor_Volume_Negociado": "cast(l_quantity as string)",
    "ano_referencia": "cast(year(l_shipdate) as int)",
}

_DIVIDENDS = {
    "CNPJ_Companhia": _company("o_custkey"),
    "Nome_Companhia": "concat('Cia ', cast(o_custkey as string))",
    "Data_Fim_Exercicio_Social": _ORDER_DAY,
    "Dividendo_Distribuido_Total": "case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'NULL' "
                                   "else cast(o_totalprice as string) end",
    "Lucro_Liquido_Ajustado": "cast(o_totalprice * 2 as string)",
    "ano_referencia": "cast(year(o_orderdate) as int)",
}

_CAPITAL = {
    "CNPJ_Companhia": _company("p_size"),
    "Nome_Companhia": "concat('Cia ', cast(p_size as string))",
    "Tipo_Capital": "case when p_type in ('ECONOMY', 'SMALL') then 'Capital Integralizado' "
                    "when p_type = 'PROMO' then ' capital integralizado ' else 'Capital Emitido' end",
    "Quantidade_Acoes_Ordinarias": "concat(cast(p_partkey as string), '0000000')",
    "Quantidade_Acoes_Preferenciais": "case when p_brand = 'Brand#2' then 'abc' else cast(p_size as string) end",
    "Quantidade_Total_Acoes": "concat(cast(p_partkey + p_size as string), '0000000')",
    "Data_Referencia": "concat('20', lpad(cast(p_size as string), 2, '0'), '-01-31')",
    "Data_Autorizacao_Aprovacao": "case when p_brand = 'Brand#3' then '' else '2020-06-30' end",
    "ano_referencia": "cast(2000 + p_size as int)",
}

_SECURITIES = {
    "CNPJ_Companhia": _company("p_size"),
    "Valor_Mobiliario": "case when p_type in ('ECONOMY', 'LARGE') then 'Ações Ordinárias' "
                        "when p_type in ('SMALL', 'PROMO') then 'AÇÕES Preferenciais' else 'Debêntures' end",
    "Sigla_Classe_Acao_Preferencial": "case when p_type = 'SMALL' then 'PNA' when p_type = 'PROMO' then 'PNB' "
                                      "else '' end",
    "Classe_Acao_Preferencial": "case when p_type = 'SMALL' then ' Classe A' else 'None' end",
    "Codigo_Negociacao": "p_brand",
    "ano_referencia": "cast(2000 + p_size as int)",
}

_SHARES = {
    "CNPJ_CIA": _company("o_custkey"),
    "DT_REFER": _ORDER_DAY,
    "QT_ACAO_TOTAL_CAP_INTEGR": "concat(cast(o_orderkey as string), '00000')",
    "QT_ACAO_TOTAL_TESOURO": "case when o_orderstatus = 'P' then '' else cast(o_custkey as string) end",
    "ano_referencia": "cast(year(o_orderdate) as int)",
}


def _register(status: str) -> dict[str, str]:
    return {
        "CNPJ_CIA": _company("s_suppkey"),
        "SETOR_ATIV": "concat('Setor ', cast(s_nationkey as string))",
        "DENOM_SOCIAL": "s_name",
        "DENOM_COMERC": "case when s_nationkey < 5 then 'NA' else concat(' ', s_name) end",
        "SIT": status,
    }


# Raw table: the projections it is the union of, as (source, condition, columns). Re-filed copies included.
RAW: dict[str, list[tuple[str, str, dict[str, str]]]] = {
    "statements": [("lineitem", "true", _STATEMENTS)],
    "quotes": [("lineitem", "true", _QUOTES), ("lineitem", "l_linenumber = 1", _QUOTES)],
    "dividends": [("orders", "true", _DIVIDENDS), ("orders", "o_orderstatus = 'O'", _DIVIDENDS)],
    "capital": [("part", "true", _CAPITAL), ("part", "p_type = 'PROMO'", _CAPITAL)],
    "securities": [("part", "true", _SECURITIES)],
    "shares": [("orders", "true", _SHARES)],
    "register": [
        ("supplier", "true", _register("'ATIVO'")),
        ("supplier", "s_acctbal > 5000", _register("'ATIVO'")),
        ("supplier", "s_acctbal < 2000", _register("'CANCELADA'")),
    ],
}


def raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A raw filing table as text columns plus its reference year."""
    parts = [
        table(spark, sf, source).where(condition).selectExpr(*[f"{e} as {c}" for c, e in columns.items()])
        for source, condition, columns in RAW[name]
    ]
    return reduce(DataFrame.unionByName, parts)


def raw_sql(name: str) -> str:
    """The same raw table for the checking engine."""
    parts = [
        "select " + ", ".join(f"{e} as {c}" for c, e in columns.items()) + f" from {source} where {condition}"
        for source, condition, columns in RAW[name]
    ]
    return " union all ".join(parts)


# The cleaned tables, written independently in SQL ---------------------------------------------------------------

BARE_ID = "replace(replace(replace({0}, '.', ''), '-', ''), '/', '')"
_CURRENT = "trim(ORDEM_EXERC) ilike 'ÚLTIMO'"
_INCOME = "lucro/prejuízo consolidado do período|lucro ou prejuízo líquido consolidado do período|por ação"
STATEMENT_FILTERS = {
    "DRE_con": f"regexp_matches(lower(DS_CONTA), '{_INCOME}') and {_CURRENT}",
    "BPA_con": f"regexp_matches(lower(DS_CONTA), 'ativo circulante') and {_CURRENT}",
    "BPP_con": "regexp_matches(lower(DS_CONTA), 'passivo circulante|patrimônio líquido consolidado') "
               f"and {_CURRENT}",
    "DFC_DMPL_con": f"regexp_matches(lower(COLUNA_DF), 'patrimônio líquido') and {_CURRENT}",
}


def statement_sql(name: str, scale_when: str = "ESCALA_MOEDA like '%MIL%'") -> str:
    return f"""
    select CNPJ_CIA, trim(DENOM_CIA) as DENOM_CIA, try_cast(DT_REFER as date) as DT_REFER,
           cast(DT_INI_EXERC as date) as DT_INI_EXERC, cast(DT_FIM_EXERC as date) as DT_FIM_EXERC,
           trim(ORDEM_EXERC) as ORDEM_EXERC, nullif(ESCALA_MOEDA, 'NA') as ESCALA_MOEDA, CD_CONTA,
           trim(DS_CONTA) as DS_CONTA, COLUNA_DF,
           try_cast(nullif(VL_CONTA, 'nan') as double) * case when {scale_when} then 1000 else 1 end as VL_CONTA,
           ano_referencia, {BARE_ID.format('CNPJ_CIA')} as CNPJ
    from ({raw_sql('statements')}) where {STATEMENT_FILTERS[name]}"""


QUOTES_SQL = f"""
    select distinct CNPJ_Companhia, Nome_Companhia, trim(Valor_Mobiliario) as Valor_Mobiliario,
           nullif(Descricao_Outro_Valor_Mobiliario, '') as Descricao_Outro_Valor_Mobiliario, Mercado_Valor_Mobiliario,
           Especie_Acao, cast(Data_Fim_Trimestre as date) as Data_Fim_Trimestre,
           try_cast(Valor_Cotacao_Media as double) as Valor_Cotacao_Media,
           cast(Valor_Maior_Cotacao as double) as Valor_Maior_Cotacao,
           cast(Valor_Menor_Cotacao as double) as Valor_Menor_Cotacao,
           cast(Valor_Volume_Negociado as double) as Valor_Volume_Negociado,
           ano_referencia, {BARE_ID.format('CNPJ_Companhia')} as CNPJ
    from ({raw_sql('quotes')})
    where trim(Valor_Mobiliario) ilike 'ações' and Mercado_Valor_Mobiliario ilike 'bolsa' and trim(Valor_Cotacao_Media) <> ''"""

DIVIDENDS_SQL = f"""
    select distinct CNPJ_Companhia, Nome_Companhia, cast(Data_Fim_Exercicio_Social as date) as Data_Fim_Exercicio_Social,
           cast(Dividendo_Distribuido_Total as double) as Dividendo_Distribuido_Total,
           cast(Lucro_Liquido_Ajustado as double) as Lucro_Liquido_Ajustado,
           ano_referencia, {BARE_ID.format('CNPJ_Companhia')} as CNPJ
    from ({raw_sql('dividends')}) where Dividendo_Distribuido_Total <> 'NULL'"""

CAPITAL_SQL = f"""
    select distinct CNPJ_Companhia, Nome_Companhia, trim(Tipo_Capital) as Tipo_Capital,
           cast(Quantidade_Acoes_Ordinarias as bigint) as Quantidade_Acoes_Ordinarias,
           try_cast(Quantidade_Acoes_Preferenciais as bigint) as Quantidade_Acoes_Preferenciais,
           cast(Quantidade_Total_Acoes as bigint) as Quantidade_Total_Acoes,
           cast(Data_Referencia as date) as Data_Referencia,
           try_cast(nullif(Data_Autorizacao_Aprovacao, '') as date) as Data_Autorizacao_Aprovacao,
           ano_referencia, {BARE_ID.format('CNPJ_Companhia')} as CNPJ
    from ({raw_sql('capital')}) where trim(Tipo_Capital) ilike 'capital integralizado'"""

SECURITIES_SQL = f"""
    select distinct CNPJ_Companhia, Valor_Mobiliario,
           nullif(Sigla_Classe_Acao_Preferencial, '') as Sigla_Classe_Acao_Preferencial,
           nullif(trim(Classe_Acao_Preferencial), 'None') as Classe_Acao_Preferencial, Codigo_Negociacao,
           ano_referencia, {BARE_ID.format('CNPJ_Companhia')} as CNPJ
    from ({raw_sql('securities')}) where Valor_Mobiliario ilike '%ações%'"""

SHARES_SQL = f"""
    select CNPJ_CIA, cast(DT_REFER as date) as DT_REFER,
           cast(QT_ACAO_TOTAL_CAP_INTEGR as bigint) as QT_ACAO_TOTAL_CAP_INTEGR,
           try_cast(nullif(QT_ACAO_TOTAL_TESOURO, '') as bigint) as QT_ACAO_TOTAL_TESOURO,
           ano_referencia, {BARE_ID.format('CNPJ_CIA')} as CNPJ
    from ({raw_sql('shares')})"""

REGISTER_SQL = f"""
    select distinct CNPJ_CIA, SETOR_ATIV, DENOM_SOCIAL, nullif(DENOM_COMERC, 'NA') as DENOM_COMERC, SIT,
           {BARE_ID.format('CNPJ_CIA')} as CNPJ
    from ({raw_sql('register')})"""
