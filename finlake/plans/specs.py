"""The source tables of the filings and what cleaning and quality checks expect of them.

All names, patterns, keys and required columns in this file are fixed values of the data.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from finlake.functions.predicates import has_text, matches, same_text
from finlake.operators.clean import RowRule, TableSpec, UnitRule

# Source system, identifier and document folders of the bronze layout.
SOURCE_SYSTEM = "gov_br_cvm"
DOCUMENT_FOLDERS = {
    "DFP": "demonstracoes_financeiras_padronizadas",
    "FRE": "formulario_de_referencia",
    "FCA": "formularios_cadastrais_de_cias_abertas",
}
YEARS = (2020, 2021, 2022, 2023, 2024)

# Account labels kept per statement.
ACCOUNT_PATTERNS = {
    "DRE_con": "lucro/prejuízo consolidado do período|lucro ou prejuízo líquido consolidado do período|por ação",
    "BPA_con": "ativo circulante",
    "BPP_con": "passivo circulante|patrimônio líquido consolidado",
}
EQUITY_COLUMN_PATTERN = "patrimônio líquido"
PER_SHARE_PATTERN = "por ação"
CURRENT_EXERCISE = "ÚLTIMO"
SHARES = "Ações"
EXCHANGE = "Bolsa"
PAID_IN_CAPITAL = "Capital Integralizado"


# Columns typed wherever a filed table has them.
AMOUNTS = (
    "VL_CONTA", "Dividendo_Distribuido_Total", "Lucro_Liquido_Ajustado",
    "Valor_Cotacao_Media", "Valor_Maior_Cotacao", "Valor_Menor_Cotacao", "Valor_Volume_Negociado",
)
DATES = (
    "DT_REFER", "DT_INI_EXERC", "DT_FIM_EXERC",
    "Data_Fim_Trimestre", "Data_Fim_Exercicio_Social", "Data_Referencia", "Data_Autorizacao_Aprovacao",
)
COMPANY_IDS = (("CNPJ", "CNPJ_CIA"), ("CNPJ", "CNPJ_Companhia"))


def _equals(column: str, value: str) -> RowRule:
    return RowRule((column,), lambda: same_text(F.col(column), value), proves=(column,))


def _present(column: str) -> RowRule:
    return RowRule((column,), lambda: F.col(column).isNotNull(), proves=(column,))


def _labelled(column: str, pattern: str, needs: tuple[str, ...]) -> RowRule:
    return RowRule(
        needs, lambda: matches(F.col(column), pattern) & same_text(F.col("ORDEM_EXERC"), CURRENT_EXERCISE),
        proves=(column,),
    )


def _filed(name: str, document: str, member: str, **more) -> TableSpec:
    return TableSpec(
        name=name, document=document, member=member, doubles=AMOUNTS, dates=DATES, ids=COMPANY_IDS,
        unit=UnitRule("VL_CONTA", "ESCALA_MOEDA"), **more,
    )


def _accounts(name: str, required: tuple[str, ...]) -> TableSpec:
    return _filed(
        name, "DFP", f"dfp_cia_aberta_{name}", required=required, key=("CNPJ_CIA", "CD_CONTA", "DT_REFER"),
        rules=(_labelled("DS_CONTA", ACCOUNT_PATTERNS[name], ("DS_CONTA", "ORDEM_EXERC")),),
    )


_ALL = (
    TableSpec(
        name="cad_cia_aberta", document="CAD", member="cad_cia_aberta", ids=(("CNPJ", "CNPJ_CIA"),),
        distinct=True, trim=False, drop_empty=False,
    ),
    _accounts("DRE_con", ("CNPJ_CIA", "DENOM_CIA", "VL_CONTA", "DT_REFER", "DS_CONTA")),
    _filed(
        "DFC_DMPL_con", "DFP", "dfp_cia_aberta_DMPL_con",
        rules=(_labelled("COLUNA_DF", EQUITY_COLUMN_PATTERN, ("COLUNA_DF",)),),
        required=("CNPJ_CIA", "DENOM_CIA", "VL_CONTA", "COLUNA_DF"),
        key=("CNPJ_CIA", "COLUNA_DF", "DT_REFER"),
    ),
    _accounts("BPA_con", ("CNPJ_CIA", "DENOM_CIA", "VL_CONTA", "CD_CONTA", "DS_CONTA")),
    _accounts("BPP_con", ("CNPJ_CIA", "DENOM_CIA", "VL_CONTA", "CD_CONTA", "DS_CONTA")),
    _filed(
        "volume_valor_mobiliario", "FRE", "fre_cia_aberta_volume_valor_mobiliario", distinct=True,
        rules=(
            _equals("Valor_Mobiliario", SHARES),
            _equals("Mercado_Valor_Mobiliario", EXCHANGE),
            _present("Valor_Cotacao_Media"),
        ),
        required=("Nome_Companhia", "Especie_Acao", "Data_Fim_Trimestre", "Valor_Cotacao_Media"),
        key=("Nome_Companhia", "Especie_Acao", "Data_Fim_Trimestre"),
    ),
    _filed(
        "distribuicao_dividendos", "FRE", "fre_cia_aberta_distribuicao_dividendos", distinct=True,
        rules=(_present("Dividendo_Distribuido_Total"),),
        required=(
            "Nome_Companhia", "Data_Fim_Exercicio_Social", "Dividendo_Distribuido_Total", "Lucro_Liquido_Ajustado",
        ),
        key=("Nome_Companhia", "Data_Fim_Exercicio_Social"),
    ),
    _filed(
        "capital_social", "FRE", "fre_cia_aberta_capital_social", distinct=True,
        rules=(_equals("Tipo_Capital", PAID_IN_CAPITAL),),
        bigints=("Quantidade_Acoes_Ordinarias", "Quantidade_Acoes_Preferenciais", "Quantidade_Total_Acoes"),
        required=(
            "CNPJ_Companhia", "Nome_Companhia", "Quantidade_Acoes_Ordinarias", "Quantidade_Acoes_Preferenciais",
            "Quantidade_Total_Acoes",
        ),
    ),
    _filed(
        "cad_valor_mobiliario", "FCA", "fca_cia_aberta_valor_mobiliario", distinct=True,
        rules=(
            RowRule(
                ("Valor_Mobiliario",), lambda: has_text(F.col("Valor_Mobiliario"), SHARES), proves=("Valor_Mobiliario",)
            ),
        ),
    ),
    # Not part of the standard build; pass it by name to build the older share-count fact.
    _filed(
        "composicao_capital", "DFP", "dfp_cia_aberta_composicao_capital",
        bigints=("QT_ACAO_TOTAL_CAP_INTEGR", "QT_ACAO_TOTAL_TESOURO"), key=("CNPJ_CIA", "DT_REFER"),
    ),
)

SPECS = {spec.name: spec for spec in _ALL}
LEGACY = ("composicao_capital",)
PROFILED = (
    "DRE_con", "BPA_con", "BPP_con", "DFC_DMPL_con",
    "volume_valor_mobiliario", "distribuicao_dividendos", "capital_social",
)


def tables_of(document: str) -> tuple[str, ...]:
    """Standard tables of one document type."""
    names = tuple(s.name for s in _ALL if s.document == document and s.name not in LEGACY)
    if not names:
        raise ValueError(f"unknown document type {document!r}; expected one of CAD, DFP, FRE, FCA")
    return names


def per_share_unscaled(spec: TableSpec) -> TableSpec:
    """The same table with per-share figures left out of the unit scaling."""
    label = RowRule(("DS_CONTA",), lambda: matches(F.col("DS_CONTA"), PER_SHARE_PATTERN))
    return replace(spec, unit=replace(spec.unit, except_when=label.keep))
