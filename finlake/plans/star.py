"""The star schema of the filings. Names and mappings in this file are fixed values of the data."""

from __future__ import annotations

from finlake.operators.star import Dimension, Fact

COMPANY = Dimension(
    "DIM_EMPRESA", "cad_cia_aberta",
    {"cnpj": "CNPJ", "setor": "SETOR_ATIV", "denom_social": "DENOM_SOCIAL", "denom_comercial": "DENOM_COMERC",
     "situacao": "SIT"},
    tags={"tipo_demonstracao": "cad_cia_aberta"}, key="cnpj",
)
CALENDAR_NAME = "DIM_TEMPO"
SECURITY = Dimension(
    "DIM_TIPO_ACAO", "cad_valor_mobiliario",
    {"cnpj": "CNPJ", "especie_acao": "Valor_Mobiliario", "sigla_classe_acao": "Sigla_Classe_Acao_Preferencial",
     "classe_acao": "Classe_Acao_Preferencial", "codigo_negociacao": "Codigo_Negociacao",
     "ano_referencia": "ano_referencia"},
)

_ACCOUNT = {"cnpj": "CNPJ", "cd_conta": "CD_CONTA", "ds_conta": "DS_CONTA", "data_referencia": "DT_REFER",
            "valor": "VL_CONTA"}

FACTS = {
    f.name: f
    for f in (
        Fact("FATO_DMPL", {"DFC_DMPL_con": {}}, {**_ACCOUNT, "coluna_df": "COLUNA_DF"}),
        Fact(
            "FATO_BALANCO", {"BPA_con": {"tipo_balanco": "BPA"}, "BPP_con": {"tipo_balanco": "BPP"}}, _ACCOUNT,
            present="valor", level_of="cd_conta",
        ),
        Fact(
            "FATO_DRE", {"DRE_con": {}},
            {**_ACCOUNT, "data_inicio_exercicio": "DT_INI_EXERC", "data_fim_exercicio": "DT_FIM_EXERC"},
            present="valor", level_of="cd_conta",
        ),
        Fact(
            "FATO_COTACAO", {"volume_valor_mobiliario": {}},
            {"cnpj": "CNPJ", "especie_acao": "Especie_Acao", "data_referencia": "Data_Fim_Trimestre",
             "valor_cotacao_media": "Valor_Cotacao_Media", "valor_maior_cotacao": "Valor_Maior_Cotacao",
             "valor_menor_cotacao": "Valor_Menor_Cotacao", "volume_negociado": "Valor_Volume_Negociado"},
            present="valor_cotacao_media", company="cnpj",
        ),
        Fact(
            "FATO_DIVIDENDOS", {"distribuicao_dividendos": {}},
            {"cnpj": "CNPJ", "data_exercicio_social": "Data_Fim_Exercicio_Social",
             "dividendo_total": "Dividendo_Distribuido_Total", "lucro_liquido_ajustado": "Lucro_Liquido_Ajustado"},
            tags={"tipo_provento": "Dividendo"}, company="cnpj",
        ),
        Fact(
            "FATO_CAPITAL_SOCIAL", {"capital_social": {}},
            {"cnpj": "CNPJ", "data_referencia": "Data_Referencia",
             "data_autorizacao_aprovacao": "Data_Autorizacao_Aprovacao",
             "qt_acao_preferencial": "Quantidade_Acoes_Preferenciais",
             "qt_acao_ordinaria": "Quantidade_Acoes_Ordinarias", "qt_acao_total": "Quantidade_Total_Acoes"},
        ),
        Fact(
            "FATO_COMPOSICAO_CAPITAL", {"composicao_capital": {}},
            {"cnpj": "CNPJ", "data_referencia": "DT_REFER",
             "qt_acao_capital_integralizado": "QT_ACAO_TOTAL_CAP_INTEGR",
             "qt_acao_tesouraria": "QT_ACAO_TOTAL_TESOURO"},
            default_zero=("qt_acao_tesouraria",),
            difference=("qt_acao_circulacao", "qt_acao_capital_integralizado", "qt_acao_tesouraria"),
        ),
    )
}
STANDARD_FACTS = tuple(n for n in FACTS if n != "FATO_COMPOSICAO_CAPITAL")
