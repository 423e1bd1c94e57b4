"""A small bronze layer on disk with one row per edge case."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

ROOT = "gov_br_cvm"
DFP = "demonstracoes_financeiras_padronizadas"
FRE = "formulario_de_referencia"
FCA = "formularios_cadastrais_de_cias_abertas"

STATEMENT_HEADER = (
    "CNPJ_CIA;DT_REFER;VERSAO;DENOM_CIA;CD_CVM;GRUPO_DFP;MOEDA;ESCALA_MOEDA;ORDEM_EXERC;DT_INI_EXERC;DT_FIM_EXERC;"
    "CD_CONTA;DS_CONTA;VL_CONTA;ST_CONTA_FIXA"
)
A, B, C = "00.000.000/0001-91", "00.000.208/0001-00", "00.001.180/0001-26"


def statement(cnpj, account, label, value, unit="MIL", order="ÚLTIMO", day="2020-12-31", name="CIA – €"):
    return f"{cnpj};{day};2;{name};001023;Grupo;REAL;{unit};{order};2020-01-01;{day};{account};{label};{value};S"


DRE_2020 = [
    statement(A, "3.11", "Lucro ou Prejuízo Líquido Consolidado do Período", "13292883"),
    statement(B, "3.99.02", "Lucro Diluído por Ação", "0.0"),
    statement(C, "3.99.02", " Lucro Diluído por Ação ", "2.5", order=" último "),
    statement(A, "3.99.01", "Lucro Básico por Ação", "1.5", unit="UNIDADE"),
    statement(B, "3.99.01", "Lucro Básico por Ação", "1.25", unit=""),
    statement(B, "3.11", "Lucro/Prejuízo Consolidado do Período", "abc", day="2024-13-01"),
    statement(A, "3.11", "Lucro/Prejuízo Consolidado do Período", "5", order="PENÚLTIMO"),
    statement(A, "3.11", "Lucro/Prejuízo Consolidado do Período", "6", order="ULTIMO"),
    statement(A, "3.01", "Receita de Venda", "7"),
]
BPA_2020 = [
    statement(A, "1.01", "Ativo Circulante", "200"),
    statement(B, "1.01", "Ativo Circulante", "NA"),
    statement(A, "1.02", "Ativo Não Circulante", "9"),
]
BPP_2020 = [
    statement(A, "2.01", "Passivo Circulante", "100"),
    statement(A, "2.02", "Passivo Não Circulante", "50"),
    statement(A, "2.03", "Patrimônio Líquido Consolidado", "50"),
    statement(B, "2.01", "Passivo Circulante", "80"),
    statement(B, "2.01", "Passivo Circulante", "80"),
]
DMPL_HEADER = STATEMENT_HEADER + ";COLUNA_DF"
DMPL_2020 = [
    statement(A, "5.01", "Saldos Iniciais", "1") + ";Patrimônio Líquido",
    statement(A, "5.02", "Ajustes", "None") + ";Patrimônio Líquido Consolidado",
    statement(A, "5.01", "Saldos Iniciais", "2") + ";Capital Social",
]

QUOTES_HEADER = (
    "CNPJ_Companhia;Nome_Companhia;Valor_Mobiliario;Descricao_Outro_Valor_Mobiliario;Mercado_Valor_Mobiliario;"
    "Especie_Acao;Data_Fim_Trimestre;Valor_Cotacao_Media;Valor_Maior_Cotacao;Valor_Menor_Cotacao;Valor_Volume_Negociado"
)
QUOTES = [
    f"{A};Cia A;Ações;;Bolsa;Ordinária;2020-03-31;10.5;11;9;1000",
    f"{A};Cia A; Ações ;;Bolsa;Ordinária;2020-03-31;10.5;11;9;1000",
    f"{B};Cia B;ações;;BOLSA;Preferencial;2020-06-30;20;21;19;10",
    f"{C};Cia C;Ações;;Bolsa;Ordinária;2020-06-30;;1;1;1",
    f"{C};Cia C;Debêntures;;Bolsa;Ordinária;2020-06-30;5;1;1;1",
    f"{C};Cia C;Ações;;Balcão;Ordinária;2020-06-30;5;1;1;1",
]
DIVIDENDS_HEADER = (
    "CNPJ_Companhia;Nome_Companhia;Data_Fim_Exercicio_Social;Dividendo_Distribuido_Total;Lucro_Liquido_Ajustado"
)
DIVIDENDS = [
    f"{A};Cia A;2020-12-31;100.5;200", f"{A};Cia A;2020-12-31;100.5;200", f"{B};Cia B;2020-12-31;0;1",
    f"{C};Cia C;2020-12-31;NULL;1", "99.999.999/0001-99;Cia X;2020-12-31;7;7",
]
CAPITAL_HEADER = (
    "CNPJ_Companhia;Nome_Companhia;Tipo_Capital;Data_Referencia;Data_Autorizacao_Aprovacao;"
    "Quantidade_Acoes_Ordinarias;Quantidade_Acoes_Preferenciais;Quantidade_Total_Acoes"
)
CAPITAL = [
    f"{A};Cia A;Capital Integralizado;2020-01-01;2019-06-30;13044496930;0;13044496930",
    f"{A};Cia A;Capital Emitido;2020-01-01;2019-06-30;1;1;2",
    f"{B};Cia B;capital integralizado;2020-01-01;;x;5;5",
]
SECURITIES_HEADER = (
    "CNPJ_Companhia;Valor_Mobiliario;Sigla_Classe_Acao_Preferencial;Classe_Acao_Preferencial;Codigo_Negociacao"
)
SECURITIES = {
    2020: [f"{A};Ações Ordinárias;;;AAAA3", f"{A};Debêntures;;;X", f"{A};Ações Ordinárias;;;AAAA3"],
    2021: [f"{B};AÇÕES Preferenciais;PNA;Classe A;BBBB5"],
}
REGISTER = "\n".join([
    "CNPJ_CIA;SETOR_ATIV;DENOM_SOCIAL;DENOM_COMERC;SIT",
    f"{A};Bancos;Cia A;A – €;ATIVO", f"{A};Bancos;Cia A;A – €;CANCELADA",
    f"{B};Energia;Cia B;NA;ATIVO", f"{B};Energia;Cia B;NA;ATIVO", f"{C};Energia;Cia C;;ATIVO",
])


def csv_text(header: str, rows: list[str]) -> str:
    return "\r\n".join([header, *rows]) + "\r\n"


def write_zip(path: Path, members: dict[str, bytes]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    path.write_bytes(data.getvalue())


def snapshot(root: Path, folder: str, year: int, day: str, hour: str, stem: str) -> Path:
    return root / "bronze" / ROOT / folder / f"ano={year}" / f"data_extracao={day}" / f"hora={hour}" / f"{stem}_{year}.zip"


def dfp_members(year: int, dre: list[str], encoding: str = "cp1252", extra: dict[str, bytes] | None = None):
    def member(stem, header, rows):
        return {f"dfp_cia_aberta_{stem}_{year}.csv": csv_text(header, rows).encode(encoding)}

    return {
        f"dfp_cia_aberta_DRE_con_ind_{year}.csv": b"CNPJ_CIA\r\nwrong member\r\n",
        **member("DRE_con", STATEMENT_HEADER, dre),
        **member("BPA_con", STATEMENT_HEADER, BPA_2020),
        **member("BPP_con", STATEMENT_HEADER, BPP_2020),
        **member("DMPL_con", DMPL_HEADER, DMPL_2020),
        **(extra or {}),
    }


def write_bronze(folder: str) -> Path:
    """2020 in windows-1252 with two snapshots, 2021 in UTF-8; forms for 2020; register as a bare file."""
    root = Path(folder)
    old = {"dfp_cia_aberta_DRE_con_2020.csv": csv_text(STATEMENT_HEADER, DRE_2020[:1]).encode("cp1252")}
    write_zip(snapshot(root, DFP, 2020, "2024-01-01", "09-00-00", "dfp"), old)
    write_zip(snapshot(root, DFP, 2020, "2024-01-01", "10-00-00", "dfp"), dfp_members(2020, DRE_2020))
    write_zip(snapshot(root, DFP, 2021, "2024-01-01", "10-00-00", "dfp"), dfp_members(2021, DRE_2020[:2], "utf-8"))
    write_zip(snapshot(root, FRE, 2020, "2024-01-01", "10-00-00", "fre"), {
        "fre_cia_aberta_volume_valor_mobiliario_2020.csv": csv_text(QUOTES_HEADER, QUOTES).encode("utf-8"),
        "fre_cia_aberta_distribuicao_dividendos_2020.csv": csv_text(DIVIDENDS_HEADER, DIVIDENDS).encode("utf-8"),
        "fre_cia_aberta_capital_social_2020.csv": csv_text(CAPITAL_HEADER, CAPITAL).encode("utf-8"),
    })
    for year, rows in SECURITIES.items():
        write_zip(snapshot(root, FCA, year, "2024-01-01", "10-00-00", "fca"), {
            f"fca_cia_aberta_valor_mobiliario_{year}.csv": csv_text(SECURITIES_HEADER, rows).encode("cp1252"),
        })
    register = root / "bronze" / ROOT / "cad_cia_aberta.csv"
    register.write_bytes(REGISTER.encode("cp1252"))
    return root
