import math
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finlake.operators.clean import RowRule, TableSpec, clean, cleaned_schema, keep_rows, with_lineage
from finlake.plans.specs import SPECS, per_share_unscaled, tables_of
from tests import bronze_fixture as fx


def frame(spark, header, rows):
    names = header.split(";")
    return spark.createDataFrame([tuple(r.split(";")) for r in rows], ", ".join(f"{n} string" for n in names))


def test_income_statement(spark):
    rows = clean(frame(spark, fx.STATEMENT_HEADER, fx.DRE_2020), SPECS["DRE_con"]).collect()
    found = {(r["CNPJ"], r["CD_CONTA"]): r for r in rows}
    assert len(rows) == 6
    assert found["00000000000191", "3.11"]["VL_CONTA"] == 13292883000.0
    assert found["00000208000100", "3.99.02"]["VL_CONTA"] == 0.0
    assert found["00001180000126", "3.99.02"]["VL_CONTA"] == 2500.0
    assert found["00001180000126", "3.99.02"]["DS_CONTA"] == "Lucro Diluído por Ação"
    assert found["00000000000191", "3.99.01"]["VL_CONTA"] == 1.5
    assert found["00000208000100", "3.99.01"]["VL_CONTA"] == 1.25
    assert found["00000208000100", "3.99.01"]["ESCALA_MOEDA"] is None
    bad = found["00000208000100", "3.11"]
    assert bad["VL_CONTA"] is None and bad["DT_REFER"] is None
    assert found["00000000000191", "3.11"]["DT_FIM_EXERC"] == date(2020, 12, 31)


def test_per_share_figures_can_stay_unscaled(spark):
    rows = clean(frame(spark, fx.STATEMENT_HEADER, fx.DRE_2020), per_share_unscaled(SPECS["DRE_con"]))
    values = {(r["CNPJ"], r["CD_CONTA"]): r["VL_CONTA"] for r in rows.collect()}
    assert values["00001180000126", "3.99.02"] == 2.5
    assert values["00000000000191", "3.11"] == 13292883000.0


def test_liabilities_leave_out_non_current(spark):
    rows = clean(frame(spark, fx.STATEMENT_HEADER, fx.BPP_2020), SPECS["BPP_con"]).collect()
    assert sorted(r["CD_CONTA"] for r in rows) == ["2.01", "2.01", "2.01", "2.03"]


def test_quotes_are_trimmed_before_filter_and_dedupe(spark):
    rows = clean(frame(spark, fx.QUOTES_HEADER, fx.QUOTES), SPECS["volume_valor_mobiliario"]).collect()
    assert sorted((r["Nome_Companhia"], r["Valor_Cotacao_Media"]) for r in rows) == [("Cia A", 10.5), ("Cia B", 20.0)]
    assert rows[0]["Descricao_Outro_Valor_Mobiliario"] is None


def test_share_capital_keeps_big_counts(spark):
    rows = clean(frame(spark, fx.CAPITAL_HEADER, fx.CAPITAL), SPECS["capital_social"])
    assert dict(rows.dtypes)["Quantidade_Total_Acoes"] == "bigint"
    found = {r["Nome_Companhia"]: r for r in rows.collect()}
    assert set(found) == {"Cia A", "Cia B"}
    assert found["Cia A"]["Quantidade_Total_Acoes"] == 13044496930
    assert found["Cia B"]["Quantidade_Acoes_Ordinarias"] is None


def test_rules_for_absent_columns_are_skipped(spark):
    df = frame(spark, "Nome_Companhia;Valor_Mobiliario", ["Cia A;Ações", "Cia B;Debêntures"])
    rows = clean(df, SPECS["volume_valor_mobiliario"])
    assert rows.columns == ["Nome_Companhia", "Valor_Mobiliario"]
    assert [r["Nome_Companhia"] for r in rows.collect()] == ["Cia A"]


def test_share_counts_are_typed_one_by_one(spark):
    df = frame(spark, "Tipo_Capital;Quantidade_Total_Acoes", ["Capital Integralizado;5"])
    assert dict(clean(df, SPECS["capital_social"]).dtypes)["Quantidade_Total_Acoes"] == "bigint"


def test_rows_without_any_value_are_dropped(spark):
    df = frame(spark, "a;b", ["NA; ", "x;", "NULL;nan"])
    assert [tuple(r) for r in clean(df, TableSpec("t", "DFP", "t")).collect()] == [("x", None)]


def test_the_year_does_not_keep_an_empty_row(spark):
    df = spark.createDataFrame([(None, "x", 2020), ("7", None, 2020), ("a", "1", 2020)], "a string, v string, ano_referencia int")
    rows = clean(df, TableSpec("t", "DFP", "t", doubles=("v",)))
    assert sorted(tuple(r) for r in rows.collect()) == [("7", None, 2020), ("a", 1.0, 2020)]


def test_dividends_without_a_readable_value_are_dropped(spark):
    df = frame(spark, fx.DIVIDENDS_HEADER, ["NA;;;abc;", f"{fx.A};;;abc;"])
    assert [r["CNPJ"] for r in clean(df, SPECS["distribuicao_dividendos"]).collect()] == ["00000000000191"]


@pytest.mark.parametrize("name", [n for n, s in SPECS.items() if s.rules])
def test_rules_prove_what_they_say(spark, name):
    spec = SPECS[name]
    columns = sorted({c for r in spec.rules for c in r.needs} | ({"ORDEM_EXERC"} if spec.document == "DFP" else set()))
    values = [None, "ÚLTIMO", "Ações", "Bolsa", "Capital Integralizado", "por ação", "ativo circulante", "1",
              "passivo circulante", "patrimônio líquido"]
    df = spark.range(1).select(*[F.explode(F.array(*map(F.lit, values))).alias(c) for c in columns[:1]])
    for c in columns[1:]:
        df = df.withColumn(c, F.explode(F.array(*map(F.lit, values))))
    kept = keep_rows(df, spec.rules)
    assert kept.count() > 0
    for rule in spec.rules:
        assert rule.proves
        for c in rule.proves:
            assert kept.where(F.col(c).isNull()).count() == 0


def test_dropna_counts_nan_as_no_value(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r["v"] for r in df.dropna(how="all").collect()] == [1.0]


def test_register_is_not_trimmed(spark):
    df = frame(spark, "CNPJ_CIA;SIT", [f"{fx.A}; ATIVO", f"{fx.A}; ATIVO", f"{fx.A};ATIVO", f"{fx.A}; NA"])
    rows = clean(df, SPECS["cad_cia_aberta"]).collect()
    assert sorted(r["SIT"] for r in rows) == [" ATIVO", " NA", "ATIVO"]


def test_extra_columns_survive(spark):
    df = frame(spark, "CNPJ_CIA;NOVA", [f"{fx.A};v"])
    assert clean(df, SPECS["composicao_capital"]).first()["NOVA"] == "v"


def test_lineage_is_one_timestamp(spark):
    df = with_lineage(spark.range(3).toDF("x"), SPECS["DRE_con"], "2024-01-01 00:00:00", 2020)
    assert df.select("data_processamento").distinct().count() == 1
    assert df.schema["ano_referencia"].dataType.simpleString() == "int"


@pytest.mark.parametrize("header, rows, name", [
    (fx.STATEMENT_HEADER, fx.DRE_2020, "DRE_con"), (fx.QUOTES_HEADER, fx.QUOTES, "volume_valor_mobiliario"),
    (fx.DIVIDENDS_HEADER, fx.DIVIDENDS, "distribuicao_dividendos"), (fx.CAPITAL_HEADER, fx.CAPITAL, "capital_social"),
    (fx.SECURITIES_HEADER, fx.SECURITIES[2020], "cad_valor_mobiliario"),
])
def test_declared_schema_is_what_cleaning_gives(spark, header, rows, name):
    df = clean(frame(spark, header, rows), SPECS[name])
    declared = cleaned_schema(SPECS[name], df.columns)
    assert {f.name: f.dataType for f in declared if f.name in df.columns} == {f.name: f.dataType for f in df.schema}


def test_unknown_document():
    with pytest.raises(ValueError):
        tables_of("XYZ")


def test_keep_rows_is_a_conjunction(spark):
    rules = [RowRule(("id",), lambda: F.col("id") > 2), RowRule(("id",), lambda: F.col("id") < 5)]
    assert [r["id"] for r in keep_rows(spark.range(10), rules).collect()] == [3, 4]


cell = st.one_of(st.sampled_from([" NA", "x ", "1.5", "1e3", "2020-01-31", "ÚLTIMO", "Ação", "", "nan"]), st.text(max_size=5))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(cell, cell, cell), min_size=1, max_size=20))
def test_cleaning_twice_changes_nothing(spark, rows):
    spec = TableSpec("t", "DFP", "t", doubles=("v",), dates=("d",), ids=(("i", "s"),), distinct=True)
    df = spark.createDataFrame(rows, "s string, v string, d string")

    def text(frame):
        return frame.select([F.col(c).cast("string") for c in ("s", "v", "d")])

    def plain(r):
        return tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in r)

    once = clean(df, spec)
    twice = clean(text(once), spec)
    assert sorted(map(repr, map(plain, once.collect()))) == sorted(map(repr, map(plain, twice.collect())))
