from datetime import date

import pytest
from pyspark.sql import functions as F

from finlake.operators.quality import Checks, error_totals, errors, profile, summary
from finlake.plans.builds import checks_for, sweep
from finlake.plans.specs import PROFILED, SPECS

AS_OF = date(2024, 1, 1)
COLUMNS = "CNPJ_CIA string, DENOM_CIA string, CD_CONTA string, DS_CONTA string, DT_REFER date, VL_CONTA double, ano_referencia int"


def rows(spark, *data):
    return spark.createDataFrame(list(data), COLUMNS)


@pytest.fixture(scope="module")
def balance(spark):
    return rows(
        spark,
        ("a", "A", "1", "x", date(2020, 1, 1), 10.0, 2020),
        ("a", "A", "1", "x", date(2020, 1, 1), None, 2020),
        (None, None, "2", "x", date(2030, 1, 1), float("nan"), 2020),
        (None, None, "2", None, None, 2.0, 2020),
        ("b", None, "1", None, date(2021, 1, 1), 5.0, 2021),
    )


def metrics(df):
    return {(r["ano"], r["metrica"], r["coluna"]): r["valor"] for r in df.collect()}


def test_one_year_profile(spark, balance):
    got = metrics(profile(balance.where("ano_referencia = 2020"), checks_for(SPECS["BPA_con"]), AS_OF, year=2020))
    assert got[2020, "total_rows", None] == 4 and got[2020, "total_columns", None] == 7
    assert got[2020, "unique_companies", "CNPJ_CIA"] == 2  # a missing id counts as one company
    assert got[2020, "null_percentages", "CNPJ_CIA"] == 50.0
    assert (2020, "high_null_columns", "CNPJ_CIA") not in got  # exactly half is not high
    assert got[2020, "invalid_monetary_values", "VL_CONTA"] == 2 and got[2020, "invalid_monetary_pct", "VL_CONTA"] == 50
    assert got[2020, "future_dates", "DT_REFER"] == 1  # NULL dates do not count
    assert got[2020, "duplicates", None] == 1  # NULL dates differ from 2030 here; the pair ("a", "1") repeats
    assert got[2020, "value_distribution.count", "VL_CONTA"] == 3
    assert got[2020, "value_distribution.total", "VL_CONTA"] != got[2020, "value_distribution.total", "VL_CONTA"]


def test_null_keys_group_together(spark):
    df = rows(spark, *[(None, "A", "1", "x", None, 1.0, 2020)] * 3)
    assert metrics(profile(df, checks_for(SPECS["BPA_con"]), AS_OF))[None, "duplicates", None] == 1


def test_all_years_in_one_go_match_year_by_year(spark, balance):
    checks = checks_for(SPECS["BPA_con"])
    together = metrics(profile(balance, checks, AS_OF, by="ano_referencia"))
    apart = {}
    for year in (2020, 2021):
        apart |= metrics(profile(balance.where(F.col("ano_referencia") == year), checks, AS_OF, year=year))
    assert {k: repr(v) for k, v in together.items()} == {k: repr(v) for k, v in apart.items()}


def test_years_without_rows(spark, balance):
    got = metrics(profile(balance, checks_for(SPECS["BPA_con"]), AS_OF, by="ano_referencia", years=[2020, 2021, 2022]))
    assert got[2022, "total_rows", None] == 0 and got[2022, "total_columns", None] == 7
    assert got[2022, "null_percentage", "VL_CONTA"] == 0 and got[2022, "duplicates", None] == 0
    assert got[2022, "unique_companies", "CNPJ_CIA"] == 0


def test_empty_frame(spark, balance):
    got = metrics(profile(balance.where("false"), checks_for(SPECS["BPA_con"]), AS_OF, year=1999))
    assert got[1999, "total_rows", None] == 0 and got[1999, "null_percentages", "CNPJ_CIA"] == 0
    assert got[1999, "value_distribution.total", "VL_CONTA"] == 0


def test_missing_columns_stop_the_checks(spark, balance):
    found = profile(balance.drop("DS_CONTA", "DENOM_CIA"), checks_for(SPECS["BPA_con"]), AS_OF, year=2020)
    got = metrics(found)
    assert set(k[1] for k in got) == {"total_rows", "total_columns", "missing_columns"}
    counted = {r["error_type"]: r["n"] for r in errors(found).collect()}
    assert counted == {"missing_columns": 2}


def test_tables_without_required_columns_skip_duplicates(spark, balance):
    got = metrics(profile(balance, checks_for(SPECS["cad_valor_mobiliario"]), AS_OF))
    assert (None, "duplicates", None) not in got and (None, "unique_companies", "CNPJ_CIA") in got
    assert checks_for(SPECS["capital_social"]).key == ()
    assert checks_for(SPECS["composicao_capital"]).key == ()


def test_errors_and_summary(spark, balance):
    found = profile(balance, checks_for(SPECS["BPA_con"]), AS_OF, by="ano_referencia")
    counted = {(r["ano"], r["error_type"]): r["n"] for r in errors(found).collect()}
    assert counted == {
        (2020, "invalid_monetary_values"): 2, (2020, "future_dates_DT_REFER"): 1, (2020, "duplicates"): 1,
        (2021, "high_null_percentage"): 2,
    }
    doubled = errors(found).unionByName(errors(found))
    assert {(r["ano"], r["error_type"]): r["n"] for r in error_totals(doubled).collect()} == {
        k: 2 * n for k, n in counted.items()
    }
    head = summary(found).where("ano = 2021").first()
    assert (head["total_rows"], head["future_dates"], head["high_null_columns"], head["duplicates"]) == (1, 0, 2, 0)


def test_only_runs_what_is_asked(spark, balance):
    checks = checks_for(SPECS["BPA_con"])
    got = metrics(profile(balance, checks, AS_OF, only=("future_dates",)))
    assert list(got) == [(None, "future_dates", "DT_REFER")]
    assert "partial_count" in profile(balance, checks, AS_OF)._jdf.queryExecution().executedPlan().toString()
    plan = profile(balance, checks, AS_OF, only=("future_dates",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_sweep_covers_every_profiled_table(spark, balance):
    assert len(PROFILED) * 5 == 35
    tables = {n: balance for n in ("BPA_con", "BPP_con")}
    found = summary(sweep(tables, [2020, 2021], AS_OF)).collect()
    assert sorted((r["tabela"], r["ano"]) for r in found) == [(t, y) for t in tables for y in (2020, 2021)]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(None, 1.0)], "`a|b.c` string, v double")
    got = metrics(profile(df, Checks("t"), AS_OF))
    assert got[None, "null_percentage", "a|b.c"] == 100
