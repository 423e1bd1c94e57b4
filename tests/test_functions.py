from datetime import date

import pytest
from pyspark.sql import functions as F

from finlake.functions import dates, numbers, predicates, text
from finlake.sources.tables import calendar


def one(spark, expr, **row):
    fields = ", ".join(f"{k} {t}" for k, (t, _) in row.items()) or "x int"
    values = tuple(v for _, v in row.values()) or (1,)
    return spark.createDataFrame([values], fields).select(expr.alias("r")).first()["r"]


def test_strip_id(spark):
    assert one(spark, text.strip_id(F.col("c")), c=("string", "12.345.678/0001-90")) == "12345678000190"


def test_fold_text_keeps_letters_outside_the_pairs(spark):
    assert one(spark, text.fold_text(F.col("c")), c=("string", "AÇÃO Último ñ")) == "acao ultimo ñ"


@pytest.mark.parametrize("token", text.NULL_TOKENS)
def test_null_tokens(spark, token):
    assert one(spark, text.null_if_token("c"), c=("string", token)) is None


@pytest.mark.parametrize("token", ["it's", "back\\\\slash", "\\n", "%"])
def test_null_tokens_are_taken_literally(spark, token):
    assert one(spark, text.null_if_token("c", (token,)), c=("string", token)) is None
    assert one(spark, text.null_if_token("c", (token,)), c=("string", token + "x")) == token + "x"


def test_tidy_strings_trims_spaces_only(spark):
    df = spark.createDataFrame([(" a ", "\tb", " NA ", 1)], "`x.y` string, t string, n string, i int")
    assert tuple(text.tidy_strings(df).first()) == ("a", "\tb", None, 1)


@pytest.mark.parametrize("value, depth", [("1", 1), ("3.99.02", 3), (None, None)])
def test_account_level(spark, value, depth):
    assert one(spark, text.account_level(F.col("c")), c=("string", value)) == depth


@pytest.mark.parametrize("value, number", [("1.5", 1.5), ("abc", None), ("1,5", None), (None, None)])
def test_to_double(spark, value, number):
    assert one(spark, numbers.to_double(F.col("c")), c=("string", value)) == number


def test_to_bigint_keeps_more_than_32_bits(spark):
    assert one(spark, numbers.to_bigint(F.col("c")), c=("string", "13044496930")) == 13044496930


@pytest.mark.parametrize("unit, value", [("MIL", 2000.0), ("UNIDADE", 2.0), (None, 2.0)])
def test_scale_units(spark, unit, value):
    expr = numbers.scale_units(F.col("v"), F.col("u"))
    assert one(spark, expr, v=("double", 2.0), u=("string", unit)) == value


def test_percentage_of_nothing_is_zero(spark):
    assert one(spark, numbers.percentage(F.lit(0), F.lit(0))) == 0.0


@pytest.mark.parametrize("value, day", [("2024-02-29", date(2024, 2, 29)), ("2024-13-01", None), ("31/12/2020", None)])
def test_parse_date(spark, value, day):
    assert one(spark, dates.parse_date(F.col("c")), c=("string", value)) == day


@pytest.mark.parametrize("value, same", [("ÚLTIMO", True), ("último", True), ("PENÚLTIMO", False), ("ULTIMO", False)])
def test_same_text_keeps_accents(spark, value, same):
    assert one(spark, predicates.same_text(F.col("c"), "ÚLTIMO"), c=("string", value)) is same


def test_passivo_nao_circulante_is_not_passivo_circulante(spark):
    expr = predicates.matches(F.col("c"), "passivo circulante")
    assert one(spark, expr, c=("string", "Passivo Circulante")) is True
    assert one(spark, expr, c=("string", "Passivo Não Circulante")) is False


def test_same_text_takes_wildcards_literally(spark):
    assert one(spark, predicates.same_text(F.col("c"), "a%"), c=("string", "abc")) is False


def test_calendar(spark):
    days = calendar(spark)
    assert days.count() == 4383
    assert days.where("eh_fim_trimestre").count() == 48
    assert days.where("eh_fim_ano").count() == 12
    row = days.where("data = date'2020-03-31'").first()
    assert (row["ano_trimestre"], row["ano_mes"], row["semestre"], row["eh_fim_trimestre"]) == ("2020-Q1", "2020-03", 1, True)


def test_dates_are_read_as_strictly_as_the_format(spark):
    texts = [
        "2024-02-29", "2023-02-29", "2024-13-01", "2024-00-10", "2024-1-05", "2024-01-5", "2024-01-5 ", "2024-01-5\t",
        "2024-01-05T", "2024-01-05 00:00:00", "2024", "2024-01", "+024-01-01", "\t024-01-01", "20240105", "2024/01/05",
        "0001-01-01", "9999-12-31", "abcd-ef-gh", "", None, "2024-01-0x", "2024-01-05\n", "２024-01-01", "12024-01-01",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = df.select("t", dates.parse_date(F.col("t")).alias("fast"), F.try_to_date("t", "yyyy-MM-dd").alias("strict"))
    assert [(r["t"], r["fast"]) for r in both.collect()] == [(r["t"], r["strict"]) for r in both.collect()]
    assert one(spark, dates.parse_date(F.col("c"), "dd/MM/yyyy"), c=("string", "31/12/2020")) == date(2020, 12, 31)
