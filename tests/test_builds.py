import os
import threading
from datetime import date, datetime
from pathlib import Path

import pytest

from finlake.__main__ import main
from finlake.lake import Lake
from finlake.plans import builds
from finlake.session import at_once
from finlake.sources.archives import column_names, landed_status, read_archives, unpack
from finlake.sources.bronze import ingestion_records, latest_path, list_objects, manifest_summary, read_manifest
from finlake.sources.tables import file_encodings, read_csv, read_table
from tests import bronze_fixture as fx

RUN = datetime(2024, 6, 1, 12)


def build_all(spark, folder):
    lake = Lake(str(fx.write_bronze(folder)))
    outcomes = []
    for document in ("CAD", "DFP", "FRE", "FCA"):
        outcomes += builds.build_silver(spark, lake, document, [2020, 2021], run_ts=RUN)
    return lake, outcomes


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    return build_all(spark, str(tmp_path_factory.mktemp("lake")))


def test_silver_outcomes(built):
    ok = builds.results(built[1])
    assert ok["cad_cia_aberta"] == {None: True}
    for name in ("DRE_con", "BPA_con", "BPP_con", "DFC_DMPL_con", "cad_valor_mobiliario"):
        assert ok[name] == {2020: True, 2021: True}, name
    for name in ("volume_valor_mobiliario", "distribuicao_dividendos", "capital_social"):
        assert ok[name] == {2020: True, 2021: False}, name


def test_processing_seconds(spark, built):
    rows = builds.processing_seconds(spark, built[0]).where("step = 'silver'").collect()
    good = {o.table for o in built[1] if o.ok}
    assert {r["tabela"] for r in rows} == good and {r["n"] for r in rows} == {1}
    assert all(r["soma"] <= r["ate"] for r in rows)


def test_newest_snapshot_wins_and_text_is_decoded(spark, built):
    rows = read_table(spark, built[0].silver("DRE_con")).collect()
    assert sorted(r["ano_referencia"] for r in rows) == [2020] * 6 + [2021] * 2
    assert {r["DENOM_CIA"] for r in rows} == {"CIA – €"}
    assert {r["data_processamento"] for r in rows} == {RUN}
    assert {r["document_type"] for r in rows} == {"DFP"}
    assert {type(r["ano_referencia"]) for r in rows} == {int}


def test_register(spark, built):
    rows = read_table(spark, built[0].silver("cad_cia_aberta")).collect()
    assert len(rows) == 4
    assert {r["DENOM_COMERC"] for r in rows} == {"A – €", None}


def test_gold(spark, built):
    lake = built[0]
    outcomes = builds.build_gold(spark, lake, [2020, 2021], run_ts=RUN)
    assert all(o.ok for o in outcomes), [o for o in outcomes if not o.ok]
    rows = {(o.table, o.year): o.rows for o in outcomes}
    assert rows["DIM_EMPRESA", None] == 4 and rows["DIM_TEMPO", None] == 4383
    assert rows["DIM_TIPO_ACAO", None] == 2
    securities = read_table(spark, lake.dimension("DIM_TIPO_ACAO")).collect()
    assert {(r["ano_referencia"], r["codigo_negociacao"]) for r in securities} == {(2020, "AAAA3"), (2021, "BBBB5")}
    # BPA has one amount per year, BPP four; the other asset row has no amount.
    assert rows["FATO_BALANCO", 2020] == 5 and rows["FATO_BALANCO", 2021] == 5
    assert rows["FATO_DRE", 2020] == 5 and rows["FATO_DRE", 2021] == 2
    assert rows["FATO_DMPL", 2020] == 2
    # Company A is registered twice, so its quote and its dividend count twice.
    assert rows["FATO_COTACAO", 2020] == 3 and rows["FATO_COTACAO", 2021] == 0
    assert rows["FATO_DIVIDENDOS", 2020] == 3
    assert rows["FATO_CAPITAL_SOCIAL", 2020] == 2
    balance = read_table(spark, lake.fact("FATO_BALANCO"), 2020).collect()
    assert {(r["tipo_balanco"], r["cd_conta"], r["nivel"]) for r in balance} == {
        ("BPA", "1.01", 2), ("BPP", "2.01", 2), ("BPP", "2.03", 2)
    }
    dmpl = read_table(spark, lake.fact("FATO_DMPL"), 2020).collect()
    assert sorted((r["valor"] is None) for r in dmpl) == [False, True]
    assert set(dmpl[0].asDict()) == {
        "cnpj", "coluna_df", "cd_conta", "ds_conta", "data_referencia", "valor", "ano_referencia"
    }


def test_gold_with_unique_companies(spark, folder):
    lake, _ = build_all(spark, folder)
    rows = {(o.table, o.year): o.rows for o in builds.build_gold(spark, lake, [2020], unique_companies=True)}
    assert rows["DIM_EMPRESA", None] == 3
    assert rows["FATO_COTACAO", 2020] == 2 and rows["FATO_DIVIDENDOS", 2020] == 2


def test_a_missing_source_table_fails_only_its_fact(spark, folder):
    lake = Lake(str(fx.write_bronze(folder)))
    builds.build_silver(spark, lake, "CAD")
    builds.build_silver(spark, lake, "FCA", [2020])
    builds.build_silver(spark, lake, "DFP", [2020], tables=["DRE_con"])
    ok = builds.results(builds.build_gold(spark, lake, [2020], facts=["FATO_DRE", "FATO_BALANCO"]))
    assert ok["FATO_DRE"] == {2020: True} and ok["FATO_BALANCO"] == {2020: False}


def test_empty_year_is_cleared_on_rebuild(spark, folder):
    lake, _ = build_all(spark, folder)
    late = fx.snapshot(Path(folder), fx.DFP, 2020, "2024-02-01", "00-00-00", "dfp")
    fx.write_zip(late, fx.dfp_members(2020, fx.DRE_2020[-1:]))
    outcomes = builds.build_silver(spark, lake, "DFP", [2020], tables=["DRE_con"])
    assert [(o.ok, o.rows) for o in outcomes] == [(True, 0)]
    assert [r["ano_referencia"] for r in read_table(spark, lake.silver("DRE_con")).collect()] == [2021, 2021]


def test_new_column_in_a_later_year(spark, folder):
    lake = Lake(str(fx.write_bronze(folder)))
    extra = fx.csv_text(fx.STATEMENT_HEADER + ";NOVA", [fx.DRE_2020[0] + ";x"]).encode("utf-8")
    path = fx.snapshot(Path(folder), fx.DFP, 2021, "2024-03-01", "00-00-00", "dfp")
    fx.write_zip(path, {"dfp_cia_aberta_DRE_con_2021.csv": extra})
    outcomes = builds.build_silver(spark, lake, "DFP", [2020, 2021], tables=["DRE_con"])
    assert [o.ok for o in outcomes] == [True, True]
    rows = read_table(spark, lake.silver("DRE_con"), merge_schema=True).collect()
    assert sorted((r["ano_referencia"], r["NOVA"]) for r in rows if r["ano_referencia"] == 2021) == [(2021, "x")]
    assert {r["NOVA"] for r in rows if r["ano_referencia"] == 2020} == {None}


def test_broken_inputs_fail_their_year_only(spark, folder):
    root = fx.write_bronze(folder)
    long_row = fx.csv_text(fx.STATEMENT_HEADER, [fx.DRE_2020[0] + ";one;too;many"]).encode("utf-8")
    fx.write_zip(fx.snapshot(root, fx.DFP, 2022, "2024-01-01", "00-00-00", "dfp"), {"dfp_cia_aberta_DRE_con_2022.csv": long_row})
    garbage = fx.snapshot(root, fx.DFP, 2023, "2024-01-01", "00-00-00", "dfp")
    garbage.parent.mkdir(parents=True)
    garbage.write_bytes(b"not an archive")
    outcomes = builds.build_silver(spark, Lake(str(root)), "DFP", [2020, 2022, 2023], tables=["DRE_con", "BPA_con"])
    by = {(o.table, o.year): o for o in outcomes}
    assert by["DRE_con", 2020].ok and by["BPA_con", 2020].ok
    assert "fields for 15 columns" in by["DRE_con", 2022].error
    assert by["BPA_con", 2022].error == "not found"
    assert "unreadable archive" in by["DRE_con", 2023].error and "unreadable archive" in by["BPA_con", 2023].error


def test_no_archives_at_all(spark, folder):
    ok = builds.results(builds.build_silver(spark, Lake(folder), "FRE", [2020]))
    assert ok == {t: {2020: False} for t in ("volume_valor_mobiliario", "distribuicao_dividendos", "capital_social")}


def test_unknown_document_type(spark, folder):
    with pytest.raises(ValueError):
        builds.build_silver(spark, Lake(folder), "XXX", [2020])


def test_members_with_quotes_breaks_and_short_rows(spark, folder):
    path = fx.snapshot(Path(folder), fx.DFP, 2020, "2024-01-01", "00-00-00", "dfp")
    text = 'A;B\r\n"x;1\r\ny";"say ""hi"""\r\n\r\nshort\r\n'
    fx.write_zip(path, {"sub/stem_2020.csv": text.encode("utf-8-sig"), "stem_extra_2020.csv": b"A;B\r\nno;no\r\n"})
    landed = unpack(read_archives(spark, "DFP", [str(path)]), {"DFP": {"T": "stem"}})
    status = landed_status(landed).first()
    assert status["colunas"] == ["A", "B"] and status["defeito"] is None
    rows = sorted((r["campos"] for r in landed.where("linha > 0").collect()), key=len)
    assert rows == [["short"], ["x;1\r\ny", 'say "hi"']]


def test_latest_snapshot(spark, folder):
    fx.write_bronze(folder)
    rows = {r["ano"]: r["path"] for r in latest_path(list_objects(spark, f"{folder}/bronze", ".zip"), "ano").collect()}
    assert set(rows) == {2020, 2021}
    objects = list_objects(spark, f"{folder}/bronze/{fx.ROOT}/{fx.DFP}", ".zip")
    assert "hora=10-00-00" in latest_path(objects, "ano").where("ano = 2020").first()["path"]
    assert "content" not in objects.columns


def test_encodings(spark, folder):
    Path(folder, "a.csv").write_bytes("n;v\nAÇÃO – €;1\n".encode("cp1252"))
    Path(folder, "b é 1.csv").write_bytes("n;v\nAÇÃO – €;2\n".encode("utf-8"))
    paths = [f"{folder}/a.csv", f"{folder}/b é 1.csv"]
    assert sorted(r["is_utf8"] for r in file_encodings(spark, paths).collect()) == [False, True]
    assert sorted(tuple(r) for r in read_csv(spark, paths).collect()) == [("AÇÃO – €", "1"), ("AÇÃO – €", "2")]


def test_quoted_line_break_needs_multi_line(spark, folder):
    Path(folder, "a.csv").write_text('n;v\n"a\nb";"q""q"\n')
    assert [tuple(r) for r in read_csv(spark, f"{folder}/a.csv", multi_line=True).collect()] == [("a\nb", 'q"q')]


def test_manifest(spark, folder):
    record = """{"fonte": "x", "tipo_ativo": "y", "identificador": {"tipo": "ano", "valor": "2020"},
      "requisicao": {"status_code": 200, "headers": {"User-Agent": "u"}, "tempo_resposta_ms": 1.5},
      "dados": {"tamanho_bytes": 5000000000, "ano_referencia": 2020}, "versao_ingestor": "3"}"""
    deep = Path(folder, "ano=2020", "hora=10-00-00")
    deep.mkdir(parents=True)
    (deep / "metadata.json").write_text(record)
    row = read_manifest(spark, folder).first()
    assert row["dados"]["tamanho_bytes"] == 5000000000 and row["requisicao"]["headers"]["User-Agent"] == "u"


def test_manifest_of_listed_objects(spark, folder):
    root = fx.write_bronze(folder)
    objects = list_objects(spark, f"{root}/bronze", ".zip")
    ingestion_records(objects, fx.ROOT).write.json(f"{folder}/manifest")
    records = read_manifest(spark, f"{folder}/manifest", multi_line=False)
    row = records.where(f"tipo_ativo = '{fx.DFP}' and dados.ano_referencia = 2021").first()
    assert row["extracao"]["timestamp_utc"] == "2024-01-01T10:00:00"
    size = fx.snapshot(root, fx.DFP, 2021, "2024-01-01", "10-00-00", "dfp").stat().st_size
    assert row["dados"]["tamanho_bytes"] == size
    totals = {r["tipo_ativo"]: r["objetos"] for r in manifest_summary(records).collect()}
    assert totals == {fx.DFP: 3, fx.FRE: 1, fx.FCA: 2}


def test_repeated_and_blank_headers():
    assert column_names(["A", "", "A", "A", "B"]) == ("A", "_c1", "A.1", "A.2", "B")


def test_repeated_headers_build(spark, folder):
    path = fx.snapshot(Path(folder), fx.DFP, 2020, "2024-01-01", "00-00-00", "dfp")
    header = fx.STATEMENT_HEADER + ";VERSAO;"
    fx.write_zip(path, {"dfp_cia_aberta_DRE_con_2020.csv": fx.csv_text(header, [fx.DRE_2020[0] + ";9;z"]).encode()})
    lake = Lake(folder)
    assert [o.error for o in builds.build_silver(spark, lake, "DFP", [2020], tables=["DRE_con"])] == [None]
    row = read_table(spark, lake.silver("DRE_con")).first()
    assert (row["VERSAO"], row["VERSAO.1"], row["_c16"]) == ("2", "9", "z")


def test_validate_gives_a_dictionary(spark, folder):
    lake = Lake(str(fx.write_bronze(folder)))
    builds.build_silver(spark, lake, "DFP", [2020], tables=["DRE_con"])
    df = read_table(spark, lake.silver("DRE_con"), 2020)
    found = builds.validate(df, "DRE_con", 2020, date(2020, 6, 30))
    assert (found["csv_key"], found["ano"], found["total_rows"], found["total_columns"]) == ("DRE_con", 2020, 6, 19)
    checks = found["validations"]
    assert checks["missing_columns"] == [] and checks["unique_companies"] == 3 and checks["duplicates"] == 0
    assert checks["invalid_monetary_values"] == 1 and checks["invalid_monetary_pct"] == 16.67
    assert checks["future_dates_DT_REFER"] == 5 and checks["null_percentages"]["ESCALA_MOEDA"] == 16.67
    assert checks["value_distribution"]["count"] == 5 and checks["value_distribution"]["max"] == 13292883000.0
    short = builds.validate(df.drop("DS_CONTA"), "DRE_con", 2020)
    assert short["validations"] == {"missing_columns": ["DS_CONTA"]} and short["total_rows"] == 6


def test_quality_run_and_logs(spark, folder):
    lake, _ = build_all(spark, folder)
    outcomes = builds.run_quality(
        spark, lake, [2020, 2021, 2022], ["DRE_con", "BPP_con", "distribuicao_dividendos"], date(2020, 6, 30), RUN
    )
    rows = {(o.table, o.year): o.rows for o in outcomes}
    assert rows["DRE_con", 2020] == 6 and rows["DRE_con", 2022] == 0
    errors = {
        (r["tabela"], r["ano"], r["error_type"]): r["n"] for r in spark.read.parquet(lake.log("errors")).collect()
    }
    assert errors["BPP_con", 2020, "duplicates"] == 1
    assert errors["DRE_con", 2020, "invalid_monetary_values"] == 1
    assert errors["DRE_con", 2020, "future_dates_DT_REFER"] == 5
    head = builds.quality_summary(spark, lake, RUN).where("tabela = 'DRE_con' and ano = 2020").first()
    assert (head["total_rows"], head["unique_companies"], head["future_dates"]) == (6, 3, 5)
    log = spark.read.parquet(lake.log("runs"))
    assert log.where("step = 'quality' and ok").count() == 9
    assert log.where("step = 'silver' and ok and segundos > 0").count() > 0


def test_exports(spark, folder):
    lake, _ = build_all(spark, folder)
    builds.build_gold(spark, lake, [2020, 2021])
    out = f"{folder}/out"
    builds.export_silver(spark, lake, f"{out}/csv", single_file=True)
    builds.export_gold(spark, lake, f"{out}/gold")
    files = [f for f in os.listdir(f"{out}/csv/DRE_con") if f.endswith(".csv")]
    assert len(files) == 1
    assert Path(f"{out}/csv/DRE_con", files[0]).read_text().startswith("CNPJ_CIA,")
    assert spark.read.option("header", "true").csv(f"{out}/csv/DRE_con").count() == 8
    assert spark.read.parquet(f"{out}/gold/FATO_DRE.parquet").count() == 7


def test_command_line(spark, folder, capsys):
    fx.write_bronze(folder)
    assert main(["silver", "--root", folder, "--years", "2020", "--documents", "CAD", "DFP", "FRE", "FCA"]) == 0
    assert main(["gold", "--root", folder, "--years", "2020", "--unique-companies"]) == 0
    assert main(["quality", "--root", folder, "--years", "2020"]) == 0
    assert main(["export-gold", "--root", folder, "--target", f"{folder}/out"]) == 0
    assert "gold FATO_BALANCO 2020: ok 5" in capsys.readouterr().out


# Broken inputs must not lose or change data -------------------------------------------------------------------


def rename_stored(spark, path, column):
    rows = spark.read.parquet(path)
    kept = rows.withColumnRenamed(column, f"{column}_X").collect()
    schema = rows.withColumnRenamed(column, f"{column}_X").schema
    spark.createDataFrame(kept, schema).write.mode("overwrite").parquet(path)


def test_a_renamed_column_fails_its_fact_and_leaves_the_stored_year(spark, folder):
    lake, _ = build_all(spark, folder)
    assert all(o.ok for o in builds.build_gold(spark, lake, [2020, 2021], facts=["FATO_DRE"]))
    before = read_table(spark, lake.fact("FATO_DRE")).count()
    rename_stored(spark, f"{lake.silver('DRE_con')}/ano_referencia=2021", "VL_CONTA")
    outcomes = [o for o in builds.build_gold(spark, lake, [2020, 2021], facts=["FATO_DRE"]) if o.table == "FATO_DRE"]
    assert not any(o.ok for o in outcomes) and "VL_CONTA" in outcomes[0].error
    assert read_table(spark, lake.fact("FATO_DRE")).count() == before


def test_a_failed_dimension_fails_its_facts(spark, folder):
    lake, _ = build_all(spark, folder)
    assert all(o.ok for o in builds.build_gold(spark, lake, [2020]))
    rename_stored(spark, lake.silver("cad_cia_aberta"), "SIT")
    ok = builds.results(builds.build_gold(spark, lake, [2020]))
    assert ok["DIM_EMPRESA"] == {None: False}
    assert ok["FATO_COTACAO"] == {2020: False} and ok["FATO_DIVIDENDOS"] == {2020: False}
    assert ok["FATO_DRE"] == {2020: True}
    assert read_table(spark, lake.fact("FATO_COTACAO")).count() == 3


def test_gold_takes_few_jobs(spark, folder):
    lake, _ = build_all(spark, folder)
    spark.sparkContext.setJobGroup("gold", "gold")
    builds.build_gold(spark, lake, [2020, 2021])
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("gold"))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert jobs <= 60, jobs


def test_register_names_with_line_breaks(spark, folder):
    root = fx.write_bronze(folder)
    (root / "bronze" / fx.ROOT / "cad_cia_aberta.csv").write_bytes(
        f'CNPJ_CIA;SETOR_ATIV;DENOM_SOCIAL;DENOM_COMERC;SIT\n{fx.A};Bancos;"Cia\nB;x";A;ATIVO\n{fx.B};Energia;C;C;ATIVO\n'.encode("cp1252")
    )
    assert builds.build_register(spark, Lake(str(root)))[0].rows == 2
    rows = {r["CNPJ"]: r["DENOM_SOCIAL"] for r in read_table(spark, Lake(str(root)).silver("cad_cia_aberta")).collect()}
    assert set(rows) == {"00000000000191", "00000208000100"} and "\n" in rows["00000000000191"]


@pytest.mark.parametrize("text, header", [
    ("\r\n\r\nA;B\r\n1;2\r\n", ["A", "B"]), ('"x\r\ny";B\r\n\r\n1;2\r\n', ["x\r\ny", "B"]), ("A;B\n\n", ["A", "B"]), ("A;B", ["A", "B"]),
])
def test_headers_after_blank_lines_and_with_line_breaks(spark, folder, text, header):
    path = fx.snapshot(Path(folder), fx.DFP, 2020, "2024-01-01", "00-00-00", "dfp")
    fx.write_zip(path, {"stem_2020.csv": text.encode("utf-8-sig")})
    landed = unpack(read_archives(spark, "DFP", [str(path)]), {"DFP": {"T": "stem"}})
    assert landed_status(landed).first()["colunas"] == header
    rows = [r["campos"] for r in landed.where("linha > 0").collect()]
    assert rows == ([["1", "2"]] if "1;2" in text else [])


def test_column_orders_are_told_apart(spark, folder):
    Path(folder, "a.csv").write_text("A;B\n1;2\n")
    Path(folder, "b.csv").write_text("\nB;A\n3;4\n")
    Path(folder, "c.csv").write_bytes("B;Ã;A\n5;é;6\n".encode("cp1252"))
    rows = read_csv(spark, [f"{folder}/{n}.csv" for n in "abc"]).collect()
    assert sorted((r["A"], r["B"], r["Ã"]) for r in rows) == [("1", "2", None), ("4", "3", None), ("6", "5", "é")]


def test_each_group_of_files_reads_its_own(spark, folder):
    for i in range(4):
        Path(folder, f"a {i}.csv").write_text(f"A;B\n{i};x\n")
        Path(folder, f"b[{i}]+%41{{}}.csv").write_bytes(f"B;A\né;{i}\n".encode("cp1252"))
        Path(folder, f"c{i}.csv").write_text(f"A;C\n{i};z\n")
    rows = read_csv(spark, folder)
    want = [(str(i), *v) for i in range(4) for v in (("x", None), ("é", None), (None, "z"))]
    assert sorted(((r["A"], r["B"], r["C"]) for r in rows.collect()), key=repr) == sorted(want, key=repr)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 3 and "Join" not in plan
    assert sorted(rows.inputFiles()) == sorted(set(rows.inputFiles())) and len(rows.inputFiles()) == 12


def test_two_archives_of_a_year_with_different_headers(spark, folder):
    swapped = ";".join(["DENOM_CIA", *[c for c in fx.STATEMENT_HEADER.split(";") if c != "DENOM_CIA"]])
    first, second = fx.DRE_2020[0].split(";"), fx.DRE_2020[1].split(";")
    other = ";".join([second[3], *second[:3], *second[4:]])
    paths = []
    for day, header, row in (("01", fx.STATEMENT_HEADER, ";".join(first)), ("02", swapped, other)):
        path = fx.snapshot(Path(folder), fx.DFP, 2020, f"2024-01-{day}", "00-00-00", "dfp")
        fx.write_zip(path, {"dfp_cia_aberta_DRE_con_2020.csv": fx.csv_text(header, [row]).encode("utf-8")})
        paths.append(str(path))
    lake = Lake(folder)
    outcomes = builds.silver_from_archives(read_archives(spark, "DFP", paths), lake, "DFP", [2020], ["DRE_con"], RUN)
    assert [o.error for o in outcomes] == [None]
    rows = read_table(spark, lake.silver("DRE_con")).collect()
    assert {(r["CNPJ_CIA"], r["DENOM_CIA"]) for r in rows} == {(fx.A, "CIA – €"), (fx.B, "CIA – €")}
    assert not Path(lake.landing).exists() or not any(Path(lake.landing).iterdir())


def test_an_unreadable_archive_and_a_year_not_asked_for_are_outcomes(spark, folder, monkeypatch):
    root = fx.write_bronze(folder)
    lake = Lake(str(root))
    archives = read_archives(spark, "DFP", builds.newest_archives(spark, lake, "DFP", [2020, 2021]).values())
    by = {(o.table, o.year): o for o in builds.silver_from_archives(archives, lake, "DFP", [2020], ["DRE_con"], RUN)}
    assert by["DRE_con", 2020].ok and "not asked for" in by["DRE_con", 2021].error
    size = fx.snapshot(root, fx.DFP, 2020, "2024-01-01", "10-00-00", "dfp").stat().st_size
    monkeypatch.setattr(builds, "reachable", lambda path: False)
    monkeypatch.setattr(builds, "ARCHIVE_BYTES", size - 1)
    by = {(o.table, o.year): o for o in builds.build_silver(spark, lake, "DFP", [2020, 2021], ["DRE_con"], RUN)}
    assert by["DRE_con", 2021].ok and "only Spark reads" in by["DRE_con", 2020].error

    def failing(landed, path, land=builds.land):
        if "2020" in landed._jdf.queryExecution().toString() or not failing.split:
            failing.split = True
            raise OSError("lost")
        land(landed, path)

    failing.split = False
    monkeypatch.setattr(builds, "ARCHIVE_BYTES", 10**9)
    monkeypatch.setattr(builds, "land", failing)
    by = {(o.table, o.year): o for o in builds.build_silver(spark, lake, "DFP", [2020, 2021], ["DRE_con"], RUN)}
    assert by["DRE_con", 2021].ok and by["DRE_con", 2020].error == "lost"


def test_a_year_without_one_share_count(spark, folder):
    root = fx.write_bronze(folder)
    header = fx.CAPITAL_HEADER.replace(";Quantidade_Acoes_Preferenciais", "")
    rows = [f"{fx.A};Cia A;Capital Integralizado;2021-01-01;2019-06-30;7;9"]
    fx.write_zip(fx.snapshot(root, fx.FRE, 2021, "2024-01-01", "10-00-00", "fre"), {"fre_cia_aberta_capital_social_2021.csv": fx.csv_text(header, rows).encode()})
    lake = Lake(str(root))
    ok = builds.results(builds.build_silver(spark, lake, "FRE", [2020, 2021], ["capital_social"], RUN))
    assert ok == {"capital_social": {2020: True, 2021: True}}
    got = {r["ano_referencia"]: r["Quantidade_Acoes_Ordinarias"] for r in read_table(spark, lake.silver("capital_social"), merge_schema=True).where("CNPJ = '00000000000191'").collect()}
    assert got == {2020: 13044496930, 2021: 7}


def test_jobs_run_side_by_side_in_the_callers_group(spark):
    together = threading.Barrier(2, timeout=60)
    spark.sparkContext.setLocalProperty("finlake.test", "caller")

    def job(n):
        together.wait()
        return n, spark.sparkContext.getLocalProperty("finlake.test")

    assert at_once(job, [2, 1]) == [(2, "caller"), (1, "caller")]
    spark.sparkContext.setLocalProperty("finlake.test", None)
