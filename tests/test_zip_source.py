"""Archives read by the byte ranges of their members."""

import os
import zipfile
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from finlake.lake import Lake
from finlake.plans import builds
from finlake.sources import archives, zip_source
from finlake.sources.archives import ASCII, UTF8, WINDOWS_1252, Layout, landed_status, landed_table, read_archives, unpack
from finlake.sources.tables import read_table
from tests import bronze_fixture as fx

STEMS = {"T": "stem", "U": "other"}


def landed_rows(df):
    return sorted((r["tabela"], r["ano"], r["linha"], r["campos"], r["codificacao"], r["defeito"]) for r in df.collect() if r["membro"])


def test_members_are_those_of_whole_archives(spark, folder):
    for year, encoding in ((2020, "cp1252"), (2021, "utf-8-sig")):
        text = 'A;B\r\n"x;1\r\ny";é\r\n\r\nshort\r\n'.encode(encoding)
        fx.write_zip(Path(folder, f"{year}.zip"), {f"sub/stem_{year}.csv": text, f"stem_extra_{year}.csv": b"no", "other.csv": b"C\n1\n"})
    paths = [(y, f"{folder}/{y}.zip") for y in (2020, 2021)]
    got = zip_source.read_members(spark, "DFP", paths, STEMS)
    whole = [unpack(read_archives(spark, "DFP", [p]).drop("ano").selectExpr("*", f"{y} as ano"), {"DFP": STEMS}) for y, p in paths]
    assert landed_rows(got) == landed_rows(whole[0].unionByName(whole[1]))
    status = {(r["tabela"], r["ano"]): (r["colunas"], r["codificacao"], r["defeito"]) for r in landed_status(got).collect()}
    assert status == {
        ("T", 2020): (["A", "B"], WINDOWS_1252, None), ("T", 2021): (["A", "B"], UTF8, None),
        ("U", 2020): (["C"], ASCII, None), ("U", 2021): (["C"], ASCII, None),
    }


def test_one_partition_per_member_each_inflated_once(spark, folder, monkeypatch):
    fx.write_zip(Path(folder, "a.zip"), {"stem.csv": b"A\n" + b"1\n" * 100, "other.csv": b"B\n2\n", "unwanted.csv": b"C\n"})
    reader = zip_source.ZipReader([["DFP", 2020, f"{folder}/a.zip"]], {"DFP": STEMS})
    planned = reader.partitions()
    assert [p.name for p in planned] == ["stem.csv", "other.csv"]
    assert zip_source.read_members(spark, "DFP", [(2020, f"{folder}/a.zip")], STEMS).rdd.getNumPartitions() == 2
    opened, read = [], zipfile.ZipExtFile.__init__
    monkeypatch.setattr(zipfile.ZipExtFile, "__init__", lambda self, *a, **k: (opened.append(a[2].filename), read(self, *a, **k))[1])
    rows = [b.num_rows for p in planned for b in reader.read(p)]
    assert opened == ["stem.csv", "other.csv"] and sum(rows) == 102 + 2 + 1


def test_an_archive_of_more_than_two_gigabytes(spark, folder):
    path = f"{folder}/large.zip"
    with open(path, "wb") as file:  # a hole on disk, not bytes
        file.truncate(2_300_000_000)
    with zipfile.ZipFile(path, "a", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("stem_2020.csv", "A;B\n" + "1;é\n" * 50_000)
    assert os.path.getsize(path) > (1 << 31)
    rows = zip_source.read_members(spark, "DFP", [(2020, path)], STEMS)
    assert rows.where("linha > 0").count() == 50_000
    assert landed_status(rows).first()["codificacao"] == UTF8


def test_large_archives_are_built(spark, folder):
    root = fx.write_bronze(folder)
    path = fx.snapshot(root, fx.DFP, 2022, "2024-01-01", "10-00-00", "dfp")
    path.parent.mkdir(parents=True)
    with open(path, "wb") as file:
        file.truncate(2_300_000_000)
    with zipfile.ZipFile(path, "a", zipfile.ZIP_DEFLATED) as archive:
        for name, content in fx.dfp_members(2022, fx.DRE_2020).items():
            archive.writestr(name, content)
    lake = Lake(str(root))
    outcomes = builds.build_silver(spark, lake, "DFP", [2022], ["DRE_con"])
    assert [(o.ok, o.rows) for o in outcomes] == [(True, 6)]
    assert {r["DENOM_CIA"] for r in read_table(spark, lake.silver("DRE_con")).collect()} == {"CIA – €"}


def test_what_cannot_be_read_is_a_defect_of_its_member(spark, folder):
    fx.write_zip(Path(folder, "good.zip"), {"stem.csv": b"A\n1\n"})
    Path(folder, "broken.zip").write_bytes(b"not an archive")
    data = bytearray(Path(folder, "good.zip").read_bytes())
    data[32 + len("stem.csv")] ^= 0xFF
    Path(folder, "bits.zip").write_bytes(data)
    names = ["good", "broken", "bits", "absent"]
    rows = zip_source.read_members(spark, "DFP", [(2020 + i, f"{folder}/{n}.zip") for i, n in enumerate(names)], {"T": "stem"})
    defects = {r["ano"]: r["defeito"] for r in landed_status(rows).collect() if r["defeito"]}
    assert set(defects) == {2021, 2022, 2023}
    assert defects[2021].startswith("unreadable archive") and defects[2022].startswith("unreadable:")
    assert rows.where("ano = 2020 and linha > 0").count() == 1


def test_no_archive_and_no_member(spark, folder):
    fx.write_zip(Path(folder, "a.zip"), {"x.csv": b"A\n1\n"})
    assert zip_source.read_members(spark, "DFP", [], STEMS).count() == 0
    assert zip_source.read_members(spark, "DFP", [(2020, f"{folder}/a.zip")], STEMS).count() == 0


@pytest.mark.parametrize("path, known", [("/a", True), ("file:/a", True), ("file:///a", True), ("s3a://b/a", True), ("viewfs:///a", False)])
def test_file_systems(path, known):
    assert zip_source.reachable(path) is known
    if path.startswith(("/", "file")):
        assert zip_source.file_system(path)[1] == "/a"


def test_records_land_as_columns_in_files_of_their_own(spark, folder):
    text = 'A;B\n"x;1\ny";é\nshort\n1;2\n'
    fx.write_zip(Path(folder, "a.zip"), {"stem.csv": text.encode("cp1252"), "other.csv": b"C\n"})
    rows = zip_source.read_members(spark, "DFP", [(2020, f"{folder}/a.zip")], STEMS, f"{folder}/records").cache()
    assert rows.where("linha > 0").count() == 0
    status = {r["tabela"]: r for r in landed_status(rows).collect()}
    assert status["U"]["registros"] == [] and len(status["T"]["registros"]) == 1
    layout = Layout(status["T"]["cabecalho"], ("A", "B"), status["T"]["codificacao"])
    Path(folder, "records", "lost-attempt.parquet").write_bytes(b"nobody reads this")
    got = landed_table(rows, "T", layout, [(2020, f"{folder}/a.zip", status["T"]["registros"])])
    assert sorted(map(tuple, got.collect())) == [("1", "2", 2020), ("short", None, 2020), ("x;1\ny", "é", 2020)]
    rows.unpersist()


def test_a_member_that_is_not_utf8_only_at_its_end(spark, folder):
    lines = 2 * archives.BLOCK_BYTES // 64
    content = "A;B\n".encode() + f"é;{'x' * 60}\n".encode() * lines + b"\xe9;y\n" + "é;\n".encode()
    fx.write_zip(Path(folder, "a.zip"), {"stem.csv": content})
    rows = zip_source.read_members(spark, "DFP", [(2020, f"{folder}/a.zip")], {"T": "stem"}, f"{folder}/records").cache()
    status = landed_status(rows).first()
    assert status["codificacao"] == WINDOWS_1252 and len(status["registros"]) == 2
    layout = Layout(status["cabecalho"], ("A", "B"), status["codificacao"])
    got = landed_table(rows, "T", layout, [(2020, f"{folder}/a.zip", status["registros"])])
    assert {(r["A"], r["n"]) for r in got.groupBy("A").agg(F.count("*").alias("n")).collect()} == {("Ã©", lines + 1), ("é", 1)}
    rows.unpersist()


def test_a_long_record_in_a_file_is_a_defect(spark, folder):
    fx.write_zip(Path(folder, "a.zip"), {"stem.csv": b"A;B\n1;2\n1;2;3\n4;5\n"})
    rows = zip_source.read_members(spark, "DFP", [(2020, f"{folder}/a.zip")], {"T": "stem"}, f"{folder}/records")
    assert landed_status(rows).first()["defeito"] == "3 fields for 2 columns"


def test_a_planned_member_is_sent_as_its_values(folder):
    fx.write_zip(Path(folder, "a.zip"), {"stem.csv": b"A\n1\n"})
    planned = zip_source.ZipReader([["DFP", 2020, f"{folder}/a.zip"]], {"DFP": STEMS}).partitions()
    sent = cloudpickle.dumps(planned[0])
    assert len(sent) < 1000
    assert zip_source.Member.of(cloudpickle.loads(sent)) == planned[0]
