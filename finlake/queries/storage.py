"""Sources and sinks: bronze objects, archives, delimited text, partitioned tables, exports.

Queries that store a table do so below the session's shared checkpoint folder and read it back.
"""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.lake import Lake
from finlake.plans.builds import log_outcomes, silver_from_files
from finlake.plans.specs import SPECS
from finlake.queries import filings
from finlake.queries.filings import raw
from finlake.queries.registry import query, table
from finlake.session import scratch_dir
from finlake.sinks.exports import export_table
from finlake.sinks.tables import YEAR, migrate_to_years, overwrite_table, replace_years, years_in
from finlake.sources.bronze import bronze_path, latest_path, manifest_summary, read_manifest
from finlake.sources.tables import read_csv, read_table
from finlake.sources.zip_source import file_system

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _orders_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias(YEAR)
    )


_ORDERS_SQL = (
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(year(o_orderdate) as int) as ano_referencia "
    "from orders"
)

# Bronze objects -------------------------------------------------------------------------------------------------

_PATH_SQL = """concat('gov_br_cvm/', event_type, '/ano=', year(ts), '/data_extracao=', strftime(ts, '%Y-%m-%d'),
    '/hora=', strftime(ts, '%H-%M-%S'), '/')"""


def _arrivals(spark: SparkSession, sf: str) -> DataFrame:
    path = bronze_path(
        F.lit("gov_br_cvm"), F.col("event_type"), F.lit("ano"), F.year("ts").cast("string"),
        F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH-mm-ss"),
    )
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", path.alias("path"))


@query(f"select event_id, user_id, event_type, {_PATH_SQL} as path from events", name="bronze_path")
def bronze_paths(spark: SparkSession, sf: str) -> DataFrame:
    return _arrivals(spark, sf)


@query(f"select event_type, user_id, max({_PATH_SQL}) as path from events group by all")
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return latest_path(_arrivals(spark, sf), "event_type", "user_id")


@query("""
    select 'eventos' as fonte, event_type as tipo_ativo, count(*) as objetos,
           cast(sum(cast(json_extract(props, '$.k') as bigint)) as bigint) as tamanho_bytes,
           max(value) as tempo_resposta_ms_max, count(*) filter (event_type = 'error') as falhas
    from events group by event_type
""")
def manifest_json(spark: SparkSession, sf: str) -> DataFrame:
    """Ingestion records stored as JSON, read back with their declared schema and summed up."""
    record = table(spark, sf, "events").select(
        F.lit("eventos").alias("fonte"), F.col("event_type").alias("tipo_ativo"),
        F.struct(F.lit("usuario").alias("tipo"), F.col("user_id").cast("string").alias("valor")).alias("identificador"),
        F.struct(
            F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
            F.col("value").alias("tempo_resposta_ms"),
        ).alias("requisicao"),
        F.struct(F.from_json("props", "k bigint")["k"].alias("tamanho_bytes")).alias("dados"),
    )
    path = scratch_dir(spark, "manifest")
    record.write.json(path)
    return manifest_summary(read_manifest(spark, path, multi_line=False))


# Archives -------------------------------------------------------------------------------------------------------

_TABLES = ("DRE_con", "BPA_con", "BPP_con", "DFC_DMPL_con")
_MEMBERS = {name: SPECS[name].member for name in _TABLES}


#: CSV text that one archive of the query holds at least, but for the last of a task and year.
_ARCHIVE_TEXT = 32 << 20


def _zip_files(batches: Iterator[pa.RecordBatch], members: dict[str, str], folder: str) -> Iterator[pa.RecordBatch]:
    """Rows stored as archives of one year, their members holding them as CSV, in UTF-8 or windows-1252; year and path of each."""
    system, inner = file_system(folder)
    system.create_dir(inner)
    part, number, held = TaskContext.get().partitionId(), 0, {}

    def packed(year: int) -> dict:
        nonlocal number
        header, text = f"{held[year][0]}\n", held.pop(year)[1].getvalue()
        contents = [header.encode() + text, (header.encode() + text).decode().encode("cp1252")]
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
            for i, stem in enumerate(members.values()):
                archive.writestr(f"{stem}_ind_{year}.csv", b"CNPJ_CIA\n")
                archive.writestr(f"{stem}_{year}.csv", contents[(i + year) % 2])
        name, number = f"{year}-{part}-{number}.zip", number + 1
        with system.open_output_stream(f"{inner}/{name}") as file:
            file.write(packed.getvalue())
        return {"ano": year, "path": f"{folder}/{name}"}

    def done(years: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([packed(y) for y in years], schema=pa.schema([("ano", pa.int32()), ("path", pa.string())]))

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        years = rows.column("ano_referencia")
        for year in years.unique().to_pylist():
            one = rows.filter(pc.equal(years, year)).drop_columns(["ano_referencia"])
            _, text = held.setdefault(year, (";".join(one.column_names), io.BytesIO()))
            pacsv.write_csv(one, text, pacsv.WriteOptions(delimiter=";", quoting_style="needed", include_header=False))
        yield done([y for y, (_, text) in held.items() if text.tell() >= _ARCHIVE_TEXT])
    yield done(list(held))


def _silver_built(spark: SparkSession, sf: str, tables: tuple[str, ...], run_ts: datetime) -> Lake:
    """Filings packed into archives, then unpacked, decoded, cleaned, stored by year, with the run logged."""
    lake = Lake(scratch_dir(spark, "archives"))
    members, filed, folder = {t: _MEMBERS[t] for t in tables}, raw(spark, sf, "statements"), lake.bronze
    written = filed.mapInArrow(lambda batches: _zip_files(batches, members, folder), "ano int, path string")
    paths = sorted((r["ano"], r["path"]) for r in written.collect())  # one row per archive
    outcomes = silver_from_files(spark, paths, lake, "DFP", sorted({y for y, _ in paths}), tables, run_ts)
    log_outcomes(spark, lake, run_ts, outcomes)
    failed = [o for o in outcomes if not o.ok]
    if failed:
        raise RuntimeError(f"{failed[0].table} {failed[0].year}: {failed[0].error}")
    return lake


@query(" union all ".join(f"select '{t}' as tabela, * from ({filings.statement_sql(t)})" for t in _TABLES))
def silver_from_zip(spark: SparkSession, sf: str) -> DataFrame:
    """All tables of one document type from archives whose members are in UTF-8 or windows-1252."""
    lake = _silver_built(spark, sf, _TABLES, datetime(2024, 1, 1))
    parts = [
        read_table(spark, lake.silver(t)).withColumn("tabela", F.lit(t)).drop("data_processamento", "document_type")
        for t in _TABLES
    ]
    return reduce(DataFrame.unionByName, parts)


@query(f"""
    with s as ({filings.statement_sql('BPP_con')}), y as (select distinct cast(year(l_shipdate) as int) as ano from lineitem)
    select 'silver' as step, 'BPP_con' as tabela, ano, true as ok, count(s.CNPJ_CIA) as linhas, true as medido,
           '2024-01-01 00:00:00' as processado, count(s.CNPJ_CIA) as linhas_com_linhagem
    from y left join s on s.ano_referencia = y.ano group by ano
""")
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """The run log of a silver build, its seconds measured, next to the rows that carry the run's timestamp."""
    run_ts = datetime(2024, 1, 1)
    lake = _silver_built(spark, sf, ("BPP_con",), run_ts)
    log = spark.read.parquet(lake.log("runs"))
    stamped = read_table(spark, lake.silver("BPP_con")).where(
        (F.col("data_processamento") == F.lit(run_ts)) & (F.col("document_type") == "DFP")
    )
    traced = stamped.groupBy(F.col(YEAR).alias("ano")).agg(F.count(F.lit(1)).alias("linhas_com_linhagem"))
    return log.join(traced, "ano", "left").select(
        "step", "tabela", "ano", "ok", "linhas", (F.col("segundos") > 0).alias("medido"),
        F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("processado"),
        F.coalesce("linhas_com_linhagem", F.lit(0)).alias("linhas_com_linhagem"),
    )


# Delimited text -------------------------------------------------------------------------------------------------


@query("select cast(c_custkey as varchar) as c_custkey, c_name, concat('Ação – ', c_mktsegment) as segmento from customer")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Semicolon-separated text in two encodings and two column orders, found out per file, every column read as text."""
    path = scratch_dir(spark, "csv")
    dash = {"ISO-8859-1": "\u0096", "UTF-8": "–"}
    orders = {"ISO-8859-1": ["c_custkey", "c_name", "segmento"], "UTF-8": ["segmento", "c_custkey", "c_name"]}
    for i, (encoding, columns) in enumerate(orders.items()):
        rows = table(spark, sf, "customer").where(F.col("c_custkey") % 2 == i).select(
            "c_custkey", "c_name", F.concat(F.lit(f"Ação {dash[encoding]} "), "c_mktsegment").alias("segmento")
        )
        writer = rows.select(*columns).write.option("header", "true").option("sep", ";").option("encoding", encoding)
        writer.csv(f"{path}/{i}")
    return read_csv(spark, [f"{path}/{i}" for i in range(len(orders))])


@query("select cast(c_custkey as varchar) as c_custkey, concat(c_name, chr(10), 'S.A.') as nome, c_mktsegment from customer")
def register_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A register whose names hold quoted line breaks."""
    path = scratch_dir(spark, "register")
    rows = table(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit("\nS.A.")).alias("nome"), "c_mktsegment")
    rows.write.option("header", "true").option("sep", ";").option("quoteAll", "true").option("escape", '"').csv(path)
    return read_csv(spark, path, multi_line=True)


# Partitioned tables ---------------------------------------------------------------------------------------------


@query(f"select * from ({_ORDERS_SQL}) where ano_referencia = 1998")
def year_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "years")
    orders = _orders_by_year(spark, sf)
    replace_years(orders, path, years_in(orders))
    return read_table(spark, path, "1998")


@query(f"select * from ({_ORDERS_SQL}) where ano_referencia <> 1997 or o_orderstatus = 'F'")
def replace_year(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "replace")
    orders = _orders_by_year(spark, sf)
    replace_years(orders, path, years_in(orders))
    replace_years(orders.where((F.col(YEAR) == 1997) & (F.col("o_orderstatus") == "F")), path, [1997])
    return read_table(spark, path)


@query(f"select * from ({_ORDERS_SQL}) where ano_referencia <> 1996")
def replace_year_empty(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "empty")
    orders = _orders_by_year(spark, sf)
    replace_years(orders, path, years_in(orders))
    replace_years(orders.where((F.col(YEAR) == 1996) & (F.col("o_orderstatus") == "none")), path, [1996])
    return read_table(spark, path)


@query("select c_custkey, c_name, c_nationkey from customer")
def overwrite_dim(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "dim")
    customers = table(spark, sf, "customer")
    overwrite_table(customers.select("c_custkey", "c_name"), path)
    overwrite_table(customers.select("c_custkey", "c_name", "c_nationkey"), path)
    return read_table(spark, path)


@query(_ORDERS_SQL)
def layout_migration(spark: SparkSession, sf: str) -> DataFrame:
    """An unpartitioned table rewritten by year with its rows kept."""
    flat, by_year = scratch_dir(spark, "flat"), scratch_dir(spark, "by-year")
    orders = _orders_by_year(spark, sf)
    overwrite_table(orders, flat)
    migrate_to_years(spark, flat, by_year, years_in(orders))
    return read_table(spark, by_year)


@query(f"select * from ({_ORDERS_SQL}) where ano_referencia = 2000")
def layout_reset(spark: SparkSession, sf: str) -> DataFrame:
    """Replacing a year of an unpartitioned table starts the table afresh."""
    path = scratch_dir(spark, "reset")
    orders = _orders_by_year(spark, sf)
    overwrite_table(orders, path)
    replace_years(orders.where(F.col(YEAR) == 2000), path, [2000])
    return read_table(spark, path)


@query("""
    select o_orderkey, o_totalprice, case when year(o_orderdate) >= 1998 then o_orderpriority end as o_orderpriority,
           cast(year(o_orderdate) as int) as ano_referencia
    from orders
""")
def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Later years bring a column that earlier years lack."""
    path = scratch_dir(spark, "evolution")
    orders = table(spark, sf, "orders").withColumn(YEAR, F.year("o_orderdate"))
    early, late = orders.where(F.col(YEAR) < 1998), orders.where(F.col(YEAR) >= 1998)
    replace_years(early.select("o_orderkey", "o_totalprice", YEAR), path, years_in(early))
    replace_years(late.select("o_orderkey", "o_totalprice", "o_orderpriority", YEAR), path, years_in(late))
    return read_table(spark, path, merge_schema=True)


@query("select cast(2000 + p_size as int) as ano_referencia, count(*) as linhas from part group by all")
def write_count(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per year as counted by the job that wrote them (one row per year comes back)."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name", (F.lit(2000) + F.col("p_size")).cast("int").alias(YEAR))
    written = replace_years(parts, scratch_dir(spark, "count"), years_in(parts))
    return spark.createDataFrame(sorted(written.items()), f"{YEAR} int, linhas bigint")


# Exports --------------------------------------------------------------------------------------------------------

_CUSTOMER_SQL = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"


@query(_CUSTOMER_SQL)
def export_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "export-csv")
    export_table(spark, f"{sf}/customer.parquet", path, "csv")
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return spark.read.schema(schema).option("header", "true").csv(path)


@query(_CUSTOMER_SQL)
def export_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "export-parquet")
    export_table(spark, f"{sf}/customer.parquet", path, "parquet")
    return read_table(spark, path)
