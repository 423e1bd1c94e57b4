"""The jobs a user runs: raw to cleaned tables, cleaned tables to the star schema, quality sweep, exports.

The driver only loops over tables. Each table is one job over all requested years, and one that fails is
recorded without stopping the others.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.lake import Lake
from finlake.operators.clean import TableSpec, clean, cleaned_schema, with_lineage
from finlake.operators.quality import Checks, errors, measure, metrics_of, profile, report, summary
from finlake.operators.sketches import SECONDS_BOUNDS, histogram
from finlake.operators.star import Fact, build_dimension, build_fact
from finlake.plans.specs import DOCUMENT_FOLDERS, PROFILED, SOURCE_SYSTEM, SPECS, YEARS, tables_of
from finlake.plans.star import CALENDAR_NAME, COMPANY, FACTS, SECURITY, STANDARD_FACTS
from finlake.sinks.exports import export_table
from finlake.session import at_once, shuffles_sized_for, unsorted_writes
from finlake.sinks.tables import (
    YEAR, append_rows, overwrite_table, path_exists, remove, replace_years, stored_bytes, stored_columns, stored_years,
)
from finlake.sources.archives import ARCHIVE_BYTES, LANDING_FILES, Layout, land, landed_status, landed_table, read_archives, unpack
from finlake.sources.bronze import latest_path, list_objects
from finlake.sources.tables import calendar, read_csv, read_table
from finlake.sources.zip_source import reachable, read_members

# Rough growth of the data from a compressed archive, or a stored table, to rows in an exchange.
ARCHIVE_EXPANSION = 10
# Stored bytes of a company dimension up to which its keys are broadcast.
BROADCAST_BYTES = 256 * 1024 * 1024
FOOTER_READERS = 8
TABLE_EXPANSION = 4

RUN_LOG_SCHEMA = (
    "run_ts timestamp, step string, tabela string, ano int, ok boolean, linhas bigint, segundos double, erro string"
)


@dataclass(frozen=True)
class Outcome:
    """Result of one table and year of a run."""

    step: str
    table: str
    year: int | None
    ok: bool
    rows: int | None = None
    seconds: float | None = None
    error: str | None = None


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)


def _attempt(step: str, table: str, years: Iterable[int | None], job: Callable[[], Mapping]) -> list[Outcome]:
    """Run one table's job; a failure marks its years and lets the run go on."""
    started = time.monotonic()
    try:
        written = job()
    except Exception as error:  # noqa: BLE001 - isolation of one table is the feature
        seconds = time.monotonic() - started
        return [Outcome(step, table, y, False, None, seconds, str(error)) for y in years]
    seconds = time.monotonic() - started
    return [Outcome(step, table, y, True, n, seconds) for y, n in written.items()]


def log_outcomes(spark: SparkSession, lake: Lake, run_ts: datetime, outcomes: list[Outcome]) -> list[Outcome]:
    """Append the run's outcomes (a few rows per table) to the run log."""
    rows = [(run_ts, o.step, o.table, o.year, o.ok, o.rows, o.seconds, o.error) for o in outcomes]
    if rows:
        append_rows(spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1), lake.log("runs"))
    return outcomes


def processing_seconds(spark: SparkSession, lake: Lake) -> DataFrame:
    """``(step, tabela, ate, n, soma)``: how long tables took, as one histogram over all logged runs. A table's job is counted once
    a run, not once a year."""
    jobs = spark.read.schema(RUN_LOG_SCHEMA).parquet(lake.log("runs")).where("ok and segundos is not null")
    jobs = jobs.groupBy("run_ts", "step", "tabela").agg(F.max("segundos").alias("segundos"))
    return histogram(jobs, "segundos", SECONDS_BOUNDS, ["step", "tabela"])


def results(outcomes: Iterable[Outcome]) -> dict[str, dict[int | None, bool]]:
    """``{table: {year: succeeded}}``."""
    table: dict[str, dict[int | None, bool]] = {}
    for o in outcomes:
        table.setdefault(o.table, {})[o.year] = o.ok
    return table


# Raw to cleaned -----------------------------------------------------------------------------------------------


def build_register(spark: SparkSession, lake: Lake, run_ts: datetime | None = None) -> list[Outcome]:
    """The company register: newest bare CSV of the source, cleaned and replaced as a whole."""
    spec = SPECS["cad_cia_aberta"]

    def job() -> Mapping:
        newest = latest_path(list_objects(spark, f"{lake.bronze}/{SOURCE_SYSTEM}", ".csv")).first()["path"]
        if newest is None:
            raise FileNotFoundError("no register file")
        rows = read_csv(spark, newest, multi_line=True)  # one file, whose names may hold line breaks
        return {None: overwrite_table(clean(rows, spec), lake.silver(spec.name))}

    return log_outcomes(spark, lake, run_ts or _now(), _attempt("silver", spec.name, [None], job))


def silver_table(
    landed: DataFrame, members: Mapping[int, Iterable[tuple[Layout, str, Sequence[str]]]], spec: TableSpec, run_ts
) -> DataFrame:
    """Cleaned rows of one table for all given years; members, each a layout, an archive and its files of records, are cleaned
    together when they have the same layout."""
    alike: dict[Layout, list[tuple[int, str, Sequence[str]]]] = {}
    for year, found in members.items():
        for layout, file, records in found:
            alike.setdefault(layout, []).append((year, file, records))
    parts = [clean(landed_table(landed, spec.name, layout, files), spec) for layout, files in sorted(alike.items())]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if spec.distinct and len(parts) > 1:
        rows = rows.dropDuplicates()
    return with_lineage(rows, spec, run_ts)


def newest_archives(spark: SparkSession, lake: Lake, document: str, years: Iterable[int]) -> dict[int, str]:
    """Path of the newest archive per year of a document type; years without one are absent."""
    folder = f"{lake.bronze}/{SOURCE_SYSTEM}/{DOCUMENT_FOLDERS[document]}"
    if not path_exists(spark, folder):
        return {}
    objects = list_objects(spark, folder, ".zip").where(F.col("ano").isin([int(y) for y in years]))
    return {r["ano"]: r["path"] for r in latest_path(objects, "ano").collect()}  # one row per year


def _landed_members(landed: DataFrame) -> tuple[dict, dict]:
    """Layout, archive and files of records of the members per table and year, and what is wrong with a table and year."""
    found: dict[str, dict[int, list[tuple[Layout, str, Sequence[str]]]]] = {}
    broken: dict[tuple[str, int], str] = {}
    for r in landed_status(landed).collect():  # one row per table, year and header
        if r["defeito"]:
            broken[r["tabela"], r["ano"]] = r["defeito"]
        elif r["colunas"]:
            layout = Layout(r["cabecalho"], tuple(r["colunas"]), r["codificacao"])
            found.setdefault(r["tabela"], {}).setdefault(r["ano"], []).append((layout, r["arquivo"], r["registros"]))
    return found, broken


def silver_from_archives(
    archives: DataFrame | None, lake: Lake, document: str, years: Iterable[int], tables: Iterable[str],
    run_ts: datetime, specs: Mapping[str, TableSpec] = SPECS,
) -> list[Outcome]:
    """``silver_from_landed`` for archives that are values of a frame, ``documento, ano, content``."""
    names = tuple(tables)
    stems = {document: {n: specs[n].member for n in names}}

    def unpacked(year: int | None, _: str) -> DataFrame:
        return unpack(archives if year is None else archives.where(F.col("ano") == year), stems)

    spark = None if archives is None else archives.sparkSession
    return silver_from_landed(spark, unpacked, lake, document, years, names, run_ts, specs)


def silver_from_files(
    spark: SparkSession, paths: Iterable[tuple[int, str]], lake: Lake, document: str, years: Iterable[int],
    tables: Iterable[str], run_ts: datetime, specs: Mapping[str, TableSpec] = SPECS,
) -> list[Outcome]:
    """``silver_from_landed`` for archives of any size, given by year and path, that tasks reach by themselves."""
    names, paths = tuple(tables), list(paths)
    stems = {n: specs[n].member for n in names}

    def unpacked(year: int | None, records: str) -> DataFrame:
        own = [(y, path) for y, path in paths if year in (None, y)]
        return read_members(spark, document, own, stems, records if reachable(records) else None)

    return silver_from_landed(spark if paths else None, unpacked, lake, document, years, names, run_ts, specs)


def silver_from_landed(
    spark: SparkSession | None, unpacked: Callable[[int | None, str], DataFrame], lake: Lake, document: str, years: Iterable[int],
    tables: Iterable[str], run_ts: datetime, specs: Mapping[str, TableSpec] = SPECS,
) -> list[Outcome]:
    """Land the ``unpacked`` rows (of all years, or of one), then clean and store each table for all years in one job. Records
    may be unpacked into files in a folder beside them.

    An archive that cannot be read fails its year; archives of a year not asked for are recorded and not stored. The
    landed rows are removed at the end. Without a session there are no archives.
    """
    names, years = tuple(tables), sorted({int(y) for y in years})
    found: dict[str, dict[int, list[tuple[Layout, str, Sequence[str]]]]] = {}
    broken: dict[tuple[str, int], str] = {}
    outcomes: list[Outcome] = []
    if spark is None:
        return [Outcome("silver", name, y, False, error="not found") for name in names for y in years]
    landing = f"{lake.landing}/{document}-{run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    records = f"{landing}-records"

    def unpack_part(year: int | None) -> Mapping:
        land(unpacked(year, records), landing)
        return {}

    try:
        if _attempt("silver", document, [None], lambda: unpack_part(None)):
            # Something could not be read at all; year by year, the others get through.
            for y in years:
                for failure in _attempt("silver", document, [y], lambda y=y: unpack_part(y)):
                    broken |= {(name, y): failure.error for name in names}
        landed = None
        if path_exists(spark, f"{landing}/tabela=*"):
            landed = spark.read.parquet(landing)
            found, defects = _landed_members(landed)
            broken |= defects
        for name in names:
            good = {y: m for y, m in found.get(name, {}).items() if y in years and (name, y) not in broken}
            if good:

                def job(name=name, good=good) -> Mapping:
                    rows = silver_table(landed, good, specs[name], run_ts)
                    # Landed rows lie in whole files per year, and removing copies leaves even partitions; those of
                    # several years need an exchange to become whole files again.
                    return replace_years(rows, lake.silver(name), sorted(good), rebalance=specs[name].distinct and len(good) > 1)

                outcomes += _attempt("silver", name, sorted(good), job)
            outcomes += [
                Outcome("silver", name, y, False, error=broken.get((name, y), "not found")) for y in years if y not in good
            ]
            others = {*found.get(name, {}), *(y for n, y in broken if n == name)}.difference(years)
            outcomes += [
                Outcome("silver", name, y, False, error="archive of a year that was not asked for") for y in sorted(others)
            ]
    finally:
        remove(spark, landing, records)
    return outcomes


def build_silver(
    spark: SparkSession, lake: Lake, document: str, years: Iterable[int] = YEARS, tables: Iterable[str] | None = None,
    run_ts: datetime | None = None,
) -> list[Outcome]:
    """All tables of one document type from the newest archive of each year."""
    names, run_ts, years = tuple(tables or tables_of(document)), run_ts or _now(), sorted({int(y) for y in years})
    if document == "CAD":
        return build_register(spark, lake, run_ts)
    newest = newest_archives(spark, lake, document, years)
    sizes = {y: stored_bytes(spark, path) for y, path in newest.items()}
    too_large: list[int] = []
    with shuffles_sized_for(spark, sum(sizes.values()) * ARCHIVE_EXPANSION):
        if all(map(reachable, newest.values())):
            outcomes = silver_from_files(spark, newest.items(), lake, document, years, names, run_ts)
        else:
            too_large = [y for y, size in sizes.items() if size > ARCHIVE_BYTES]
            paths = [path for y, path in newest.items() if y not in too_large]
            archives = read_archives(spark, document, paths) if paths else None
            outcomes = silver_from_archives(archives, lake, document, [y for y in years if y not in too_large], names, run_ts)
    reason = f"archive of more than {ARCHIVE_BYTES} bytes on a file system that only Spark reads"
    outcomes += [Outcome("silver", name, y, False, error=reason) for name in names for y in too_large]
    return log_outcomes(spark, lake, run_ts, outcomes)


# Cleaned to star schema ---------------------------------------------------------------------------------------


def _stored_in(spark: SparkSession, path: str, columns: Iterable[str], years: Iterable[int] | None = None) -> None:
    """Raise unless every year's files at ``path`` have all ``columns``; a declared schema would read NULL instead."""
    stored = sorted(stored_years(spark, path))
    parts = [f"{path}/{YEAR}={y}" for y in stored if years is None or y in years] if stored else [path]
    with ThreadPoolExecutor(FOOTER_READERS) as pool:  # one footer each
        found = list(pool.map(lambda part: stored_columns(spark, part), parts))
    for part, there in zip(parts, found):
        lacking = set(columns) - {YEAR} - there
        if lacking:
            raise ValueError(f"{part} has no column {', '.join(sorted(lacking))}")


def build_gold(
    spark: SparkSession, lake: Lake, years: Iterable[int] = YEARS, facts: Iterable[str] = STANDARD_FACTS,
    unique_companies: bool = False, run_ts: datetime | None = None,
) -> list[Outcome]:
    """Dimensions once per run, then every fact for all years, a few facts at a time.

    ``unique_companies`` keeps one row per company and counts each quote and dividend once; otherwise a
    company registered twice repeats them, as a plain join on the register does. A source that lacks a column fails
    its table, and a company dimension that failed fails the facts joined to it; what is stored of them stays.
    """
    run_ts, years = run_ts or _now(), sorted({int(y) for y in years})
    company_path = lake.dimension(COMPANY.name)

    def companies() -> Mapping:
        register = read_table(spark, lake.silver(COMPANY.source))  # not partitioned, so no year column
        rows = build_dimension(register, COMPANY, unique_companies, {"data_atualizacao": run_ts})
        return {None: overwrite_table(rows, company_path)}

    def securities() -> Mapping:
        _stored_in(spark, lake.silver(SECURITY.source), SECURITY.columns.values())
        schema = cleaned_schema(SPECS[SECURITY.source], SECURITY.columns.values())
        listed = read_table(spark, lake.silver(SECURITY.source), schema=schema)
        return {None: overwrite_table(build_dimension(listed, SECURITY), lake.dimension(SECURITY.name))}

    outcomes = _attempt("gold", COMPANY.name, [None], companies)
    company = outcomes[0]
    small = company.ok and stored_bytes(spark, company_path) <= BROADCAST_BYTES
    outcomes += _attempt(
        "gold", CALENDAR_NAME, [None],
        lambda: {None: overwrite_table(calendar(spark).coalesce(1), lake.dimension(CALENDAR_NAME))},
    )
    outcomes += _attempt("gold", SECURITY.name, [None], securities)

    def build(fact: Fact) -> Mapping:
        if fact.company and not company.ok:
            raise RuntimeError(f"{COMPANY.name} failed: {company.error}")
        for t in fact.sources:
            _stored_in(spark, lake.silver(t), fact.columns.values(), years)
        schemas = {t: cleaned_schema(SPECS[t], fact.columns.values()) for t in fact.sources}
        tables = {
            t: read_table(spark, lake.silver(t), schema=schema).where(F.col(YEAR).isin(years))
            for t, schema in schemas.items()
        }
        dim = read_table(spark, company_path) if fact.company else None
        rows = build_fact(tables, fact, dim, company.rows if small else None, fan_out=not unique_companies)
        # Sources are stored by year. A fact projected from them keeps their layout, so only one that was joined spends an
        # exchange on it.
        return replace_years(rows, lake.fact(fact.name), years, rebalance=fact.company is not None)

    joined = [stored_bytes(spark, *[lake.silver(t) for t in FACTS[n].sources]) for n in facts if FACTS[n].company]
    with shuffles_sized_for(spark, max(joined, default=0) * TABLE_EXPANSION), unsorted_writes(spark, LANDING_FILES):
        for built in at_once(lambda name: _attempt("gold", name, years, lambda: build(FACTS[name])), facts):
            outcomes += built
    return log_outcomes(spark, lake, run_ts, outcomes)


# Quality ------------------------------------------------------------------------------------------------------


def checks_for(spec: TableSpec) -> Checks:
    return Checks(spec.name, spec.required, spec.key if spec.required is not None else ())


def validate(df: DataFrame, table: str, year: int | None, as_of: date | None = None) -> dict:
    """All checks of one cleaned table and year as a nested dictionary."""
    return report(profile(df, checks_for(SPECS[table]), as_of or date.today(), year=year))


def sweep(
    tables: Mapping[str, DataFrame], years: Iterable[int], as_of: date, specs: Mapping[str, TableSpec] = SPECS
) -> DataFrame:
    """Profiles of many tables over many years as one frame: two passes per table, not one run per year."""
    years = sorted({int(y) for y in years})
    parts = [
        measure(df.where(F.col(YEAR).isin(years)), checks_for(specs[name]), as_of, by=YEAR)
        for name, df in tables.items()
    ]
    return metrics_of(parts, years)


def run_quality(
    spark: SparkSession, lake: Lake, years: Iterable[int] = YEARS, tables: Iterable[str] = PROFILED,
    as_of: date | None = None, run_ts: datetime | None = None,
) -> list[Outcome]:
    """Profile stored tables; metrics and error counts are appended to the logs per run."""
    run_ts, years = run_ts or _now(), sorted({int(y) for y in years})
    as_of = as_of or date.today()
    outcomes: list[Outcome] = []
    for name in tables:
        target = f"{lake.log('quality')}/run={run_ts:%Y%m%dT%H%M%S}/{name}"

        def job(name=name, target=target) -> Mapping:
            df = read_table(spark, lake.silver(name), merge_schema=True)
            with shuffles_sized_for(spark, stored_bytes(spark, lake.silver(name))):
                overwrite_table(sweep({name: df}, years, as_of).hint("rebalance"), target)
            stored = spark.read.parquet(target)
            append_rows(errors(stored).select(F.lit(run_ts).alias("run_ts"), "*").hint("rebalance"), lake.log("errors"))
            totals = stored.where("metrica = 'total_rows'").select("ano", "valor").collect()  # one row per year
            return {r["ano"]: int(r["valor"]) for r in totals}

        outcomes += _attempt("quality", name, years, job)
    return log_outcomes(spark, lake, run_ts, outcomes)


def quality_summary(spark: SparkSession, lake: Lake, run_ts: datetime) -> DataFrame:
    """Headline figures of one run, from its stored metrics."""
    return summary(spark.read.parquet(f"{lake.log('quality')}/run={run_ts:%Y%m%dT%H%M%S}/*"))


# Exports ------------------------------------------------------------------------------------------------------


def export_silver(
    spark: SparkSession, lake: Lake, target: str, tables: Iterable[str] | None = None, single_file: bool = False
) -> dict[str, int]:
    """Every cleaned table, all years, as CSV with a header."""
    names = tables or [n for d in ("DFP", "FRE", "FCA", "CAD") for n in tables_of(d)]
    return {
        n: export_table(spark, lake.silver(n), f"{target}/{n}", "csv", single_file, merge_schema=True) for n in names
    }


def export_gold(
    spark: SparkSession, lake: Lake, target: str, facts: Iterable[str] = STANDARD_FACTS, single_file: bool = False
) -> dict[str, int]:
    """Dimensions and facts as Parquet for BI tools."""
    paths = {n: lake.dimension(n) for n in (COMPANY.name, CALENDAR_NAME, SECURITY.name)}
    paths |= {n: lake.fact(n) for n in facts}
    return {n: export_table(spark, p, f"{target}/{n}.parquet", "parquet", single_file) for n, p in paths.items()}
