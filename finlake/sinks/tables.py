"""Idempotent table writes on plain Parquet folders, each counting its rows inside the writing job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

YEAR = "ano_referencia"


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether anything matches a path or glob on the session's file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return bool(found)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes stored below the paths, from the file system's own summary; absent paths count nothing."""
    total = 0
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders that exist."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_columns(spark: SparkSession, path: str) -> set[str]:
    """Columns of the files in one folder, from the footer of the first of them; no job is run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    files = folder.getFileSystem(conf).globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "*.parquet"))
    if not files:
        raise FileNotFoundError(f"{path} holds no files")
    parquet = spark._jvm.org.apache.parquet
    reader = parquet.hadoop.ParquetFileReader.open(parquet.hadoop.util.HadoopInputFile.fromStatus(files[0], conf))
    try:
        return {field.getName() for field in reader.getFileMetaData().getSchema().getFields()}
    finally:
        reader.close()


def stored_years(spark: SparkSession, path: str, year: str = YEAR) -> set[int]:
    """The years a partitioned table has a folder for, from one listing."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{year}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names = [status.getPath().getName().partition("=")[2] for status in found]
    return {int(name) for name in names if name.lstrip("-").isdigit()}


def years_in(df: DataFrame, year: str = YEAR) -> list[int]:
    """The years that occur in ``df`` (one short row per year comes to the driver)."""
    return sorted(r[0] for r in df.select(F.col(year).cast("int")).distinct().collect() if r[0] is not None)


def layout(spark: SparkSession, path: str, year: str = YEAR) -> str:
    """``absent``, ``by_year`` or ``flat``."""
    if path_exists(spark, f"{path}/{year}=*"):
        return "by_year"
    return "flat" if path_exists(spark, f"{path}/*.parquet") else "absent"


def overwrite_table(df: DataFrame, path: str) -> int:
    """Replace an unpartitioned table; returns the rows written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def append_rows(df: DataFrame, path: str) -> int:
    """Add rows to an unpartitioned table; returns the rows written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return seen.get["rows"]


def replace_years(
    df: DataFrame, path: str, years: Iterable[int], year: str = YEAR, rebalance: bool = True
) -> dict[int, int]:
    """Replace exactly ``years`` of a table partitioned by year; returns the rows written per year.

    One job writes all years and counts them, at one comparison per row and year. A row of any other year fails the
    job. A year that came out empty is cleared, and an unpartitioned table at ``path`` is replaced as a whole. Without
    years nothing is replaced; a table that is absent becomes an empty one.
    ``rebalance`` spends one exchange on even files (a hot year is split over many tasks); leave it off when the input
    already comes in whole files per year.
    """
    spark = df.sparkSession
    years = sorted({int(y) for y in years})
    wanted = F.col(year).isin(years) if years else F.lit(False)
    rows = df.withColumn(year, F.col(year).cast("int")).where(
        F.assert_true(F.coalesce(wanted, F.lit(False)), "row outside the replaced years").isNull()
    )
    if rebalance:
        rows = rows.hint("rebalance", year)
    before = stored_years(spark, path, year)
    flat = not before and path_exists(spark, f"{path}/*.parquet")
    if not years:
        rows.write.format("noop").mode("overwrite").save()  # a row, of whatever year, fails the job
        if not before and not path_exists(spark, f"{path}/*.parquet"):
            spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(path)
        return {}
    seen = Observation()
    (
        rows.observe(seen, *[F.count_if(F.col(year) == y).alias(str(y)) for y in years])
        .write.mode("overwrite").option("partitionOverwriteMode", "static" if flat else "dynamic")
        .partitionBy(year).parquet(path)
    )
    written = {int(y): n for y, n in seen.get.items()}
    filled = {y for y, n in written.items() if n}
    stale = before.intersection(years) - filled
    remove(spark, *[f"{path}/{year}={y}" for y in sorted(stale)])
    if not filled and not before - stale:
        # A table without any row still needs its columns on file.
        spark.createDataFrame([], df.drop(year).schema).write.mode("overwrite").parquet(f"{path}/{year}={years[0]}")
    return written


def migrate_to_years(spark: SparkSession, source: str, target: str, years: Iterable[int], year: str = YEAR) -> dict:
    """Rewrite an unpartitioned table at ``source`` as one partitioned by year at ``target``, keeping its rows."""
    if layout(spark, source, year) != "flat":
        raise ValueError(f"{source} is not an unpartitioned table")
    return replace_years(spark.read.parquet(source), target, years, year)
