"""Exports for readers outside the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

from finlake.sinks.tables import stored_bytes

ROWS_PER_FILE = 5_000_000


def export_table(
    spark: SparkSession, source: str, target: str, fmt: str, single_file: bool = False,
    rows_per_file: int = ROWS_PER_FILE, merge_schema: bool = False,
) -> int:
    """Copy a stored table to CSV (with header) or Parquet; returns the stored bytes it read.

    Files are written in parallel and none has more than ``rows_per_file`` rows (0: no limit). ``single_file`` passes the
    whole table through one task, for small tables that a reader wants in one piece; the limit then does not apply.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown export format {fmt!r}")
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(source)
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", 0 if single_file else rows_per_file)
    if fmt == "csv":
        writer.option("header", "true").csv(target)
    else:
        writer.parquet(target)
    return stored_bytes(spark, source)
