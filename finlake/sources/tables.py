"""Delimited text, stored tables and the generated calendar."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.functions.dates import calendar_attributes
from finlake.functions.text import quoted
from finlake.sinks.tables import YEAR

# Field separator of the filings and the calendar's first and last day.
SEPARATOR = ";"
CALENDAR_START = date(2019, 1, 1)
CALENDAR_END = date(2030, 12, 31)


def windows_1252_pairs() -> tuple[str, str]:
    """Control characters that ISO-8859-1 gives for bytes 0x80-0x9F, and the windows-1252 letters meant."""
    pairs = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
    pairs = [(latin, letter) for latin, letter in pairs if letter]
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


def column_names(header: Iterable[str]) -> tuple[str, ...]:
    """Header cells as usable column names: blanks are numbered, repeats get a counter."""
    names: list[str] = []
    for i, cell in enumerate(header):
        base, n = cell or f"_c{i}", 0
        name = base
        while name in names:
            n += 1
            name = f"{base}.{n}"
        names.append(name)
    return tuple(names)


def file_encodings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(path, is_utf8, header)`` per file: UTF-8 only if every line is valid UTF-8; the first line that is not blank."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("place"),
    )
    filled = F.when(F.length(F.trim("value")) > 0, F.struct("block", "place"))
    first = F.min_by(F.col("value").cast("binary"), filled)
    return lines.groupBy("path").agg(F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"), first.alias("header"))


def _reader(spark: SparkSession, separator: str, multi_line: bool):
    return (
        spark.read.option("sep", separator).option("header", "true").option("escape", '"')
        .option("multiLine", str(multi_line).lower())
    )


def _decoded(reader, path: str | list[str], is_utf8: bool) -> DataFrame:
    if is_utf8:
        return reader.csv(path)
    latin, letters = windows_1252_pairs()
    raw = reader.option("encoding", "ISO-8859-1").csv(path)
    return raw.select(*[F.translate(quoted(c), latin, letters).alias(c) for c in raw.columns])


def _literal(path: str) -> str:
    """A file's address, as its metadata gives it, as a path that is read as it stands."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(path))


def read_csv(
    spark: SparkSession, path: str | list[str], separator: str = SEPARATOR, encoding: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text with a header, every column a string named by the header of its file.

    Without ``encoding``, a file that is not valid UTF-8 throughout is read as windows-1252. Files are grouped by
    encoding and header, so their columns may come in any order, and each group reads its own files: all are read
    once to be told apart and once for their rows, however many groups there are. The driver sees the names of the
    files, which it lists anyway. Files are split over tasks unless ``multi_line`` is set, which quoted line breaks
    need; such files are expected to share one header.
    """
    if encoding:
        return _reader(spark, separator, multi_line).option("encoding", encoding).csv(path)
    files = file_encodings(spark, path)
    if multi_line:
        plain = files.agg(F.bool_and("is_utf8")).first()[0]
        return _decoded(_reader(spark, separator, True), path, plain is not False)
    groups = files.where("header is not null").groupBy("is_utf8", "header").agg(F.array_sort(F.collect_list("path"))).collect()
    parts = []
    for is_utf8, header, own in groups:
        text = bytes(header).decode("utf-8-sig" if is_utf8 else "cp1252", "replace")
        names = column_names(next(csv.reader([text], delimiter=separator)))
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        reader = _reader(spark, separator, False).schema(schema)
        parts.append(_decoded(reader, path if len(groups) == 1 else list(map(_literal, own)), is_utf8))
    if not parts:
        return _reader(spark, separator, False).csv(path)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_table(
    spark: SparkSession, path: str, year: int | str | None = None, merge_schema: bool = False, schema=None
) -> DataFrame:
    """A stored table, optionally one year of it (read from that year's files only).

    ``merge_schema`` unites the columns of all files by reading their footers; a declared ``schema`` gives the
    same without that pass.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    return df if year is None else df.where(F.col(YEAR) == int(year))


def calendar(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """One row per day with the calendar attributes."""
    days = spark.range(1).select(_days(F.lit(start), F.lit(end)))
    return days.select("data", *[c.alias(n) for n, c in calendar_attributes(F.col("data")).items()])


def calendar_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """The calendar spanning the dates of a one-row frame."""
    days = bounds.select(_days(F.col(first), F.col(last)))
    return days.select("data", *[c.alias(n) for n, c in calendar_attributes(F.col("data")).items()])


def _days(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("data")
