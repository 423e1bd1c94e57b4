"""Unpacking ZIP archives into landed rows, and reading landed rows back as tables.

A member of an archive cannot be split, so one task unpacks it, streaming: it is inflated once, parsed in bounded
batches and never held whole. Whether a member is UTF-8 is known at its end only, so its rows land byte for byte (as
ISO-8859-1) and are decoded when they are read, by the encoding that its last record names. Where tasks reach the landing
folder by themselves, they store a member's records as columns of text in files of its own, and only its header, its last
record, which names those files, and its defects are landed rows; a file that was taken for UTF-8 before its member turned out
not to be is decoded anew. Everything after landing is ordinary columnar data that splits freely.
"""

from __future__ import annotations

import codecs
import csv
import io
import re
import sys
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.session import unsorted_writes
from finlake.sources.bronze import PATH_PARTS
from finlake.sources.tables import SEPARATOR, column_names, windows_1252_pairs

# Tasks get these functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Largest archive that fits one binary value; a larger one needs a file system that tasks read by themselves.
ARCHIVE_BYTES = (1 << 31) - 1
#: Files of one landing task that may be open at a time; rows come table by table and year by year.
LANDING_FILES = 8
HEADER_MARK = "\x1f"
BLOCK_BYTES = 8 << 20
#: Row number of a member's last record, which names its encoding, one of these, and the files of its records if it has any.
LAST = -1
ASCII, UTF8, WINDOWS_1252 = "ascii", "utf-8", "windows-1252"

#: Windows-1252 letters by the code point that ISO-8859-1 gives for their byte.
LETTERS = str.maketrans(*windows_1252_pairs())

LANDED_SCHEMA = (
    "documento string, tabela string, ano int, arquivo string, membro string, cabecalho string, linha bigint, "
    "campos array<string>, codificacao string, defeito string"
)
_LANDED_ARROW = pa.schema([
    ("documento", pa.string()), ("tabela", pa.string()), ("ano", pa.int32()), ("arquivo", pa.string()),
    ("membro", pa.string()), ("cabecalho", pa.string()), ("linha", pa.int64()), ("campos", pa.list_(pa.string())),
    ("codificacao", pa.string()), ("defeito", pa.string()),
])


@dataclass(frozen=True)
class Wanted:
    """One member of one archive, and the table it belongs to."""

    document: str
    table: str
    year: int | None
    file: str


@dataclass(frozen=True, order=True)
class Layout:
    """Columns of landed members that are read alike: their header as it landed, their names, and their encoding."""

    header: str
    columns: tuple[str, ...]
    encoding: str


def member_for(names: Iterable[str], stem: str) -> str | None:
    """The archive entry ``stem.csv`` or ``stem_<year>.csv`` in any folder; a longer sibling does not count."""
    wanted = re.compile(rf"(^|/){re.escape(stem)}(_\d{{4}})?\.csv$")
    return next((n for n in names if wanted.search(n)), None)


class Watched(io.RawIOBase):
    """A stream that finds out, as it is read, whether its bytes are ASCII or else valid UTF-8."""

    def __init__(self, raw: zipfile.ZipExtFile):
        self._raw = raw
        self._decoder = codecs.getincrementaldecoder("utf-8")()
        self._ascii = self._utf8 = True

    def _seen(self, data: bytes, final: bool = False) -> bytes:
        if self._utf8 and not (self._ascii and data.isascii()):
            self._ascii = self._ascii and not data
            try:
                self._decoder.decode(data, final)
            except UnicodeDecodeError:
                self._utf8 = False
        return data

    def readable(self) -> bool:
        return True

    def read(self, size: int = -1) -> bytes:
        return self._seen(self._raw.read(size))

    def readline(self, size: int = -1) -> bytes:
        return self._seen(self._raw.readline(size))

    def peek(self, size: int = 1) -> bytes:
        return self._raw.peek(size)

    def encoding(self) -> str:
        """The encoding of all that was read."""
        self._seen(b"", final=True)
        return ASCII if self._ascii else UTF8 if self._utf8 else WINDOWS_1252


def cell_names(width: int) -> list[str]:
    """Names of a record's cells while they are not decoded."""
    return [f"f{i}" for i in range(width)]


def _header(raw: Watched) -> tuple[list[str], bool]:
    """Column names as they land, and whether any record follows; the stream is left right behind the header record.

    Blank lines before the header are passed over, and quoted line breaks belong to it.
    """
    record = b""
    while line := raw.readline():
        record += line
        if record.count(b'"') % 2:
            continue
        text = record.removeprefix(codecs.BOM_UTF8).decode("latin-1")
        names = next(csv.reader(io.StringIO(text, newline=""), delimiter=SEPARATOR), [])
        if names:
            break
        record = b""
    else:
        return [], False
    while (ahead := raw.peek(1)[:1]) and ahead in b"\r\n":
        raw.read(1)
    return names, bool(ahead)


def _rows_of(batch: pa.RecordBatch) -> pa.ListArray:
    """The columns of a batch as one array of fields per row."""
    n, width = batch.num_rows, batch.num_columns
    by_row = np.arange(n * width).reshape(width, n).T.ravel()
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, n * width + 1, width), pa.int32()), pa.concat_arrays(batch.columns).take(pa.array(by_row))
    )


def _padded(rows: list[list[str]], width: int) -> pa.RecordBatch:
    """Short records as columns, the cells they lack NULL; a record longer than that is cut, and is a defect."""
    columns = [pa.array([r[i] if i < len(r) else None for r in rows], pa.string()) for i in range(width)]
    return pa.RecordBatch.from_arrays(columns, names=cell_names(width))


def _parsed(raw: Watched, header: list[str]) -> Iterator[tuple[pa.RecordBatch | list[list[str]], list[str | None] | None]]:
    """Records behind the header: those of its length as columns, others as lists of their fields with the defects they have.

    A short record keeps the fields it has. A record longer than the header is a defect.
    """
    uneven: list[list[str]] = []

    def kept() -> tuple[list[list[str]], list[str | None]]:
        defects = [f"{len(r)} fields for {len(header)} columns" if len(r) > len(header) else None for r in uneven]
        rows = list(uneven)
        uneven.clear()
        return rows, defects

    def keep_uneven(row: pacsv.InvalidRow) -> str:
        uneven.append(next(csv.reader(io.StringIO(row.text, newline=""), delimiter=SEPARATOR), []))
        return "skip"

    names = cell_names(len(header))
    read = pacsv.ReadOptions(use_threads=False, block_size=BLOCK_BYTES, column_names=names, encoding="latin-1")
    parse = pacsv.ParseOptions(delimiter=SEPARATOR, newlines_in_values=True, invalid_row_handler=keep_uneven)
    text = pacsv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False)
    for batch in pacsv.open_csv(pa.PythonFile(raw, mode="r"), read, parse, text):
        if batch.num_rows:
            yield batch, None
        if uneven:
            yield kept()
    if uneven:
        yield kept()


def _landed(wanted: Wanted, member, header, first, fields, defects=None, encoding=None) -> pa.RecordBatch:
    n = len(fields)
    same = lambda value: pa.repeat(pa.scalar(value, pa.string()), n)
    columns = [
        same(wanted.document), same(wanted.table), pa.repeat(pa.scalar(wanted.year, pa.int32()), n), same(wanted.file),
        same(member), same(header), pa.array(np.arange(first, first + n), pa.int64()), fields, same(encoding),
        pa.array(defects, pa.string()) if defects else pa.nulls(n, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_LANDED_ARROW)


_EMPTY = pa.array([[]], pa.list_(pa.string()))
#: What an archive or member that cannot be read raises.
UNREADABLE = (
    zipfile.BadZipFile, zlib.error, csv.Error, pa.ArrowInvalid, EOFError, OSError, ValueError, NotImplementedError, RuntimeError,
)


def unreadable(wanted: Wanted, error: Exception, member: str | None = None, header: str = "", line: int = 1) -> pa.RecordBatch:
    """The record of a member, or a whole archive, that cannot be read: a defect of that table and year alone."""
    what = "unreadable" if member else "unreadable archive"
    return _landed(wanted, member, header, max(line, 1), _EMPTY, [f"{what}: {error}"])


def member_rows(wanted: Wanted, member: str, raw: zipfile.ZipExtFile, records=None) -> Iterator[pa.RecordBatch]:
    """Landed rows of one member, read once from its beginning to its end.

    With ``records``, which takes batches of columns and gives the files they are in when it is closed, its records go there.
    """
    line, key = 0, ""
    try:
        watched = Watched(raw)
        header, more = _header(watched)
        key = HEADER_MARK.join(header)
        if header:
            yield _landed(wanted, member, key, 0, pa.array([header], pa.list_(pa.string())))
        line = 1
        for rows, defects in _parsed(watched, header) if more else ():
            if records is not None:
                records.add(rows if isinstance(rows, pa.RecordBatch) else _padded(rows, len(header)))
                for i, defect in enumerate(defects or ()):
                    if defect:
                        yield _landed(wanted, member, key, line + i, _EMPTY, [defect])
            else:
                fields = _rows_of(rows) if isinstance(rows, pa.RecordBatch) else pa.array(rows, pa.list_(pa.string()))
                yield _landed(wanted, member, key, line, fields, defects)
            line += len(rows)
        if header:
            files = pa.array([records.close()], pa.list_(pa.string())) if records is not None else _EMPTY
            yield _landed(wanted, member, key, LAST, files, encoding=watched.encoding())
    except UNREADABLE as error:
        yield unreadable(wanted, error, member, key, line)


def _unpack_one(wanted: Wanted, content, stem: str) -> Iterator[pa.RecordBatch]:
    try:
        with zipfile.ZipFile(pa.BufferReader(content)) as archive:
            member = member_for(archive.namelist(), stem)
            if member is not None:
                with archive.open(member) as raw:
                    yield from member_rows(wanted, member, raw)
    except UNREADABLE as error:
        yield unreadable(wanted, error)


def unpack(archives: DataFrame, stems: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Rows of the wanted members of every archive.

    ``archives`` has ``documento, ano, content`` and may name its ``arquivo``; ``stems`` maps a document type to its tables and member stems. Each
    table reads the archives by itself, so members are unpacked side by side. Row 0 of a member is its header, which
    every row names. Rows that cannot be trusted carry ``defeito``.
    """
    wanted = [(document, table, stem) for document, tables in stems.items() for table, stem in tables.items()]

    def unpack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                document, table, year, file, stem = (batch[c][i].as_py() for c in ("documento", "tabela", "ano", "arquivo", "stem"))
                yield from _unpack_one(Wanted(document, table, year, file), batch["content"][i].as_buffer(), stem)

    file = F.col("arquivo") if "arquivo" in archives.columns else F.lit("")
    parts = [
        archives.where(F.col("documento") == document)
        .select("documento", "ano", "content", file.alias("arquivo"), F.lit(table).alias("tabela"), F.lit(stem).alias("stem"))
        for document, table, stem in wanted
    ]
    return reduce(DataFrame.unionByName, parts).mapInArrow(unpack_batches, LANDED_SCHEMA)


def read_archives(spark: SparkSession, document: str, paths: Iterable[str]) -> DataFrame:
    """``documento, ano, arquivo, content`` of known archives of at most ``ARCHIVE_BYTES``, the year taken from the path; no other file is opened."""
    files = spark.read.format("binaryFile").load(list(paths))
    year = F.regexp_extract("path", PATH_PARTS["ano"], 1).cast("int")
    return files.select(F.lit(document).alias("documento"), year.alias("ano"), F.col("path").alias("arquivo"), "content")


def land(landed: DataFrame, path: str) -> None:
    """Store unpacked rows, one folder per table and year, replacing those that arrive. Rows are stored as they come."""
    with unsorted_writes(landed.sparkSession, LANDING_FILES):
        (
            landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("tabela", "ano").parquet(path)
        )


def _decoded(cell: Column, encoding: Column | str) -> Column:
    """The text of a cell that landed byte for byte. One of ASCII alone, as most are, is the same in every encoding."""
    latin, letters = windows_1252_pairs()
    plain = F.when(F.octet_length(cell) == F.length(cell), cell)
    by = {
        UTF8: plain.otherwise(F.decode(F.encode(cell, "ISO-8859-1"), "UTF-8")),
        WINDOWS_1252: plain.otherwise(F.translate(cell, latin, letters)), ASCII: cell,
    }
    if isinstance(encoding, str):
        return by[encoding]
    return F.when(encoding == UTF8, by[UTF8]).when(encoding == WINDOWS_1252, by[WINDOWS_1252]).otherwise(cell)


def decoded_cells(cells: pa.Array, encoding: str) -> pa.Array:
    """The text of a batch's cells that are bytes given as ISO-8859-1; each distinct one is decoded once."""
    if pc.sum(pc.binary_length(cells)).as_py() == pc.sum(pc.utf8_length(cells)).as_py():
        return cells
    found = cells.dictionary_encode()
    text = (
        [v.encode("latin-1").decode(UTF8) for v in found.dictionary.to_pylist()] if encoding == UTF8
        else [v.translate(LETTERS) for v in found.dictionary.to_pylist()]
    )
    return pa.array(text, pa.string()).take(found.indices)


def _decoded_anew(cell: Column) -> Column:
    """The windows-1252 text of a cell that was read as UTF-8."""
    return F.when(F.octet_length(cell) == F.length(cell), cell).otherwise(
        _decoded(F.decode(F.encode(cell, "UTF-8"), "ISO-8859-1"), WINDOWS_1252)
    )


def landed_status(landed: DataFrame) -> DataFrame:
    """Header, encoding, files of records and defect per table, year, archive and header. Reads header, last and flagged
    records only."""
    flagged = landed.where((F.col("linha") <= 0) | F.col("defeito").isNotNull())
    per_member = flagged.groupBy("tabela", "ano", "arquivo", "cabecalho").agg(
        F.max(F.when(F.col("linha") == 0, F.col("campos"))).alias("colunas"), F.max("codificacao").alias("codificacao"),
        F.count_distinct("codificacao").alias("codificacoes"), F.max("defeito").alias("defeito"),
        F.flatten(F.collect_list(F.when(F.col("linha") == LAST, F.col("campos")))).alias("registros"),
    )
    names = F.transform("colunas", lambda cell: _decoded(cell, F.col("codificacao")))
    mixed = F.when(F.col("codificacoes") > 1, F.lit("members in two encodings"))
    return per_member.select(
        "tabela", "ano", "arquivo", "cabecalho", names.alias("colunas"), "codificacao", F.coalesce("defeito", mixed).alias("defeito"),
        "registros",
    )


def landed_table(landed: DataFrame, table: str, layout: Layout, parts: Iterable[tuple[int, str, Sequence[str]]]) -> DataFrame:
    """Landed rows of one table from the members of this layout in the given years and archives, as strings plus
    ``ano_referencia``. Records in files of their own are read from those files, which the members' last records name."""
    parts, names = list(parts), column_names(layout.columns)
    files = sorted({path for _, _, own in parts for path in own})

    def named(rows: DataFrame, cells: Iterable[Column]) -> DataFrame:
        return rows.select(*[cell.alias(name) for cell, name in zip(cells, names)], F.col("ano").alias("ano_referencia"))

    if not files:
        rows = landed.where(
            (F.col("tabela") == table) & F.col("ano").isin(sorted({int(y) for y, *_ in parts})) & (F.col("linha") > 0)
            & (F.col("cabecalho") == layout.header) & F.col("arquivo").isin(sorted({f for _, f, _ in parts}))
        )
        return named(rows, [_decoded(F.get("campos", F.lit(i)), layout.encoding) for i in range(len(names))])
    anew = [path for path in files if layout.encoding == WINDOWS_1252 and path.endswith(f"-{UTF8}.parquet")]
    schema = ", ".join([f"{cell} string" for cell in cell_names(len(names))] + ["ano int"])
    read = [
        named(landed.sparkSession.read.schema(schema).parquet(*own), [text(F.col(c)) for c in cell_names(len(names))])
        for own, text in ((sorted(set(files).difference(anew)), lambda cell: cell), (anew, _decoded_anew)) if own
    ]
    return reduce(DataFrame.unionByName, read)
