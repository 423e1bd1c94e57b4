"""ZIP archives of any size as a Spark data source: one partition per wanted member, read by its byte range.

Planning reads the central directories only, the last bytes of each archive, side by side. A task then opens its archive at its
member's place and streams that range through the inflater, so no archive is ever one value, each member is read once, and a
lost task reads its own member again.

Archives are reached through Arrow's file systems (local paths, S3, GCS, HDFS). Where Spark alone knows the file system,
``archives.read_archives`` takes archives that fit one binary value.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import uuid
import zipfile
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as papq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from finlake.sources.archives import (
    LANDED_SCHEMA, UNREADABLE, UTF8, WINDOWS_1252, Wanted, decoded_cells, member_for, member_rows, unreadable,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "zip_members"
#: Directories read at a time while planning.
PLANNERS = 16
#: Text held until it is written as one row group of a file of records.
GROUP_BYTES = 64 << 20
#: The part of a member's local header before its name, where the lengths of name and extra field stand in it,
#: and the flag of an encrypted member.
LOCAL_HEADER, LENGTHS_AT, ENCRYPTED = 30, 26, 0x1
#: Schemes that Arrow reads, by the scheme it knows them under.
SCHEMES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs"}


def scheme_of(path: str) -> str:
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    return found.group(1).lower() if found else ""


def reachable(path: str) -> bool:
    """Whether tasks can read ``path`` without Spark."""
    return scheme_of(path) in SCHEMES


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a path, and the path within it."""
    scheme = scheme_of(path)
    if scheme in ("", "file"):
        return pafs.LocalFileSystem(), re.sub("^file:(//)?", "", path, flags=re.IGNORECASE)
    return pafs.FileSystem.from_uri(SCHEMES[scheme] + path[len(scheme):])


@dataclass
class Member(InputPartition):
    """Where one member lies, and what the directory says about it. An archive without a readable directory has ``error``."""

    wanted: Wanted
    name: str | None = None
    place: int = 0
    method: int = 0
    flags: int = 0
    packed: int = 0
    size: int = 0
    crc: int = 0
    error: str | None = None

    def __post_init__(self):
        super().__init__(self.name)

    def __reduce__(self):
        # By its values alone: this class goes by value, and would go again with every one of many members.
        wanted = None if self.wanted is None else (self.wanted.document, self.wanted.table, self.wanted.year, self.wanted.file)
        values = (self.name, self.place, self.method, self.flags, self.packed, self.size, self.crc, self.error)
        return InputPartition, ((wanted, values),)

    @classmethod
    def of(cls, partition: InputPartition) -> Member:
        """The member that arrived as its values."""
        if isinstance(partition, cls):
            return partition
        wanted, values = partition.value
        return cls(None if wanted is None else Wanted(*wanted), *values)

    def entry(self) -> zipfile.ZipInfo:
        info = zipfile.ZipInfo(self.name)
        info.compress_type, info.flag_bits, info.header_offset = self.method, self.flags, self.place
        info.compress_size, info.file_size, info.CRC = self.packed, self.size, self.crc
        return info


def members(document: str, year: int | None, path: str, stems: Mapping[str, str]) -> list[Member]:
    """The wanted members of one archive, from its directory."""
    try:
        system, inner = file_system(path)
        with system.open_input_file(inner) as file, zipfile.ZipFile(file) as archive:
            found = []
            for table, stem in stems.items():
                name = member_for(archive.namelist(), stem)
                if name is None:
                    continue
                entry = archive.getinfo(name)
                found.append(Member(
                    Wanted(document, table, year, path), name, entry.header_offset, entry.compress_type, entry.flag_bits,
                    entry.compress_size, entry.file_size, entry.CRC,
                ))
            return found
    except UNREADABLE as error:
        return [Member(Wanted(document, table, year, path), error=str(error)) for table in stems]


class Records:
    """A member's records as columns of text in Parquet files below ``folder``, with its year.

    They are decoded as UTF-8 up to the first batch that is not, and as windows-1252 from there on, in another file: a file's name
    ends in the encoding it was read in. Every attempt of a task has files of its own; what the attempt that counted says is read,
    and no other.
    """

    def __init__(self, folder: str, year: int | None):
        self._folder, self._year, self._encoding = folder, year, UTF8
        self._held: list[pa.RecordBatch] = []
        self._bytes, self._writer, self._files = 0, None, []

    def add(self, batch: pa.RecordBatch) -> None:
        """Records whose cells are bytes given as ISO-8859-1."""
        try:
            columns = [decoded_cells(c, self._encoding) for c in batch.columns]
        except UnicodeDecodeError:
            self._end_file()
            self._encoding = WINDOWS_1252
            columns = [decoded_cells(c, self._encoding) for c in batch.columns]
        self._held.append(pa.RecordBatch.from_arrays(columns, names=batch.schema.names))
        self._bytes += batch.nbytes
        if self._bytes >= GROUP_BYTES:
            self._write()

    def _write(self) -> None:
        if not self._held:
            return
        rows = pa.Table.from_batches(self._held)
        rows = rows.append_column("ano", pa.repeat(pa.scalar(self._year, pa.int32()), rows.num_rows))
        if self._writer is None:
            self._files.append(f"{self._folder}/{uuid.uuid4().hex}-{self._encoding}.parquet")
            system, inner = file_system(self._files[-1])
            system.create_dir(inner.rpartition("/")[0])
            self._writer = papq.ParquetWriter(inner, rows.schema, filesystem=system)
        self._writer.write_table(rows)
        self._held, self._bytes = [], 0

    def _end_file(self) -> None:
        self._write()
        if self._writer is not None:
            self._writer.close()
            self._writer = None

    def close(self) -> list[str]:
        """The files written; none without records."""
        self._end_file()
        return self._files


def member_records(member: Member, folder: str | None = None) -> Iterator[pa.RecordBatch]:
    """Landed rows of one member, streamed from its byte range; its records are stored below ``folder`` if given."""
    if member.error is not None:
        yield unreadable(member.wanted, ValueError(member.error))
        return
    try:
        if member.flags & ENCRYPTED:
            raise NotImplementedError("the member is encrypted")
        system, inner = file_system(member.wanted.file)
        with system.open_input_file(inner) as file:
            file.seek(member.place)
            name, extra = struct.unpack_from("<HH", file.read(LOCAL_HEADER), LENGTHS_AT)
            file.seek(member.place + LOCAL_HEADER + name + extra)
            with zipfile.ZipExtFile(file, "r", member.entry()) as raw:
                yield from member_rows(member.wanted, member.name, raw, Records(folder, member.wanted.year) if folder else None)
    except (*UNREADABLE, struct.error) as error:
        yield unreadable(member.wanted, error, member.name)


class ZipMembers(DataSource):
    """Options: ``archives``, a JSON list of [document, year, path]; ``stems``, a JSON object of member stems by document and
    table; ``records``, a folder that tasks store the members' records in, or nothing."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LANDED_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ZipReader(json.loads(self.options["archives"]), json.loads(self.options["stems"]), self.options.get("records"))


class ZipReader(DataSourceReader):
    def __init__(self, archives: list, stems: dict, records: str | None = None):
        self.archives, self.stems, self.records = archives, stems, records

    def partitions(self) -> list[Member]:
        """Members, the largest first, so that none of them begins last."""
        with ThreadPoolExecutor(PLANNERS) as pool:
            found = pool.map(lambda archive: members(*archive, self.stems.get(archive[0], {})), self.archives)
        planned = [member for of_one in found for member in of_one]
        return sorted(planned, key=lambda member: -member.packed) or [Member(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        member = Member.of(partition)
        if member.wanted is not None:
            yield from member_records(member, self.records)


def read_members(
    spark: SparkSession, document: str, paths: Iterable[tuple[int, str]], stems: Mapping[str, str], records: str | None = None
) -> DataFrame:
    """Landed rows of the members ``stems`` (by table) of archives, each given by its year and path. With ``records``, a folder
    that tasks reach, the members' records are stored there as columns when the rows are read."""
    spark.dataSource.register(ZipMembers)
    reader = (
        spark.read.format(FORMAT).option("archives", json.dumps([[document, year, path] for year, path in paths]))
        .option("stems", json.dumps({document: dict(stems)}))
    )
    return (reader.option("records", records) if records else reader).load()
