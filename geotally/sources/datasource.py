"""Readers and a writer behind ``spark.read.format`` and ``df.write.format``: zipped text, and files whose columns drift.

``zipped_csv`` has a partition for each member of each archive, ``drifting_csv`` one for each range of bytes of each file; every byte of
the rows is read once. Filters on the file (and for archives the member) are pushed down and spare whole partitions.
"""

from __future__ import annotations

import csv
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from fnmatch import fnmatch
from itertools import chain

import pyarrow as pa
import pyarrow.csv as pacsv
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from geotally.sources.files import FILE_NAME, SCHEMES

MEMBER = "src_member"
#: Bytes of a range of a file, and of text that is parsed at once.
RANGE, BLOCK = 64 << 20, 4 << 20
#: Archives or files whose lists of members or headers are looked up at once.
LOOKUPS = 16


def resolved(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a path as Spark writes it."""
    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and "://" not in path else path
    scheme, colon, rest = uri.partition("://")
    if not colon:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}{colon}{rest}")


def found_files(path: str, pattern: str) -> list[tuple[str, int]]:
    """(inner path, size) of the files of a folder (or of one file) whose names fit."""
    system, inner = resolved(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    infos = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted((i.path, i.size) for i in infos if i.type == fs.FileType.File and fnmatch(i.base_name, pattern))


class _Named:
    """Filters on text columns that are known before a partition is read."""

    def __init__(self, names: Sequence[str]) -> None:
        self.names = names
        self.tests: list = []

    def push(self, filters: Iterable[Filter]) -> Iterator[Filter]:
        """Keep the filters that partitions can answer; hand the others back."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            test = {
                EqualTo: lambda v, f=f: v == f.value,
                In: lambda v, f=f: v in f.value,
                StringStartsWith: lambda v, f=f: v.startswith(f.value),
                StringEndsWith: lambda v, f=f: v.endswith(f.value),
                StringContains: lambda v, f=f: f.value in v,
            }.get(type(f))
            if name in self.names and test:
                self.tests.append((name, test))
            else:
                yield f

    def wanted(self, **values: str) -> bool:
        """Whether what is known so far passes; a test of a name that is not known yet does not count."""
        return all(test(values[name]) for name, test in self.tests if name in values)


def _convert(columns: StructType, sep: str) -> tuple[pacsv.ParseOptions, pacsv.ConvertOptions]:
    types = {f.name: t.type for f, t in zip(columns.fields, to_arrow_schema(columns), strict=True)}
    return (
        pacsv.ParseOptions(delimiter=sep, double_quote=True, newlines_in_values=True),
        pacsv.ConvertOptions(column_types=types, strings_can_be_null=True, quoted_strings_can_be_null=False, null_values=[""]),
    )


def _with_text(batch: pa.RecordBatch, schema: StructType, more: dict[str, str]) -> pa.RecordBatch:
    """``batch`` in the order of ``schema``, with columns of one text each; columns that a file does not have are null."""
    arrays = []
    for field, arrow in zip(schema.fields, to_arrow_schema(schema), strict=True):
        if field.name in more:
            arrays.append(pa.array([more[field.name]] * batch.num_rows, pa.string()))
        elif field.name in batch.schema.names:
            arrays.append(batch.column(field.name).cast(arrow.type))
        else:
            arrays.append(pa.nulls(batch.num_rows, arrow.type))
    return pa.RecordBatch.from_arrays(arrays, schema.names)


@dataclass
class MemberPartition(InputPartition):
    archive: str
    member: str


class ZippedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.options = schema, dict(options)
        self.named = _Named((FILE_NAME, MEMBER))
        self.columns = StructType([f for f in schema.fields if f.name not in (FILE_NAME, MEMBER)])

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        return list(self.named.push(filters))

    def _members(self, archive: str) -> list[MemberPartition]:
        if not self.named.wanted(**{FILE_NAME: archive}):
            return []
        system, _ = resolved(self.options["path"])
        suffix = self.options.get("suffix", ".csv")
        # Only the list at the end of the archive is read here.
        with system.open_input_file(archive) as stream, zipfile.ZipFile(stream) as zipped:
            names = [n for n in zipped.namelist() if n.lower().endswith(suffix)]
        return [MemberPartition(archive, n) for n in names if self.named.wanted(**{FILE_NAME: archive, MEMBER: n})]

    def partitions(self) -> Sequence[InputPartition]:
        archives = [p for p, _ in found_files(self.options["path"], self.options.get("pattern", "*.zip"))]
        with ThreadPoolExecutor(LOOKUPS) as pool:
            found = [m for members in pool.map(self._members, archives) for m in members]
        return found or [MemberPartition("", "")]

    def read(self, partition: MemberPartition) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        system, _ = resolved(self.options["path"])
        parse, convert = _convert(self.columns, self.options.get("sep", ","))
        more = {FILE_NAME: partition.archive, MEMBER: partition.member}
        with system.open_input_file(partition.archive) as stream, zipfile.ZipFile(stream) as zipped, zipped.open(partition.member) as text:
            batches = pacsv.open_csv(text, pacsv.ReadOptions(block_size=BLOCK), parse, convert)
            if batches.schema.names != self.columns.names:
                raise ValueError(f"{partition.archive}!{partition.member} has columns {batches.schema.names}, not {self.columns.names}")
            for batch in batches:
                yield _with_text(batch, self.schema, more)


@dataclass
class Written(WriterCommitMessage):
    path: str


class ZippedWriter(DataSourceArrowWriter):
    """One archive of one member for each task that has rows. Archives count once all are there: until then they have another name."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool) -> None:
        self.schema, self.options, self.overwrite = schema, dict(options), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        first = next(iterator, None)
        if first is None:
            return Written("")
        context = TaskContext.get()
        system, folder = resolved(self.options["path"])
        system.create_dir(folder, recursive=True)
        # Another attempt at the same part writes a file of its own, and only that of the attempt that counts is renamed.
        name = f"part-{context.partitionId():05}"
        path = f"{folder}/{name}.zip.{context.taskAttemptId()}.tmp"
        options = pacsv.WriteOptions(delimiter=self.options.get("sep", ","))
        with system.open_output_stream(path) as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as zipped:
            with zipped.open(f"{name}.csv", "w", force_zip64=True) as member, pacsv.CSVWriter(member, first.schema, write_options=options) as out:
                for batch in chain([first], iterator):
                    out.write_batch(batch)
        return Written(path)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, folder = resolved(self.options["path"])
        if self.overwrite and system.get_file_info(folder).type == fs.FileType.Directory:
            for info in system.get_file_info(fs.FileSelector(folder)):
                if info.base_name.endswith(".zip"):
                    system.delete_file(info.path)
        for m in messages:
            if m and m.path:
                system.move(m.path, m.path.rsplit(".", 2)[0])

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _ = resolved(self.options["path"])
        for m in messages:
            if m and m.path:
                system.delete_file(m.path)


class ZippedCsv(DataSource):
    """Options: path, pattern of archives, suffix of members, sep. The schema is given; it may have the file and the member."""

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def schema(self) -> str:
        raise ValueError("zipped_csv needs a schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return ZippedReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ZippedWriter(schema, self.options, overwrite)


@dataclass
class RangePartition(InputPartition):
    path: str
    first: int
    end: int
    header: tuple[str, ...]
    body: int


class DriftingReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.options = schema, dict(options)
        self.sep = self.options.get("sep", ",")
        self.ids = [c.strip() for c in self.options["ids"].split("|")]
        self.named = _Named((FILE_NAME,))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        return list(self.named.push(filters))

    def partitions(self) -> Sequence[InputPartition]:
        size = int(self.options.get("range", RANGE))
        files = found_files(self.options["path"], self.options.get("pattern", "*.csv"))
        wanted = [(p, n) for p, n in files if self.named.wanted(**{FILE_NAME: p})]
        found = []
        for (path, length), (names, body) in zip(wanted, headers(self.options["path"], [p for p, _ in wanted], self.sep, self.ids), strict=True):
            found += [RangePartition(path, at, min(at + size, length), names, body) for at in range(body, length, size)]
        return found or [RangePartition("", 0, 0, (), 0)]

    def read(self, partition: RangePartition) -> Iterator[pa.RecordBatch]:
        """The lines that begin in the range. The line at its end is read on; a line that began before it is another range's."""
        if not partition.path:
            return
        system, _ = resolved(self.options["path"])
        with system.open_input_file(partition.path) as stream:
            text = _lines_of(stream, partition)
            kinds = {f.name: f for f in self.schema.fields}
            own = StructType([kinds.get(n, StructField(n, DoubleType())) for n in partition.header])
            parse, convert = _convert(own, self.sep)
            parse.newlines_in_values = False
            for block in text:
                read = pacsv.ReadOptions(column_names=list(partition.header), block_size=len(block) + 1)
                table = pacsv.read_csv(pa.BufferReader(block), read, parse, convert)
                for batch in table.to_batches():
                    yield from self._rows(batch, partition)

    def _rows(self, batch: pa.RecordBatch, partition: RangePartition) -> Iterator[pa.RecordBatch]:
        yield _with_text(batch, self.schema, {FILE_NAME: partition.path})


class DriftingLongReader(DriftingReader):
    """A row for each value that is there: the ids, the ``station``, its ``value`` and the file."""

    def _rows(self, batch: pa.RecordBatch, partition: RangePartition) -> Iterator[pa.RecordBatch]:
        for name in partition.header:
            if name not in self.ids:
                values = batch.column(name)
                there = values.is_valid()
                part = batch.select(self.ids).filter(there)
                columns = [*part.columns, values.filter(there).cast(pa.float64())]
                long = pa.RecordBatch.from_arrays(columns, [*self.ids, "value"])
                yield _with_text(long, self.schema, {"station": name, FILE_NAME: partition.path})


def _lines_of(stream, partition: RangePartition) -> Iterator[bytes]:
    """Whole lines, some at once, that begin at ``first`` or later and before ``end``."""
    at, held = partition.first, b""
    if at > partition.body:
        # The byte before the range tells whether a line begins at its first byte.
        stream.seek(at - 1)
        at -= 1
        while True:
            block = stream.read(4096)
            end = block.find(b"\n")
            at += len(block) if end < 0 else end + 1
            if end >= 0 or not block:
                break
    stream.seek(at)
    while at < partition.end:
        block = stream.read(min(BLOCK, partition.end - at))
        if not block:
            break
        at += len(block)
        held += block
        cut = held.rfind(b"\n") + 1
        if cut and held[:cut].strip():
            yield held[:cut]
        held = held[cut:]
    if held:
        while not held.endswith(b"\n"):
            more = stream.read(4096)
            if not more:
                break
            end = more.find(b"\n")
            held += more if end < 0 else more[: end + 1]
        if held.strip():
            yield held


def headers(path: str, files: Sequence[str], sep: str, ids: Sequence[str]) -> list[tuple[tuple[str, ...], int]]:
    """(column names, first byte after them) of each file, from its first bytes only."""
    system, _ = resolved(path)

    def one(file: str) -> tuple[tuple[str, ...], int]:
        with system.open_input_file(file) as stream:
            head = b""
            while b"\n" not in head:
                more = stream.read(4096)
                if not more:
                    break
                head += more
        line, end, _ = head.partition(b"\n")
        names = tuple(next(csv.reader([line.decode("utf-8-sig").rstrip("\r")], delimiter=sep), []))
        missing = [c for c in ids if c not in names]
        if missing:
            raise ValueError(f"{file} has no column {', '.join(missing)}")
        return names, len(line) + len(end)

    with ThreadPoolExecutor(LOOKUPS) as pool:
        return list(pool.map(one, files))


class DriftingCsv(DataSource):
    """Options: path, pattern, sep, ``ids`` (columns that all files have, parted by |) and ``range`` (bytes of a partition).

    Without a schema the columns are the ids as text, all others of any file as numbers, and the file.
    """

    @classmethod
    def name(cls) -> str:
        return "drifting_csv"

    def schema(self) -> StructType:
        options, sep = self.options, self.options.get("sep", ",")
        ids = [c.strip() for c in options["ids"].split("|")]
        files = [p for p, _ in found_files(options["path"], options.get("pattern", "*.csv"))]
        if not files:
            raise FileNotFoundError(f"no files in {options['path']}")
        others = sorted({n for names, _ in headers(options["path"], files, sep, ids) for n in names} - set(ids))
        fields = [StructField(n, StringType()) for n in ids] + [StructField(n, DoubleType()) for n in others]
        return StructType([*fields, StructField(FILE_NAME, StringType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return DriftingReader(schema, self.options)


class DriftingLongCsv(DriftingCsv):
    """The same files with a row for each value; without a schema the ids are text."""

    @classmethod
    def name(cls) -> str:
        return "drifting_csv_long"

    def schema(self) -> StructType:
        ids = [StructField(c.strip(), StringType()) for c in self.options["ids"].split("|")]
        more = [("station", StringType()), ("value", DoubleType()), (FILE_NAME, StringType())]
        return StructType([*ids, *(StructField(n, t) for n, t in more)])

    def reader(self, schema: StructType) -> DataSourceReader:
        return DriftingLongReader(schema, self.options)


def register(spark: SparkSession) -> None:
    """Make the formats known to the session, and let it push filters to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (ZippedCsv, DriftingCsv, DriftingLongCsv):
        spark.dataSource.register(source)
