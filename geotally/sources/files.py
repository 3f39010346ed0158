"""Delimited text files, zipped text files and file listings."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from geotally.schemas import NUMBER

FILE_NAME = "src_filename"
ROWS_PER_BATCH = 20_000
# Names under which other readers know the stores that Spark names so.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def text_options(sep: str) -> dict[str, str]:
    """Quotes inside quotes are doubled, and malformed rows stop the job."""
    return {"sep": sep, "escape": '"', "mode": "FAILFAST"}


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    sep: str = ",",
    header: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """Delimited text with a known schema and each row's file.

    Header names are checked against the schema, and a malformed row stops the job. ``multiline``
    allows line breaks inside quotes; each file is then read by one task.
    """
    rows = (
        spark.read.schema(schema)
        .options(**text_options(sep))
        .option("header", header)
        .option("enforceSchema", not header)
        .option("multiLine", multiline)
        .csv(path)
    )
    return rows.select("*", F.col("_metadata.file_path").alias(FILE_NAME))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, length and change time of files; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return files.load(path).select("path", "length", "modificationTime")


def rows_per_file(df: DataFrame) -> DataFrame:
    """Number of rows by file name, for a frame read from files."""
    name = F.substring_index(F.col("_metadata.file_path"), "/", -1)
    return df.groupBy(name.alias("file_name")).agg(F.count(F.lit(1)).alias("n_rows"))


def _open(path: str):
    """Seekable byte stream of a path as Spark lists it."""
    from pyarrow import fs

    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and "://" not in path else path
    scheme, colon, rest = uri.partition("://")
    uri = f"{SCHEMES.get(scheme, scheme)}{colon}{rest}" if colon else uri
    filesystem, inner = fs.FileSystem.from_uri(uri)
    return filesystem.open_input_file(inner)


def cells_of(line: Column, sep: str) -> Column:
    """Cells of a line; separators inside quotes do not count, and quotes inside quotes are doubled."""
    plain = re.escape(sep)
    outside = plain + r'(?=(?:[^"]*"[^"]*")*[^"]*$)'
    unquoted = F.transform(
        F.split(line, outside), lambda c: F.replace(F.regexp_replace(c, r'^\s*"|"\s*$', ""), F.lit('""'), F.lit('"'))
    )
    return F.when(line.contains('"'), unquoted).otherwise(F.split(line, plain))


def _named_cells(spark: SparkSession, path: str, ids: StructType, sep: str, pattern: str) -> tuple[DataFrame, DataFrame]:
    """(file, cells by column name) of each row of the files, and (file, names) of their headers.

    A header is a line that holds all names of ``ids``. Rows meet the header of their file in a join, so
    nothing is fetched per file and the plan has as many scans as sides, not files.
    """
    text = spark.read.option("pathGlobFilter", pattern).text(path)
    line = F.regexp_replace("value", "^\ufeff", "").alias("line")
    lines = text.select(F.col("_metadata.file_path").alias(FILE_NAME), line).where("line <> ''")
    parted = lines.select(FILE_NAME, cells_of(F.col("line"), sep).alias("cells"))
    is_header = F.forall(F.array(*map(F.lit, ids.names)), lambda name: F.array_contains("cells", name))
    headers = parted.where(is_header).groupBy(F.col(FILE_NAME).alias("_file")).agg(F.min("cells").alias("names"))
    rows = parted.where(~is_header).join(headers, F.col(FILE_NAME) == F.col("_file"), "left").drop("_file")
    wrong = F.raise_error(F.concat(F.lit("no header for, or cells too many or too few, in a row of "), FILE_NAME))
    fits = F.coalesce(F.size("names") == F.size("cells"), F.lit(False))
    return rows.select(FILE_NAME, F.when(fits, F.map_from_arrays("names", "cells")).otherwise(wrong).alias("cells")), headers


def _typed(cells: Column, name: str | Column, kind: DataType) -> Column:
    """Cell of a name; blank cells and those of other files are null, and malformed ones stop the job."""
    return F.nullif(F.trim(F.element_at(cells, name if isinstance(name, Column) else F.lit(name))), F.lit("")).cast(kind)


def read_drifting(
    spark: SparkSession, path: str, ids: StructType, value_type: DataType = NUMBER, sep: str = ",", pattern: str = "*.csv"
) -> DataFrame:
    """Files of one kind whose value columns differ from file to file, as one frame by column name.

    ``ids`` are the columns all files share; every other column is a value of ``value_type``. Spark reads
    the lines, so any path works that it can read. Only the distinct column names come to the driver.
    """
    rows, headers = _named_cells(spark, path, ids, sep, pattern)
    names = sorted(r[0] for r in headers.select(F.explode("names")).distinct().collect())
    if not names:
        raise FileNotFoundError(f"no {pattern} files with a header in {path}")
    values = [n for n in names if n not in ids.names]
    cells = F.col("cells")
    return rows.select(
        *(_typed(cells, f.name, f.dataType).alias(f.name) for f in ids.fields),
        *(_typed(cells, n, value_type).alias(n) for n in values),
        FILE_NAME,
    )


def read_drifting_long(
    spark: SparkSession, path: str, ids: StructType, value_type: DataType = NUMBER, sep: str = ",", pattern: str = "*.csv"
) -> DataFrame:
    """The same files with a row for each value that is there: ids, ``station``, ``value`` and the file."""
    rows, _ = _named_cells(spark, path, ids, sep, pattern)
    stations = F.filter(F.map_keys("cells"), lambda k: ~k.isin(ids.names))
    long = rows.withColumn("station", F.explode(stations)).select(
        *(_typed(F.col("cells"), f.name, f.dataType).alias(f.name) for f in ids.fields),
        "station",
        _typed(F.col("cells"), F.col("station"), value_type).alias("value"),
        FILE_NAME,
    )
    return long.where("value IS NOT NULL")


def _records(lines: Iterator[str]) -> Iterator[str]:
    """Whole records: a line break inside quotes does not end one."""
    held: list[str] = []
    quotes = 0
    for line in lines:
        held.append(line)
        quotes += line.count('"')
        if quotes % 2 == 0:
            yield "".join(held).rstrip("\r\n")
            held, quotes = [], 0
    if held:
        yield "".join(held).rstrip("\r\n")


def _members(stream, suffix: str) -> list[str]:
    with zipfile.ZipFile(stream) as zipped:
        return [m for m in zipped.namelist() if m.lower().endswith(suffix)]


def _member_batches(archive: str, stream, members: Sequence[str], header: str) -> Iterator[pd.DataFrame]:
    with zipfile.ZipFile(stream) as zipped:
        for member in members:
            with io.TextIOWrapper(zipped.open(member), encoding="utf-8-sig", newline="") as lines:
                records = _records(lines)
                found = next(records, "").replace('"', "")
                if found != header:
                    raise ValueError(f"{archive}!{member} begins with {found!r}, not {header!r}")
                batch: list[str] = []
                for record in records:
                    batch.append(record)
                    if len(batch) == ROWS_PER_BATCH:
                        yield pd.DataFrame({"archive": archive, "member": member, "record": batch})
                        batch = []
                if batch:
                    yield pd.DataFrame({"archive": archive, "member": member, "record": batch})


def _parse(records: DataFrame, schema: StructType, sep: str) -> DataFrame:
    parsed = F.from_csv("record", ddl(schema), text_options(sep))
    # One member is unpacked by one task; rebalancing hands its rows to all tasks before they are parsed.
    rows = records.hint("rebalance").select("archive", "member", parsed.alias("row"))
    return rows.select("row.*", F.concat_ws("!", "archive", "member").alias(FILE_NAME))


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def unzip_csv(
    archives: DataFrame,
    schema: StructType,
    path: str = "path",
    content: str = "content",
    suffix: str = ".csv",
    sep: str = ",",
) -> DataFrame:
    """Rows of the delimited members of zip archives held in a binary column."""
    header = sep.join(schema.names)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, data in zip(batch[path], batch[content]):
                stream = io.BytesIO(data)
                yield from _member_batches(archive, stream, _members(stream, suffix), header)

    records = archives.select(path, content).mapInPandas(unpack, "archive string, member string, record string")
    return _parse(records, schema, sep)


def read_zipped_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    pattern: str = "*.zip",
    suffix: str = ".csv",
    sep: str = ",",
) -> DataFrame:
    """Rows of the delimited members of zip files; tasks stream single members instead of loading archives."""
    header = sep.join(schema.names)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["path"]:
                with _open(archive) as stream:
                    yield pd.DataFrame({"archive": archive, "member": _members(stream, suffix)})

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, member in zip(batch["archive"], batch["member"]):
                with _open(archive) as stream:
                    yield from _member_batches(archive, stream, [member], header)

    members = list_files(spark, path, pattern).select("path").mapInPandas(look, "archive string, member string")
    # A fixed number of partitions, so that a few names are still dealt out over all cores.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    records = members.repartition(tasks).mapInPandas(unpack, "archive string, member string, record string")
    return _parse(records, schema, sep)
