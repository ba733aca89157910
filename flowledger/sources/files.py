"""File readers: CSV folders, parquet, zip archives with nested archives."""

from __future__ import annotations

import csv
import io
import sys
import zipfile
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .staging import stage

# Task code is shipped with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_ROWS = 10_000


def read_csv(spark: SparkSession, folder: str) -> DataFrame:
    """All CSV files of a folder (any case of the suffix), header row, every column text.

    Columns are matched by name: files with the same header line are one scan, scans are united and
    columns that a file lacks are null. Quotes are doubled inside quotes, as in archives; quoted line breaks
    belong to the field. A file without a header line adds nothing.

    One aggregate over the lines finds each file's header and whether some line has an odd number of quotes.
    Where none has, no field runs over a line's end and the file is split between tasks at any line; the other files
    are one task each. Lines of blanks alone are rows too, which only the scan of whole files gives, so they
    count as odd.
    """
    files = spark.read.option("pathGlobFilter", "*.[cC][sS][vV]")
    lines = files.option("wholetext", False).text(folder).select(
        F.col("_metadata.file_path").alias("path"), "value",
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("place"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = (quotes % 2 == 1) | ((F.col("value") != "") & (F.trim("value", F.lit(" \t")) == ""))
    # One row per file, then one per distinct header and way to read: as many as there are layouts.
    first = lines.groupBy("path").agg(F.min_by("value", "place").alias("header"), F.max(odd).alias("whole"))
    layouts = first.groupBy("header", "whole").agg(F.collect_list("path").alias("paths")).orderBy("header", "whole").collect()
    parts = [
        spark.read.option("header", True).option("escape", '"').option("multiLine", row["whole"]).csv(row["paths"])
        for row in layouts
    ]
    if not parts:
        return files.option("header", True).csv(folder)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# Schemes whose files tasks open by themselves and read by ranges; other archives come whole through Spark's reader.
RANGED_SCHEMES = ("file", "hdfs", "viewfs", "s3", "s3a", "gs", "abfs", "abfss")
MAX_ARCHIVE_TASKS = 10_000


def _open_ranged(path: str):
    """A seekable file that reads only what is asked for."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return open("/" + rest.lstrip("/"), "rb")
    uri = quote(path.replace("s3a:", "s3:", 1), safe=":/")
    system, inner = fs.FileSystem.from_uri(uri)
    return system.open_input_file(inner)


def _csv_members(archive: zipfile.ZipFile) -> list[str]:
    """Members that hold rows: *.csv and nested *.csv.zip; anything else is skipped. A name that occurs twice counts once."""
    return [n for n in dict.fromkeys(archive.namelist()) if n.lower().endswith((".csv", ".csv.zip"))]


def _member_streams(archive: zipfile.ZipFile, name: str) -> Iterator[tuple[str, io.BufferedIOBase]]:
    """The CSV streams of one member. A nested archive is read through its decompressing stream, which can go back to
    its start, so it is never held whole."""
    with archive.open(name) as stream:
        if not name.lower().endswith(".csv.zip"):
            yield name, stream
            return
        with zipfile.ZipFile(stream) as nested:
            for inner in nested.namelist():
                if inner.lower().endswith(".csv"):
                    with nested.open(inner) as rows:
                        yield f"{name}/{inner}", rows


def read_archives(spark: SparkSession, path: str, schema: StructType,
                  ranged_schemes: Sequence[str] = RANGED_SCHEMES) -> DataFrame:
    """Rows of all CSV files inside the zip archives under `path`, as text, one task per archive member.

    Columns are matched by header name per file, absent ones are null. Members are decompressed as
    streams and handed on in batches. Adds Archive, Entry and LineNo.

    One pass reads the directories at the archives' ends and stores the list of members; then every member is a
    task (each of MAX_ARCHIVE_TASKS takes several if there are more) that reads its own byte range, so neither the
    size of an archive nor a limit of binary values counts. That needs a path that tasks can open: archives of a
    scheme not in `ranged_schemes` are read whole by Spark, one task an archive, each below 2 GiB.
    """
    names = [f.name for f in schema.fields]
    out = StructType([StructField("Archive", StringType()), StructField("Entry", StringType()),
                      *[StructField(n, StringType()) for n in names]]).add("LineNo", "long")
    archives = (spark.read.format("binaryFile").option("pathGlobFilter", "*.[zZ][iI][pP]")
                .option("recursiveFileLookup", "true").load(path))
    ranged = F.substring_index("path", ":", 1).isin(*ranged_schemes)

    def unpack_whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in _csv_members(archive):
                        for entry, stream in _member_streams(archive, member):
                            yield from _entry_batches(source, entry, stream, names)

    def list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source in batch["path"]:
                with _open_ranged(source) as file, zipfile.ZipFile(file) as archive:
                    yield pd.DataFrame([(source, m) for m in _csv_members(archive)], columns=["path", "member"], dtype=str)

    def unpack_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, member in zip(batch["path"], batch["member"]):
                with _open_ranged(source) as file, zipfile.ZipFile(file) as archive:
                    for entry, stream in _member_streams(archive, member):
                        yield from _entry_batches(source, entry, stream, names)

    whole = archives.where(~ranged)
    if not whole.select("path").isEmpty():
        if not archives.where(ranged).select("path").isEmpty():
            raise ValueError("archives of one read must all be of schemes that tasks open, or none")
        return whole.select("path", "content").mapInPandas(unpack_whole, out)
    members = stage(archives.select("path").mapInPandas(list_members, "path string, member string"))
    tasks = min(max(members.count(), 1), MAX_ARCHIVE_TASKS)
    # Ranges of as many members as there are tasks hold one each, where a hash would put some together.
    return members.repartitionByRange(tasks, "path", "member").mapInPandas(unpack_members, out)


def _entry_batches(source: str, entry: str, stream, names: Sequence[str]) -> Iterator[pd.DataFrame]:
    csv.field_size_limit(sys.maxsize)
    reader = csv.reader(io.TextIOWrapper(stream, encoding="utf-8-sig", newline=""))
    header = {h.strip(): i for i, h in enumerate(next(reader, []))}
    positions = [header.get(n) for n in names]
    rows = []

    def frame() -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["Archive", "Entry", *names, "LineNo"])

    for record in reader:
        if record:
            fields = [record[p] if p is not None and p < len(record) else None for p in positions]
            rows.append([source, entry, *fields, reader.line_num])
        if len(rows) >= BATCH_ROWS:
            yield frame()
            rows.clear()
    if rows:
        yield frame()
