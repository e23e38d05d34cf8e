"""Landed CSV files: discovery, header check, reading by column name."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.cleaning import MALFORMED
from daybook.schemas import MERCHANTS, MONEY_COLUMNS, TRANSACTION_KEY, TRANSACTIONS, as_strings
from daybook.workspace import path_exists, qualified, shuffles_deleted

SOURCE_FILE, SOURCE_BLOCK, SOURCE_ROW = "source_file", "source_block", "source_row"
LINEAGE = (SOURCE_FILE, SOURCE_BLOCK, SOURCE_ROW)
LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(SOURCE_BLOCK, T.LongType()),
        T.StructField(SOURCE_ROW, T.LongType()),
    ]
)
REQUIRED_TRANSACTION_COLUMNS = (TRANSACTION_KEY, *MONEY_COLUMNS)
# Quotes inside a quoted field are doubled, on reading and on writing.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}
# What the reader takes for a blank line: control characters and blanks only.
_BLANK = "".join(map(chr, range(0x21)))
FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


@dataclass(frozen=True)
class SkippedFile:
    """A file that is not loaded, and why."""

    path: str
    reason: str


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """Paths of the files below a folder, by name. Contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path")
    )
    return sorted(row.path for row in files.toLocalIterator())


def _listed(path: str) -> str:
    """A path as file listings write it."""
    return re.sub(r"^file:/+", "file:/", path)


def plain_path(path: str) -> str:
    """The path of a scan's metadata as file listings write it: nothing encoded."""
    return _listed(unquote(path))


# Above any file's size: a split of its own for each file.
_ONE_FILE = str(1 << 50)


@contextmanager
def _a_task_for_each_file(spark: SparkSession) -> Iterator[None]:
    """For the planning of a scan: whole files, one to a task, handed on in small batches."""
    settings = {
        "spark.sql.files.maxPartitionBytes": _ONE_FILE,
        "spark.sql.files.openCostInBytes": _ONE_FILE,
        "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that is not blank; nothing behind it is read."""
    for batch in batches:
        for line, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if line.strip(_BLANK):
                yield pa.RecordBatch.from_pydict({"line": [line], "path": [path]})
                return


def read_headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names of each file, by the rules of the reader of the data.

    One job finds the first lines of all files; a task stops reading its file
    there. Each different line is then read as a header once, however many
    files begin with it. A file that is empty or cannot be read has no columns.
    """
    if not paths:
        return {}
    with _a_task_for_each_file(spark):
        lines = spark.read.option("ignoreCorruptFiles", "true").text(paths)
        lines = lines.select("value", F.col("_metadata.file_path").alias("path"))
        found = lines.mapInArrow(_first_line, "line string, path string").collect()
    names = {}
    for line in {r.line for r in found}:
        one = spark.sparkContext.parallelize([line], 1)
        names[line] = tuple(spark.read.options(**CSV_OPTIONS).csv(one).columns)
    first = {plain_path(r.path): names[r.line] for r in found}
    return {path: first.get(_listed(qualified(spark, path)), ()) for path in paths}


_UNREADABLE = re.compile(r"\[FAILED_READ_FILE[^\]]*\] Encountered error while reading file (.*?)\.\s+SQLSTATE", re.DOTALL)


def unreadable_file(error: Exception, paths: list[str]) -> str | None:
    """The one of some files whose reading has failed with this error, if any has."""
    told = _UNREADABLE.search(str(error))
    wanted = told and {plain_path(told[1]), _listed(told[1])}
    return next((p for p in paths if wanted and _listed(p) in wanted), None)


def _read_group(
    spark: SparkSession, paths: list[str], header: tuple[str, ...], wanted, multi_line: bool
) -> DataFrame:
    schema = as_strings((*header, MALFORMED))
    lines = (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("multiLine", str(multi_line).lower())
        .csv(paths)
    )
    values = [
        F.col(f"`{name}`") if name in header else F.lit(None).cast("string").alias(name)
        for name in wanted
    ]
    # Row numbers grow along each block of a file, so (file, block, row) is
    # the order in which the rows stand in their file.
    return lines.select(
        *values,
        MALFORMED,
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias(SOURCE_BLOCK),
        F.monotonically_increasing_id().alias(SOURCE_ROW),
    )


def read_csv_files(
    spark: SparkSession,
    paths: list[str],
    schema: T.StructType,
    required=(),
    multi_line: bool = False,
) -> tuple[DataFrame, list[SkippedFile]]:
    """Rows of the given files as text, columns matched by name.

    Files may order their columns differently or lack some; those with the
    same header are read together. A file without a required column is
    skipped. A line with a wrong number of fields is marked, not cut.
    `multi_line` accepts line breaks inside quoted fields, at the price of one
    task per file.
    """
    wanted = schema.fieldNames()
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    skipped = []
    for path, header in read_headers(spark, paths).items():
        absent = [c for c in required if c not in header]
        if required and not header:
            skipped.append(SkippedFile(path, "no header that can be read"))
        elif absent:
            skipped.append(SkippedFile(path, f"no column {', '.join(absent)}"))
        else:
            groups[header].append(path)
    rows = None
    for header, members in groups.items():
        part = _read_group(spark, members, header, wanted, multi_line)
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        empty = T.StructType([*as_strings((*wanted, MALFORMED)), *LINEAGE_SCHEMA])
        rows = spark.createDataFrame([], empty)
    return rows, skipped


def read_transactions_csv(
    spark: SparkSession, folder: str, pattern: str = "*.csv", multi_line: bool = False
) -> DataFrame:
    """Transaction files of a folder as text rows with their place of origin."""
    paths = list_files(spark, folder, pattern)
    return read_csv_files(spark, paths, TRANSACTIONS, REQUIRED_TRANSACTION_COLUMNS, multi_line)[0]


def read_merchants_csv(
    spark: SparkSession, folder: str, pattern: str = "*.csv", multi_line: bool = True
) -> DataFrame:
    """The newest merchant export of a folder as text rows."""
    return read_csv_files(spark, merchant_files(spark, folder, pattern), MERCHANTS, (), multi_line)[0]


def merchant_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """The files of the newest complete merchant export; none when there is none.

    A ``run=`` folder is complete once its writer has marked it so.
    """
    found = list_files(spark, folder, pattern)
    runs = {export_of(p) for p in found if export_of(p) != p}
    open_ = {r for r in runs if not path_exists(spark, f"{r}/_SUCCESS")}
    return newest_export([p for p in found if export_of(p) not in open_])


_STAMP = re.compile(r"\d{8}_\d{6}")


def export_of(path: str) -> str:
    """The export a file belongs to: its ``run=<stamp>`` folder, or itself."""
    folder, _, _ = path.rpartition("/")
    return folder if folder.rpartition("/")[2].startswith("run=") else path


def newest_export(paths: list[str]) -> list[str]:
    """The files of the newest export, by the time stamp in their names.

    An export is either one stamped file or a ``run=<stamp>`` folder. Names
    without a stamp come before all others, in their own order.
    """

    def age(path: str) -> tuple[str, str]:
        name = export_of(path).rpartition("/")[2]
        stamps = _STAMP.findall(name)
        return (stamps[-1] if stamps else "", name)

    newest = max(map(age, paths), default=None)
    return [p for p in paths if age(p) == newest]


def export_csv(df: DataFrame, folder: str, run_ts: str, compression: str = "none") -> str:
    """Write rows with a header into ``folder/run=<stamp>``; return that path.

    `run_ts` is ``yyyy-MM-dd HH:mm:ss``; its stamp is ``yyyyMMdd_HHmmss``.
    Files with ``gzip`` as `compression` end in ``.csv.gz``; the readers here
    take them as they are, each in one task.
    """
    name = run_ts.replace("-", "").replace(":", "").replace(" ", "_")
    path = f"{folder.rstrip('/')}/run={name}"
    with shuffles_deleted(df.sparkSession):
        df.write.mode("overwrite").options(**CSV_OPTIONS).option(
            "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
        ).csv(path, compression=compression)
    return path
