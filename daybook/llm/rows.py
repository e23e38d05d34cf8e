"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.workspace import fresh_path

# The white space of the tokenising contracts: blank, tab, line feed, vertical
# tab, form feed, carriage return. `bytes.split()` uses the same six.
SPACE = "[\\x20\\x09-\\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def column(name: str) -> Column:
    """A top-level column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(name: str, taken: Sequence[str]) -> str:
    """The name, or one like it that none of the columns `taken` has."""
    there = {t.lower() for t in taken}
    while name.lower() in there:
        name += "_"
    return name


def id_and_text(docs: DataFrame, id_col: str, text_col: str, **more: str) -> DataFrame:
    """`doc_id`, `text` (null: empty) and the columns of `more` under their keys.

    All other columns are left behind, so none can clash with a name that an
    operator makes.
    """
    return docs.select(
        column(id_col).alias("doc_id"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
        *(column(c).alias(name) for name, c in more.items()),
    )


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, _UPPER, _UPPER.lower())


def text_bytes(text: Column) -> Column:
    """Length in UTF-8 bytes; null counts as none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def numbered(df: DataFrame, label: str, name: str = "row_id") -> DataFrame:
    """`df`, stored, with a number of its own for each row.

    The numbers become fixed when the rows are written, so a later re-run of a
    lost task reads the same ones. They differ between runs; use them to tell
    rows apart, never to order them.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    out = df.withColumn(name, F.monotonically_increasing_id())
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def map_text(
    df: DataFrame,
    make: Callable[[], Callable[[list[str]], Sequence[pa.Array]]],
    fields: Sequence[T.StructField],
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """The columns `keep` plus `fields` computed from the text, row by row.

    `make` is called once in each task and gives a function from a list of
    texts to one Arrow array per field. Spark hands over the rows in batches
    bounded in rows and bytes.
    """
    schema = T.StructType([*(df.schema[c] for c in keep), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            made = work(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *made],
                names=[*keep, *(f.name for f in fields)],
            )

    return df.select(*keep, text).mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str | int, at_most: int) -> Iterator[pa.RecordBatch]:
    """A batch in consecutive parts whose texts have about `at_most` bytes together.

    A longer text comes with at most one part's worth of others. An empty batch
    has no part.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // at_most
    starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], len(part)]):
        yield batch.slice(a, b - a)
