"""Exact deduplication of a stream of documents.

The stream keeps one entry per content digest, on disk and without expiry: the
smallest identifier seen, the place its content can be read from, and the
number of rows. A digest is only a proposal. Rows that share one are compared
by their full normalised bytes; should two different texts share a digest, they
are told apart by the bytes, so results never rest on the digest.

Texts are equal when identical after each run of ASCII white space becomes one
blank. Null counts as empty, and all empty texts are one group. Of equal texts
the row with the smallest identifier stays, null identifiers last; of repeated
rows the one read from the first place. An empty source gives an empty result.
Only built-in functions are used.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import SPACE, column
from daybook.workspace import fresh_path, materialize

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # All state of an executor shares one bounded cache; the rest is on disk.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # A store for each partition: megabytes set aside in advance would add up.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def normalised(text: Column) -> Column:
    """One blank for each run of white space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _rank(id_col: str) -> Column:
    """What decides which row stays; also says where its content lies."""
    return F.struct(
        column(id_col).isNull().alias("no_id"),
        column(id_col).alias("id"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.row_index").alias("row"),
    )


def _located(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = normalised(column(text_col))
    return docs.select(_rank(id_col).alias("place"), digest(text).alias("digest"), text.alias("text"))


def run_stream(
    source: DataFrame,
    table: str,
    state_dir: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> None:
    """Feed what is new in a streamed Parquet `source` to the keyed state.

    `table` receives, for each micro-batch, the entries it changed; a replayed
    batch overwrites its own folder. `state_dir` holds the state and the
    progress; calling again with it goes on where the last call ended.
    """
    spark = source.sparkSession
    entries = (
        _located(source, id_col, text_col, digest)
        .groupBy("digest")
        .agg(F.min("place").alias("keep"), F.count("*").alias("rows"))
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    with _settings(spark, STATE_SETTINGS):
        query = (
            entries.writeStream.outputMode("update")
            .foreachBatch(store)
            .option("checkpointLocation", state_dir)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def state_entries(spark: SparkSession, table: str, like: DataFrame) -> DataFrame:
    """The newest entry of each digest: `digest`, `keep`, `rows`."""
    stored = spark.read.schema(like.schema).parquet(table)
    newest = F.max_by(F.struct("keep", "rows"), "batch")
    return stored.groupBy("digest").agg(newest.alias("e")).select("digest", "e.keep", "e.rows")


def deduplicate(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    files_per_batch: int = 1000,
    digest: Callable[[Column], Column] = sha256,
    table: str | None = None,
    state_dir: str | None = None,
) -> DataFrame:
    """Decide on every row of the Parquet table at `path`, dropped ones too.

    Returns `doc_id`, `digest`, `keep_id` (identifier of the row that stays),
    `group_size` and `kept`.
    """
    table = table or fresh_path(spark, "dedup-entries")
    state_dir = state_dir or fresh_path(spark, "dedup-state")
    # A path is no pattern, whatever characters it has.
    literal = re.sub(r"([\[\]{}*?\\])", r"\\\1", path.rstrip("/"))
    # Only these columns: no other one can hide the place of a row in its file.
    wanted = T.StructType([f for f in spark.read.parquet(literal).schema if f.name in (id_col, text_col)])
    docs = spark.read.schema(wanted).parquet(literal)
    # As a pattern the path may be a folder or a single file.
    pattern = literal if literal != path.rstrip("/") else f"{literal[:-1]}[{literal[-1]}]"
    stream = spark.readStream.schema(wanted).option("maxFilesPerTrigger", files_per_batch).parquet(pattern)
    located = _located(docs, id_col, text_col, digest)
    like = located.select(
        "digest", F.col("place").alias("keep"), F.lit(0).cast("long").alias("rows"), F.lit(0).alias("batch")
    )
    spark.createDataFrame([], like.schema).drop("batch").write.mode("ignore").parquet(f"{table}/batch=-1")
    run_stream(stream, table, state_dir, id_col, text_col, digest)
    entries = materialize(state_entries(spark, table, like), "dedup-state-entries")

    # Hits: full bytes of the rows whose digest has come more than once.
    repeated = entries.where(F.col("rows") > 1).select("digest")
    classes = materialize(
        located.join(repeated, "digest", "left_semi")
        .groupBy("digest", "text")
        .agg(F.min("place").alias("keep"), F.count("*").alias("rows")),
        "dedup-classes",
    )
    clashing = materialize(
        classes.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "dedup-clashes"
    )
    columns = ("place", "digest", "keep", "rows")
    decided = located.select("place", "digest").join(entries, "digest").select(*columns)
    if not clashing.isEmpty():
        by_bytes = located.join(clashing, "digest", "left_semi").join(classes, ["digest", "text"])
        decided = decided.join(clashing, "digest", "left_anti").select(*columns).unionByName(by_bytes.select(*columns))
    return (
        decided.select(
            F.col("place.id").alias("doc_id"),
            "digest",
            F.col("keep.id").alias("keep_id"),
            F.col("rows").alias("group_size"),
            (F.col("place") == F.col("keep")).alias("kept"),
        )
    )
