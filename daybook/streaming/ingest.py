"""Streaming form of the load: new files, each once; and the run around it."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook.plans.load import load_transactions
from daybook.plans.refresh import update_daily
from daybook.schemas import TRANSACTIONS
from daybook.sources.files import (
    FILE_SCHEMA,
    REQUIRED_TRANSACTION_COLUMNS,
    SkippedFile,
    read_csv_files,
    unreadable_file,
)
from daybook.sources.transactions import append_transactions, stored_keys
from daybook.workspace import path_exists, scratch


def ingest_stream(
    spark: SparkSession,
    in_dir: str,
    table: str,
    archive_dir: str | None,
    checkpoint: str,
    *,
    rejects: str | None = None,
    reports: str | None = None,
    pattern: str = "*.csv",
    files_per_batch: int = 1000,
    compat: bool = False,
    once: bool = True,
) -> StreamingQuery:
    """Load every new file of a folder once and archive it.

    The stream itself carries file names only; each batch reads its files by
    header and decides with the same functions as a batch load. The table is
    the memory of what is loaded, so no state grows with the stream, and a
    replayed batch finds its keys stored. `rejects` receives rejected rows and
    skipped files as JSON, one folder per batch, overwritten by a replay; a file
    that cannot be read is among them, and the others are loaded.
    `reports` receives, once for each batch, the counts of each file, its control
    totals and the ignored rows. A batch looks up its keys in the table's index,
    and rows, keys and first dates are stored in one step. Files of the last batch are archived when the next one is planned.
    The daily table is not touched here, see `load_new_files`.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive_dir:
        files = files.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    names = files.load(in_dir).select("path")

    def load(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            load_batch(batch, batch_id)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        # At most `files_per_batch` names.
        found = sorted(r.path for r in batch.select("path").collect())
        if not found:
            return
        session = batch.sparkSession
        broken: list[SkippedFile] = []
        while True:
            raw, skipped = read_csv_files(session, found, TRANSACTIONS, REQUIRED_TRANSACTION_COLUMNS)
            try:
                result = load_transactions(raw, lambda keys: stored_keys(session, table, keys), compat)
                break
            except Exception as error:
                # A file that breaks off behind its header: the others are loaded without it.
                path = unreadable_file(error, found)
                if path is None:
                    raise
                broken.append(SkippedFile(path, "cannot be read to its end"))
                found.remove(path)
        skipped = [*skipped, *broken]
        run_name = f"load={_stream_id(session, checkpoint)}-{batch_id}"
        if reports:
            for name, rows in (("files", result.report), ("totals", result.totals), ("ignored", result.ignored)):
                path = f"{reports.rstrip('/')}/{name}/{run_name}"
                # A replay finds its own rows stored; what the first try noted stands.
                if not path_exists(session, f"{path}/_SUCCESS"):
                    rows.write.mode("overwrite").json(path)
        append_transactions(result.to_append, table)
        if rejects:
            notes = session.createDataFrame(
                [(s.path, s.reason) for s in skipped], "source_file string, reject_reason string"
            )
            run = f"{rejects.rstrip('/')}/{run_name}"
            rows = result.rejected.unionByName(notes, allowMissingColumns=True)
            rows.write.mode("overwrite").json(run)

    writer = names.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.start()


def load_new_files(
    spark: SparkSession,
    in_dir: str,
    table: str,
    archive_dir: str | None,
    checkpoint: str,
    daily: str,
    *,
    run_ts: str | None = None,
    as_of: date | None = None,
    lookback_days: int = 0,
    **options,
) -> DataFrame:
    """One run: load all new files, then update the daily table once.

    The watermark is that of the table before the run, however many batches the
    files take, and moves only with the update: a run that breaks off in between
    is made up for by the next one. Returns the summary of the updated days.
    """
    query = ingest_stream(spark, in_dir, table, archive_dir, checkpoint, once=True, **options)
    query.awaitTermination()
    run_ts = run_ts or spark.sql("SELECT substring(string(localtimestamp()), 1, 19)").first()[0]
    return update_daily(spark, table, daily, run_ts, as_of, lookback_days)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's id, which a restart keeps and a new checkpoint changes."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").agg(F.max("value")).first()[0]
    return json.loads(text)["id"]
