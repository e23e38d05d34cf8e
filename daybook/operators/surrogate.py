"""Consecutive row numbers over a whole table without one sorting task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.workspace import fresh_path


def row_order() -> list[Column]:
    """Day, then mid by its number, then merchant name."""
    return [F.col("day"), F.col("mid").cast("bigint"), F.col("merchant_name")]


def with_surrogate_key(df: DataFrame, start: int = 1, order: list[Column] | None = None) -> DataFrame:
    """Add `id`: `start`, `start` + 1, ... in (day, mid, merchant name) order.

    Rows are range-partitioned and numbered by `with_positions`.
    """
    keys = order or row_order()
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return with_positions(ordered, "id", start).select("id", *df.columns)


def with_positions(df: DataFrame, name: str = "position", start: int = 1) -> DataFrame:
    """Add each row's place in the order in which `df` has its rows.

    The order is that of the partitions and of the rows inside them, as after
    `orderBy`. Rows are written as they come. Parquet then knows each row's place
    in its file, so the number is that place plus the rows of all earlier files.
    The list of files is the only thing numbered in one task; it has one entry
    per partition.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "numbered")
    df.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    columns = df.columns
    stored = spark.read.parquet(path).select(
        *columns,
        "_part",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    by_file = Window.orderBy("_part", "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part", "_file")
        .agg(F.count("*").alias("_rows"))
        .select("_part", "_file", F.coalesce(F.sum("_rows").over(by_file), F.lit(0)).alias("_before"))
    )
    place = (F.lit(start) + F.col("_before") + F.col("_place")).alias(name)
    return stored.join(F.broadcast(offsets), ["_part", "_file"]).select(*columns, place)


def order_digest(df: DataFrame) -> DataFrame:
    """`rows` and `digest` of a table in its order: another order gives another digest.

    One number of each row and its position goes into a sum that no order of
    adding changes, so the rows meet in no task.
    """
    placed = with_positions(df, "_position")
    term = F.xxhash64("_position", *df.columns).cast("decimal(38,0)")
    return placed.agg(F.count("*").alias("rows"), F.coalesce(F.sum(term), F.lit(0)).cast("decimal(38,0)").alias("digest"))
