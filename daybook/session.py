"""Session settings the jobs rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Generated methods above this size are not compiled by the JVM; beyond it the
# engine splits them up.
METHOD_SIZE = ("spark.sql.codegen.hugeMethodLimit", "8000")

SETTINGS = {
    # Run-time re-planning: broadcast choice from real sizes, skewed joins
    # split, small shuffle partitions merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    METHOD_SIZE[0]: METHOD_SIZE[1],
    # Zone-less timestamps everywhere; the zone only matters for the few
    # engine functions that need one.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(app_name: str = "daybook", **overrides: str) -> SparkSession:
    """A session with the settings above; the cluster's own ones are kept.

    Keyword names use ``__`` for ``.``: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def wide_expressions(spark: SparkSession) -> Iterator[None]:
    """For the length of a job that works on many columns in one expression.

    Affects speed only. Sessions from `build_session` have the setting anyway.
    """
    key, value = METHOD_SIZE
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)
