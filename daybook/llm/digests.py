"""Digest columns that queries derive from spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span in the given order, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def scored(spans: Column) -> Column:
    """The score of each span in the given order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",")


def base_digest(spans: Column) -> Column:
    """Lower-case SHA-256 over the base spans."""
    return F.sha2(listed(F.filter(spans, lambda s: s["base"])), 256)


def count_of(spans: Column, kind: str) -> Column:
    """Number of base spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")
