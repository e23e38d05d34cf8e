"""Identifier lists against the same rules in plain Python."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import daybook as db

ROWS = [
    "1, 2;3\n4\t5", "", " ,;\n", "000 0007 -5 +12 123456", "a b c", "x\x1cy\x1fz",
    "'quoted' (1)", "007,007", "-0005", "٠١ 1", "00a", "\U0001f600 12",
]


def tokens(text):
    return [t.strip() for t in re.split(r"[\s,;\t]+", text) if t.strip()]


def expected(text, mode, strip, pad, width):
    out = []
    for t in tokens(text):
        if strip:
            t = t.lstrip("0") or "0"
        if pad:
            t = t.zfill(width)
        out.append({"quoted": f"'{t}'", "bracketed": f"('{t}')"}.get(mode, t))
    return ", ".join(out)


def formatted(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    done = rows.select("n", db.format_ids(F.col("t"), **options).alias("f")).collect()
    return [r.f for r in sorted(done)]


@pytest.mark.parametrize("mode", ["quoted", "bracketed", "plain", "anything"])
@pytest.mark.parametrize("strip", [False, True])
@pytest.mark.parametrize("pad", [False, True])
def test_modes(spark, mode, strip, pad):
    for width in (0, 3, 12):
        got = formatted(spark, ROWS, mode=mode, strip=strip, pad=pad, width=width)
        assert got == [expected(t, mode, strip, pad, width) for t in ROWS]


def test_defaults_and_bad_width(spark):
    assert formatted(spark, ["07"]) == ["'07'"]
    assert formatted(spark, ["07"], pad=True, width="wide") == ["'000000000007'"]
    assert formatted(spark, ["07"], pad=True, width=None) == ["'000000000007'"]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123 ,;+-\t\n x", max_size=30), min_size=1, max_size=20))
def test_any_text(spark, texts):
    got = formatted(spark, texts, strip=True, pad=True, width=4)
    assert got == [expected(t, "quoted", True, True, 4) for t in texts]
