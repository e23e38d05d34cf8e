"""Orders of rows and columns for storing and shuffling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of each column that the order follows.
BITS = 5


def fixed_first(df: DataFrame) -> list[str]:
    """The columns, those of fixed width before the others: rows laid out so take less in a shuffle."""
    wide = ("string", "binary", "array", "map", "struct")
    return sorted(df.columns, key=lambda c: df.schema[c].dataType.simpleString().startswith(wide))


def interleaved(df: DataFrame, first: Column, second: Column, bits: int = BITS) -> Column:
    """A place on a space-filling (Z-order) curve through `first` and `second`.

    `first` counts by its quantiles, so that any distribution is spread evenly;
    they are few and read in one pass. `second` is a number below 2 ** `bits`.
    Nulls come first. A band of either column meets about the square root of the
    files a plain order by the other one would open.
    """
    parts = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(F.percentile_approx(first, parts, 10_000).alias("cuts")).first()["cuts"] or []
    cuts = F.array(*(F.lit(c) for c in sorted(set(found)))).cast("array<long>")
    place = F.size(F.filter(cuts, lambda c: c < first)) if found else F.lit(0)
    a, b = F.coalesce(place, F.lit(0)), F.coalesce(second, F.lit(0))
    curve = F.lit(0)
    for n in range(bits):
        curve = curve.bitwiseOR(F.shiftleft(F.shiftright(b, n).bitwiseAND(1), 2 * n))
        curve = curve.bitwiseOR(F.shiftleft(F.shiftright(a, n).bitwiseAND(1), 2 * n + 1))
    return curve
