"""Column expressions that turn landed text into typed values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts the CSV reader of the original job takes as missing.
MISSING_AT_READ = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Texts replaced by NULL while cleaning.
MISSING_WHEN_CLEANED = ("", " ", "NULL", "null", "None")
# Texts taken as NULL in any letter case when a row is stored.
MISSING_IN_ANY_CASE = ("nan", "none", "null")

_LONGEST_MISSING = max(map(len, MISSING_AT_READ))

WIDE_NUMBER = "decimal(38,6)"
MONEY = "decimal(18,2)"


def blank_to_null(c: Column, any_case: bool = False) -> Column:
    """NULL for every text that stands for a missing value.

    `any_case` also drops ``nan``, ``none`` and ``null`` in any letter case.
    """
    missing = c.isin(*MISSING_AT_READ, *MISSING_WHEN_CLEANED)
    if any_case:
        missing = missing | F.lower(c).isin(*MISSING_IN_ANY_CASE)
    # Most texts are longer than any of the spellings and need no look-up.
    return F.when((F.octet_length(c) > _LONGEST_MISSING) | ~missing, c)


def to_number(c: Column) -> Column:
    """Text to a wide decimal, NULL where it is not a number."""
    return c.try_cast(WIDE_NUMBER)


def looks_numeric(c: Column) -> Column:
    """True for the text of any number, also one too large to hold."""
    return c.rlike("(?i)^\\s*[+-]?(\\d+\\.?\\d*([e][+-]?\\d+)?|\\.\\d+([e][+-]?\\d+)?|inf(inity)?)\\s*$")


def _may_have_fraction(c: Column) -> Column:
    return F.contains(c, F.lit(".")) | F.contains(F.lower(c), F.lit("e"))


def has_fraction(c: Column) -> Column:
    """True where the text of a number is not whole, however small the rest.

    Plain digits, the usual case, are told by their look. So are decimals: any
    digit but zero behind the point. With an exponent the value is looked at.
    """
    number = to_number(c)
    lost = c.try_cast("double")
    by_value = F.coalesce(number != F.floor(number), F.lit(False)) | F.coalesce(lost != F.rint(lost), F.lit(False))
    by_look = c.rlike("\\.\\d*[1-9]") & number.isNotNull()
    return _may_have_fraction(c) & F.when(F.contains(F.lower(c), F.lit("e")), by_value).otherwise(by_look)


def to_whole(c: Column, kind: str = "bigint") -> Column:
    """Text to an integer: ``12.0`` gives 12; a fraction, bad text or a value
    out of range gives NULL."""
    number = to_number(c)
    return (
        F.when(~_may_have_fraction(c), c.try_cast(kind))
        .when(~has_fraction(c), number.try_cast(kind))
    )


def to_timestamp(c: Column) -> Column:
    """Text to a zone-less timestamp, NULL where it does not parse."""
    return c.try_cast("timestamp_ntz")


def to_text(c: Column) -> Column:
    """Any value as the text that is stored for it."""
    return c.cast("string")


def fill_zero(c: Column) -> Column:
    """NULL number to zero."""
    return F.coalesce(c, F.lit(0))


def tidy_number(c: Column) -> Column:
    """Other numeric columns: bad or missing to zero, two decimals."""
    return F.round(fill_zero(to_number(c)), 2)


def dollars(cents: Column) -> Column:
    """Cents to dollars, exactly."""
    return cents * F.lit(Decimal("0.01"))


def round_money(c: Column) -> Column:
    """Two decimals, halves away from zero, in the stored money type."""
    return F.round(c, 2).cast(MONEY)


def stamp(c: Column) -> Column:
    """A timestamp as ``yyyyMMdd_HHmmss``, its form in file and run names.

    Works on the text, as formatting functions would move zone-less times that
    the session's zone skips.
    """
    return F.translate(F.substring(c.cast("string"), 1, 19), " -:", "_")


def month_of(c: Column) -> Column:
    """The ``yyyy-MM`` partition a date or timestamp belongs to."""
    return F.substring(c.cast("date").cast("string"), 1, 7)


# What the source compares without regard to case and trailing blanks, where its collation says so.
COMPARED_TEXT = ("status", "transaction_type", "merchant_name")


def ignoring_case(df: DataFrame, columns=COMPARED_TEXT, collation: str = "UTF8_LCASE_RTRIM") -> DataFrame:
    """The table with some text columns that compare, group and join by a collation.

    Without it texts compare by their bytes. Groups of texts that count as equal
    show any one of them.
    """
    return df.withColumns({c: F.collate(F.col(c), collation) for c in columns if c in df.columns})
