"""Typing of landed rows, with a reason for every row that cannot be stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.values import (
    blank_to_null,
    fill_zero,
    has_fraction,
    looks_numeric,
    to_text,
    to_timestamp,
    to_whole,
)
from daybook.operators.quality import REASON
from daybook.schemas import (
    MERCHANT_KEY,
    MERCHANTS,
    MONEY_COLUMNS,
    TRANSACTION_KEY,
    TRANSACTIONS,
    max_lengths,
)

MALFORMED = "malformed_line"
_IDS = ("merchant_account_id", "mid")
_CODES = ("source_first6", "payment_method_details")


def _first_reason(checks: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*(F.when(failed, F.lit(text)) for failed, text in checks)).alias(REASON)


def _numeric(schema: T.StructType, also=()) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.NumericType) or f.name in also]


def _typed(name: str) -> str:
    return f"_{name}_typed"


def _texts(raw: DataFrame, schema: T.StructType, any_case: bool) -> tuple[DataFrame, list[str]]:
    """Texts without their spellings of a missing value; absent columns as
    NULL. Also returns the columns that are not part of the table."""
    present = set(raw.columns)
    extra = [c for c in raw.columns if c not in schema.fieldNames()]
    texts = [
        blank_to_null(F.col(f.name), any_case).alias(f.name)
        if f.name in present
        else F.lit(None).cast("string").alias(f.name)
        for f in schema
    ]
    return raw.select(*texts, *extra), extra


def _with_typed(texts: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add typed values beside the texts.

    They are a projection of their own, so that each is worked out once,
    however many checks look at it.
    """
    return texts.withColumns({_typed(name): value for name, value in values.items()})


def _number_checks(name: str, fraction: str) -> list[tuple[Column, str]]:
    # The rare case is asked for first; only then is the text looked at.
    lost = F.col(_typed(name)).isNull() & looks_numeric(F.col(name))
    return [
        (has_fraction(F.col(name)), f"{name}: {fraction}"),
        (lost, f"{name}: out of range"),
    ]


def _length_checks(schema: T.StructType, typed=()) -> list[tuple[Column, str]]:
    return [
        (
            F.length(F.col(_typed(name) if name in typed else name)) > longest,
            f"{name}: longer than {longest}",
        )
        for name, longest in max_lengths(schema).items()
    ]


def _finished(
    rows: DataFrame, schema: T.StructType, zero, typed, extra, checks: list[tuple[Column, str]]
) -> DataFrame:
    """The table's columns, what passes through, and the first reason."""

    def final(name: str) -> Column:
        value = F.col(_typed(name)) if name in typed else F.col(name)
        return (fill_zero(value) if name in zero else value).cast(schema[name].dataType).alias(name)

    passed = [c for c in extra if c != MALFORMED]
    return rows.select(*map(final, schema.fieldNames()), *passed, _first_reason(checks))


def clean_transactions(raw: DataFrame, compat: bool = False) -> DataFrame:
    """Landed text rows to the types of the transactions table.

    Missing or non-numeric money becomes 0. Missing or non-numeric ids become
    NULL and the two card fields stay text; `compat` instead turns all four
    into numbers with 0 for anything missing. Fractional cents, values out of
    range, text longer than its column, dates that do not parse and a missing
    key give a `reject_reason`. Columns that are not part of the table pass
    through, absent ones become NULL.
    """
    texts, extra = _texts(raw, TRANSACTIONS, any_case=True)
    codes = _CODES if compat else ()
    numeric = (*MONEY_COLUMNS, *_IDS, *codes)
    dates = [f.name for f in TRANSACTIONS if isinstance(f.dataType, T.TimestampNTZType)]
    values = {c: F.col(c).try_cast(TRANSACTIONS[c].dataType) for c in MONEY_COLUMNS}
    for name in _IDS:
        values[name] = to_whole(F.col(name), TRANSACTIONS[name].dataType.simpleString())
    for name in codes:
        values[name] = to_text(fill_zero(to_whole(F.col(name))))
    for name in dates:
        values[name] = to_timestamp(F.col(name))

    checks = [(F.col(TRANSACTION_KEY).isNull(), f"{TRANSACTION_KEY}: missing")]
    if MALFORMED in extra:
        checks.insert(0, (F.col(MALFORMED).isNotNull(), "line: wrong number of fields"))
    for name in (*_IDS, *codes):
        checks += _number_checks(name, "not whole")
    for name in MONEY_COLUMNS:
        checks += _number_checks(name, "fraction of a cent")
    for name in dates:
        lost = F.col(_typed(name)).isNull() & F.col(name).isNotNull()
        checks.append((lost, f"{name}: not a date"))
    checks += _length_checks(TRANSACTIONS, codes)
    zero = numeric if compat else MONEY_COLUMNS
    rows = _with_typed(texts, values)
    return _finished(rows, TRANSACTIONS, zero, values, extra, checks)


def clean_merchants(raw: DataFrame) -> DataFrame:
    """Landed text rows to the types of the merchants table.

    Bad numbers and dates become NULL. A missing key, a fraction in a whole
    number, a value out of range or too long a text gives a `reject_reason`.
    """
    texts, extra = _texts(raw, MERCHANTS, any_case=False)
    numeric = [f.name for f in MERCHANTS if isinstance(f.dataType, T.NumericType)]
    values = {
        name: to_whole(F.col(name), MERCHANTS[name].dataType.simpleString())
        for name in numeric
    }
    for f in MERCHANTS:
        if isinstance(f.dataType, T.TimestampNTZType):
            values[f.name] = to_timestamp(F.col(f.name))

    checks = []
    if MALFORMED in extra:
        checks.append((F.col(MALFORMED).isNotNull(), "line: wrong number of fields"))
    checks += _number_checks(MERCHANT_KEY, "not whole")
    checks.append((F.col(_typed(MERCHANT_KEY)).isNull(), f"{MERCHANT_KEY}: missing"))
    for name in numeric:
        if name != MERCHANT_KEY:
            checks += _number_checks(name, "not whole")
    checks += _length_checks(MERCHANTS)
    return _finished(_with_typed(texts, values), MERCHANTS, (), values, extra, checks)
