"""Schemas of the three stored tables and their definition in a catalog."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Column names and declared types of the stored tables.
TRANSACTION_COLUMNS = (
    ("transaction_uuid", "varchar(50)"),
    ("merchant_account_id", "int"),
    ("merchant_name", "varchar(255)"),
    ("mid", "bigint"),
    ("gateway_merchant_id", "varchar(50)"),
    ("amount", "decimal(18,2)"),
    ("currency", "varchar(10)"),
    ("refunded_amount", "decimal(18,2)"),
    ("status", "varchar(50)"),
    ("source_brand", "varchar(50)"),
    ("source_first6", "varchar(10)"),
    ("payment_method_details", "varchar(255)"),
    ("transaction_date", "timestamp_ntz"),
    ("transaction_type", "varchar(50)"),
    ("user_source", "varchar(50)"),
    ("SourceAccountCreated", "timestamp_ntz"),
    ("created_at", "timestamp_ntz"),
    ("updated_at", "timestamp_ntz"),
)
MERCHANT_COLUMNS = (
    ("MerchantGroupID", "bigint"),
    ("MerchantGroupName", "varchar(255)"),
    ("MerchantGroupAddress", "varchar(255)"),
    ("MerchantGroupCity", "varchar(100)"),
    ("MerchantGroupState", "varchar(50)"),
    ("MerchantGroupZip", "varchar(20)"),
    ("MerchantAccountDatabaseID", "int"),
    ("MerchantAccountName", "varchar(255)"),
    ("MerchantAccountGatewayID", "varchar(50)"),
    ("MerchantAccountUUID", "varchar(50)"),
    ("MerchantAccountMID", "bigint"),
    ("MerchantAccountGatewayMerchantID", "varchar(50)"),
    ("MerchantAccountFiservSalesID", "bigint"),
    ("MerchantAccountAddress", "varchar(255)"),
    ("MerchantAccountCity", "varchar(100)"),
    ("MerchantAccountState", "varchar(50)"),
    ("MerchantAccountZip", "varchar(20)"),
    ("MerchantAccountCreated", "timestamp_ntz"),
    ("ContactEmail", "varchar(255)"),
    ("ContactFirstName", "varchar(100)"),
    ("ContactLastName", "varchar(100)"),
)
DAILY_COLUMNS = (
    ("id", "bigint"),
    ("day", "date"),
    ("mid", "varchar(50)"),
    ("merchant_name", "varchar(255)"),
    ("amount_sum", "decimal(18,2)"),
    ("amount_count", "int"),
    ("refund_sum", "decimal(18,2)"),
    ("refund_count", "int"),
    ("total", "decimal(18,2)"),
    ("totalcount", "int"),
    ("void_sum", "decimal(18,2)"),
    ("voidcount", "int"),
    ("first_transaction_date", "timestamp_ntz"),
    ("first_business_transaction_date", "timestamp_ntz"),
    ("mtd_total", "decimal(18,2)"),
    ("ytd_total", "decimal(18,2)"),
    ("sourceAccountCreated", "timestamp_ntz"),
    ("created_at", "timestamp_ntz"),
    ("updated_at", "timestamp_ntz"),
)

TRANSACTION_KEY = "transaction_uuid"
MERCHANT_KEY = "MerchantAccountDatabaseID"
DAILY_KEY = "id"
MONEY_COLUMNS = ("amount", "refunded_amount")
DAILY_MEASURES = tuple(
    name for name, kind in DAILY_COLUMNS if kind in ("decimal(18,2)", "int")
)
DAILY_NOT_NULL = ("day", "mid", "merchant_name", *DAILY_MEASURES, "created_at", "updated_at")


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "decimal(18,2)": T.DecimalType(18, 2),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _field(name: str, declared: str) -> T.StructField:
    length = re.fullmatch(r"varchar\((\d+)\)", declared)
    if length:
        return T.StructField(name, T.StringType(), True, {"max_length": int(length[1])})
    return T.StructField(name, _TYPES[declared])


def _schema(columns) -> T.StructType:
    return T.StructType([_field(name, declared) for name, declared in columns])


TRANSACTIONS = _schema(TRANSACTION_COLUMNS)
MERCHANTS = _schema(MERCHANT_COLUMNS)
DAILY_METRICS = _schema(DAILY_COLUMNS)


def max_lengths(schema: T.StructType) -> dict[str, int]:
    """Declared length of every bounded text column."""
    return {f.name: f.metadata["max_length"] for f in schema if "max_length" in f.metadata}


def as_strings(names) -> T.StructType:
    """The landing form of a file: every column read as text."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def create_table(
    spark: SparkSession,
    name: str,
    columns,
    *,
    not_null=(),
    zero_default=(),
    partition_by: str | None = None,
    bucket_by: str | None = None,
    buckets: int = 0,
    location: str | None = None,
) -> None:
    """Drop and define a catalog table.

    Inserts enforce the declared text lengths and fill the zero defaults. NOT
    NULL is declared too, but file tables do not enforce it; that and the key
    are for `require_constraints`. A transactions table bucketed by its key
    lets every later load compare keys without shuffling the stored side.
    """
    parts = []
    for column, declared in columns:
        text = f"`{column}` {declared}"
        if column in not_null:
            text += " NOT NULL"
        if column in zero_default:
            text += " DEFAULT 0"
        parts.append(text)
    if partition_by and partition_by not in dict(columns):
        parts.append(f"`{partition_by}` string")
    statement = f"CREATE TABLE {name} ({', '.join(parts)}) USING parquet"
    if partition_by:
        statement += f" PARTITIONED BY (`{partition_by}`)"
    if bucket_by and buckets:
        statement += f" CLUSTERED BY (`{bucket_by}`) INTO {buckets} BUCKETS"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(statement)


def create_daily_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """The daily metrics table, partitioned by month in place of a day index."""
    create_table(
        spark,
        name,
        DAILY_COLUMNS,
        not_null=("id", *DAILY_NOT_NULL),
        zero_default=DAILY_MEASURES,
        partition_by="month",
        location=location,
    )


def create_transactions_table(
    spark: SparkSession, name: str, buckets: int, location: str | None = None
) -> None:
    """The transactions table, bucketed by its key."""
    create_table(
        spark,
        name,
        TRANSACTION_COLUMNS,
        not_null=(TRANSACTION_KEY,),
        bucket_by=TRANSACTION_KEY,
        buckets=buckets,
        location=location,
    )


def create_merchants_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """The merchants table; small, so neither partitioned nor bucketed."""
    create_table(spark, name, MERCHANT_COLUMNS, not_null=(MERCHANT_KEY,), location=location)
