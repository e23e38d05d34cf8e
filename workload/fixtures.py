"""The shapes of the stored tables and landed files, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A total order for rows that repeat a key.
ROW_ORDER = (
    "transaction_date",
    "amount",
    "refunded_amount",
    "merchant_account_id",
    "mid",
    "merchant_name",
    "status",
    "transaction_type",
    "SourceAccountCreated",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. One that the scan cannot split over all cores, like a
    single file with one row group, is spread after reading; a large table
    never is."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions with repeated keys, NULL mids and NULL names."""
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr("*", "cast(round(l_extendedprice * 100) as bigint) AS cents")
        .selectExpr(
            "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) AS transaction_uuid",
            "cast(l_suppkey % 15 as int) AS merchant_account_id",
            """CASE WHEN l_partkey % 97 = 0 THEN NULL
                    ELSE concat('Merchant ', cast(l_suppkey % 20 as string),
                                CASE WHEN l_partkey % 7 = 0 THEN ' LLC' ELSE '' END)
               END AS merchant_name""",
            "CASE WHEN l_suppkey % 41 = 0 THEN NULL ELSE l_suppkey % 20 END AS mid",
            "cast(NULL as string) AS gateway_merchant_id",
            "cast(cents % 5000 - 50 as decimal(18,2)) AS amount",
            "'USD' AS currency",
            """cast(CASE WHEN l_returnflag = 'R' AND l_linenumber <= 3 THEN cents % 3000 ELSE 0 END
                    as decimal(18,2)) AS refunded_amount""",
            "CASE WHEN l_linestatus = 'F' OR l_quantity > 15 THEN 'succeeded' ELSE 'failed' END AS status",
            "'visa' AS source_brand",
            "'004321' AS source_first6",
            "cast(NULL as string) AS payment_method_details",
            """timestampadd(SECOND, cast(l_partkey * 37 % 86400 as int), cast(l_shipdate as timestamp_ntz))
               AS transaction_date""",
            """CASE WHEN l_returnflag = 'R' AND l_linenumber <= 3 THEN 'refund'
                    WHEN l_returnflag = 'A' AND l_linenumber <= 2 THEN 'void'
                    ELSE 'charge' END AS transaction_type""",
            "'api' AS user_source",
            """timestampadd(DAY, cast(l_suppkey % 365 as int), timestamp_ntz'1994-01-01 00:00:00')
               AS SourceAccountCreated""",
            "cast(NULL as timestamp_ntz) AS created_at",
            """timestampadd(SECOND, cast(l_partkey * 37 % 86400 + l_linenumber * 3600 as int),
                            cast(l_shipdate as timestamp_ntz)) AS updated_at""",
        )
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as landed text, four files, with every kind of fault."""
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr(
            "*",
            "cast(cast(round(l_extendedprice * 100) as bigint) % 5000 - 50 as string) AS cents",
            "cast(l_suppkey % 20 as string) AS m",
        )
        .selectExpr(
            """CASE WHEN l_partkey % 211 = 0 THEN 'NULL'
                    ELSE concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))
               END AS transaction_uuid""",
            """CASE WHEN l_partkey % 101 = 0 THEN '3000000000'
                    ELSE cast(l_suppkey % 15 as string) END AS merchant_account_id""",
            "CASE WHEN l_partkey % 97 = 0 THEN 'NONE' ELSE concat('Merchant ', m) END AS merchant_name",
            """CASE WHEN l_suppkey % 41 = 0 THEN '' WHEN l_partkey % 53 = 0 THEN 'abc'
                    WHEN l_partkey % 59 = 0 THEN concat(m, '.0')
                    WHEN l_partkey % 103 = 0 THEN concat(m, '.5') ELSE m END AS mid""",
            "'g' AS gateway_merchant_id",
            """CASE WHEN l_partkey % 61 = 0 THEN 'n/a' WHEN l_partkey % 67 = 0 THEN concat(cents, '.5')
                    WHEN l_partkey % 71 = 0 THEN concat(cents, '.00')
                    WHEN l_partkey % 73 = 0 THEN concat(cents, '.125')
                    WHEN l_partkey % 37 = 0 THEN 'ten' ELSE cents END AS amount""",
            "CASE WHEN l_partkey % 89 = 0 THEN 'US DOLLARS ONLY' ELSE 'USD' END AS currency",
            """CASE WHEN l_partkey % 79 = 0 THEN ' ' WHEN l_returnflag = 'R' THEN cents
                    ELSE '0' END AS refunded_amount""",
            "CASE WHEN l_linestatus = 'F' THEN 'succeeded' ELSE 'failed' END AS status",
            "'visa' AS source_brand",
            "concat('00', cast(l_partkey % 1000 as string)) AS source_first6",
            "CASE WHEN l_partkey % 5 = 0 THEN 'VISA' ELSE cast(l_partkey as string) END AS payment_method_details",
            """CASE WHEN l_partkey % 107 = 0 THEN 'yesterday'
                    ELSE cast(timestampadd(SECOND, cast(l_partkey * 37 % 86400 as int),
                                           cast(l_shipdate as timestamp_ntz)) as string)
               END AS transaction_date""",
            """CASE WHEN l_partkey % 83 = 0 THEN 'null' WHEN l_returnflag = 'A' THEN 'void'
                    WHEN l_returnflag = 'R' THEN 'refund' ELSE 'charge' END AS transaction_type""",
            "'api' AS user_source",
            "'1994-01-01 00:00:00' AS SourceAccountCreated",
            "'' AS created_at",
            "cast(cast(l_shipdate as timestamp_ntz) as string) AS updated_at",
            "concat('file-', cast(l_suppkey % 4 as string)) AS source_file",
            "l_partkey AS source_block",
            """cast(round(l_extendedprice * 100) as bigint) * 1000 + cast(l_quantity as bigint) * 10
               + l_suppkey % 10 AS source_row""",
        )
    )


def merchant_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accounts, groups and contact users."""
    accounts = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "cast(c_nationkey as bigint) AS merchant_id",
        "c_custkey % 13 AS location_contact_user_id",
        "concat('Account ', cast(c_custkey as string)) AS name",
        "concat('G', cast(c_custkey as string)) AS gateway_id",
        "c_name AS uuid",
        "c_custkey * 10 AS mid",
        "concat('GM', cast(c_nationkey as string)) AS gateway_merchant_id",
        "c_custkey + 7 AS fiserv_sales_id",
        "concat(cast(c_custkey as string), ' Main St') AS address_line1",
        "'Springfield' AS address_city",
        "'IL' AS address_state",
        "concat('0', cast(c_custkey as string)) AS address_postal_code",
        """timestampadd(DAY, cast(c_custkey % 365 as int), timestamp_ntz'2020-01-01 00:00:00')
           AS created_at""",
        """CASE WHEN c_mktsegment = 'MACHINERY' THEN 'closed'
                WHEN c_mktsegment = 'BUILDING' THEN 'ACTIVE' ELSE 'active' END AS status""",
    )
    groups = table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as bigint) AS id",
        "cast(n_nationkey * 100 as bigint) AS merchant_group_id",
        """CASE n_nationkey % 6 WHEN 0 THEN concat('Test ', n_name) WHEN 1 THEN concat(n_name, ' Team')
                WHEN 2 THEN concat('Contest ', n_name) WHEN 3 THEN concat('Team ', n_name)
                WHEN 4 THEN NULL ELSE n_name END AS name""",
        "concat('PO Box ', cast(n_nationkey as string)) AS address_line1",
        "n_name AS address_city",
        "cast(n_regionkey as string) AS address_state",
        "cast(10000 + n_nationkey as string) AS address_postal_code",
        "CASE WHEN n_nationkey % 5 = 0 THEN 'CLOSED' ELSE 'ACTIVE' END AS status",
    )
    users = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id",
        "concat(s_name, '@example.org') AS email",
        "s_name AS first_name",
        "cast(s_nationkey as string) AS last_name",
    )
    return accounts, groups, users


def landed_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant rows as landed text with faults, one per customer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_custkey % 11 = 0 THEN 'x1' ELSE cast(c_nationkey as string) END AS MerchantGroupID",
        "CASE WHEN c_custkey % 7 = 0 THEN 'None' ELSE c_mktsegment END AS MerchantGroupName",
        "'NONE' AS MerchantGroupAddress",
        "' ' AS MerchantGroupCity",
        "'IL' AS MerchantGroupState",
        "concat('00', cast(c_nationkey as string)) AS MerchantGroupZip",
        """CASE WHEN c_custkey % 17 = 0 THEN concat(cast(c_custkey as string), '.0')
                WHEN c_custkey % 29 = 0 THEN '' ELSE cast(c_custkey as string)
           END AS MerchantAccountDatabaseID""",
        "c_name AS MerchantAccountName",
        "cast(NULL as string) AS MerchantAccountGatewayID",
        "'null' AS MerchantAccountUUID",
        """CASE WHEN c_custkey % 19 = 0 THEN '12.5' ELSE cast(c_custkey * 10 as string)
           END AS MerchantAccountMID""",
        "'GM' AS MerchantAccountGatewayMerchantID",
        "'' AS MerchantAccountFiservSalesID",
        "'1 Main St' AS MerchantAccountAddress",
        "'Springfield' AS MerchantAccountCity",
        """CASE WHEN c_custkey % 23 = 0 THEN repeat('IL', 26) ELSE 'IL' END AS MerchantAccountState""",
        "'01234' AS MerchantAccountZip",
        """CASE WHEN c_custkey % 13 = 0 THEN 'soon' ELSE '2020-02-29 10:11:12'
           END AS MerchantAccountCreated""",
        "concat(c_name, '@example.org') AS ContactEmail",
        "'Jo' AS ContactFirstName",
        "'nan' AS ContactLastName",
    )


def id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pasted identifier list per order."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS list_id",
        """concat('00', cast(o_orderkey as string), ', ', cast(o_custkey as string), ';;',
                  CASE WHEN o_orderkey % 5 = 0 THEN '000' ELSE '' END, ' ',
                  cast(o_orderkey % 7 as string),
                  CASE WHEN o_orderkey % 3 = 0 THEN ',' ELSE '' END) AS id_text""",
    )
