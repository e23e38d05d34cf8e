"""The same results as SQL over the test tables.

Day figures come from a ledger by kind, first dates from ranks, running sums
from joins with earlier rows: ways that the operators do not take, so that a
slip in one is not repeated in the other.
"""

from __future__ import annotations

from daybook.schemas import MERCHANT_COLUMNS, TRANSACTION_COLUMNS
from workload.queries import AS_OF, CUT, EARLY_CUT, FILLED, REFRESHED, RUN, STORED_BEFORE, WINDOW

# --- derived tables ----------------------------------------------------------

TX = """
base AS (SELECT *, cast(round(l_extendedprice * 100) AS bigint) AS cents FROM lineitem),
tx AS (
  SELECT concat(cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar)) AS transaction_uuid,
    cast(l_suppkey % 15 AS integer) AS merchant_account_id,
    CASE WHEN l_partkey % 97 = 0 THEN NULL
         ELSE concat('Merchant ', cast(l_suppkey % 20 AS varchar),
                     CASE WHEN l_partkey % 7 = 0 THEN ' LLC' ELSE '' END) END AS merchant_name,
    CASE WHEN l_suppkey % 41 = 0 THEN NULL ELSE l_suppkey % 20 END AS mid,
    cast(cents % 5000 - 50 AS decimal(18,2)) AS amount,
    cast(CASE WHEN l_returnflag = 'R' AND l_linenumber <= 3 THEN cents % 3000 ELSE 0 END
         AS decimal(18,2)) AS refunded_amount,
    CASE WHEN l_linestatus = 'F' OR l_quantity > 15 THEN 'succeeded' ELSE 'failed' END AS status,
    l_shipdate + to_seconds(l_partkey * 37 % 86400) AS transaction_date,
    CASE WHEN l_returnflag = 'R' AND l_linenumber <= 3 THEN 'refund'
         WHEN l_returnflag = 'A' AND l_linenumber <= 2 THEN 'void' ELSE 'charge' END AS transaction_type,
    timestamp '1994-01-01 00:00:00' + to_days(cast(l_suppkey % 365 AS integer)) AS "SourceAccountCreated",
    l_shipdate + to_seconds(l_partkey * 37 % 86400 + l_linenumber * 3600) AS updated_at
  FROM base)
"""

FIRST_ORDER = """transaction_date NULLS FIRST, amount NULLS FIRST, refunded_amount NULLS FIRST,
    merchant_account_id NULLS FIRST, mid NULLS FIRST, merchant_name NULLS FIRST, status NULLS FIRST,
    transaction_type NULLS FIRST, "SourceAccountCreated" NULLS FIRST"""

LANDED = """
rawbase AS (
  SELECT *, cast(cast(round(l_extendedprice * 100) AS bigint) % 5000 - 50 AS varchar) AS cents,
    cast(l_suppkey % 20 AS varchar) AS m FROM lineitem),
landed AS (
  SELECT
    CASE WHEN l_partkey % 211 = 0 THEN 'NULL'
         ELSE concat(cast(l_orderkey AS varchar), '-', cast(l_linenumber AS varchar)) END AS transaction_uuid,
    CASE WHEN l_partkey % 101 = 0 THEN '3000000000' ELSE cast(l_suppkey % 15 AS varchar) END AS merchant_account_id,
    CASE WHEN l_partkey % 97 = 0 THEN 'NONE' ELSE concat('Merchant ', m) END AS merchant_name,
    CASE WHEN l_suppkey % 41 = 0 THEN '' WHEN l_partkey % 53 = 0 THEN 'abc'
         WHEN l_partkey % 59 = 0 THEN concat(m, '.0')
         WHEN l_partkey % 103 = 0 THEN concat(m, '.5') ELSE m END AS mid,
    CASE WHEN l_partkey % 61 = 0 THEN 'n/a' WHEN l_partkey % 67 = 0 THEN concat(cents, '.5')
         WHEN l_partkey % 71 = 0 THEN concat(cents, '.00')
         WHEN l_partkey % 73 = 0 THEN concat(cents, '.125')
         WHEN l_partkey % 37 = 0 THEN 'ten' ELSE cents END AS amount,
    CASE WHEN l_partkey % 89 = 0 THEN 'US DOLLARS ONLY' ELSE 'USD' END AS currency,
    CASE WHEN l_partkey % 79 = 0 THEN ' ' WHEN l_returnflag = 'R' THEN cents ELSE '0' END AS refunded_amount,
    CASE WHEN l_linestatus = 'F' THEN 'succeeded' ELSE 'failed' END AS status,
    concat('00', cast(l_partkey % 1000 AS varchar)) AS source_first6,
    CASE WHEN l_partkey % 5 = 0 THEN 'VISA' ELSE cast(l_partkey AS varchar) END AS payment_method_details,
    CASE WHEN l_partkey % 107 = 0 THEN 'yesterday'
         ELSE strftime(l_shipdate + to_seconds(l_partkey * 37 % 86400), '%Y-%m-%d %H:%M:%S') END AS transaction_date,
    CASE WHEN l_partkey % 83 = 0 THEN 'null' WHEN l_returnflag = 'A' THEN 'void'
         WHEN l_returnflag = 'R' THEN 'refund' ELSE 'charge' END AS transaction_type,
    l_shipdate AS updated_at,
    concat('file-', cast(l_suppkey % 4 AS varchar)) AS source_file,
    l_partkey AS source_block,
    cast(round(l_extendedprice * 100) AS bigint) * 1000 + cast(l_quantity AS bigint) * 10
      + l_suppkey % 10 AS source_row
  FROM rawbase)
"""


def typed(compat: bool = False) -> str:
    """Cleaned landed rows; the faults are those the landed table holds."""
    zero = "0" if compat else "NULL"
    return (
        LANDED
        + f""", numbered AS (
  SELECT *, try_cast(mid AS decimal(38,6)) AS mid_n, try_cast(amount AS decimal(38,6)) AS amount_n
  FROM landed),
typed AS (
  SELECT nullif(transaction_uuid, 'NULL') AS transaction_uuid,
    CASE WHEN merchant_account_id = '3000000000' THEN {zero}
         ELSE cast(merchant_account_id AS integer) END AS merchant_account_id,
    nullif(merchant_name, 'NONE') AS merchant_name,
    CASE WHEN mid_n IS NULL OR mid_n <> floor(mid_n) THEN {zero} ELSE cast(mid_n AS bigint) END AS mid,
    cast(coalesce(CASE WHEN amount_n < 0 THEN -floor(-amount_n * 100 + 0.5) / 100
                       ELSE floor(amount_n * 100 + 0.5) / 100 END, 0) AS decimal(18,2)) AS amount,
    currency,
    cast(coalesce(try_cast(nullif(refunded_amount, ' ') AS decimal(18,2)), 0) AS decimal(18,2)) AS refunded_amount,
    status,
    {"cast(cast(source_first6 AS bigint) AS varchar)" if compat else "source_first6"} AS source_first6,
    {"CASE WHEN payment_method_details = 'VISA' THEN '0' ELSE payment_method_details END"
     if compat else "payment_method_details"} AS payment_method_details,
    try_cast(transaction_date AS timestamp) AS transaction_date,
    nullif(transaction_type, 'null') AS transaction_type,
    cast(NULL AS timestamp) AS created_at,
    updated_at,
    CASE WHEN transaction_uuid = 'NULL' THEN 'transaction_uuid: missing'
         WHEN merchant_account_id = '3000000000' THEN 'merchant_account_id: out of range'
         WHEN mid_n <> floor(mid_n) THEN 'mid: not whole'
         WHEN amount_n <> floor(amount_n) THEN 'amount: fraction of a cent'
         WHEN transaction_date = 'yesterday' THEN 'transaction_date: not a date'
         WHEN length(currency) > 10 THEN 'currency: longer than 10' END AS reject_reason,
    source_file, source_block, source_row
  FROM numbered)
"""
    )


TYPED_COLUMNS = """transaction_uuid, merchant_account_id, merchant_name, mid, amount, currency,
  refunded_amount, status, source_first6, payment_method_details, transaction_date,
  transaction_type, created_at, updated_at"""

SOURCES = """
accounts AS (
  SELECT c_custkey AS id, cast(c_nationkey AS bigint) AS merchant_id, c_custkey % 13 AS contact,
    concat('Account ', cast(c_custkey AS varchar)) AS name, c_name, c_custkey, c_nationkey,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'closed'
         WHEN c_mktsegment = 'BUILDING' THEN 'ACTIVE' ELSE 'active' END AS status
  FROM customer),
grps AS (
  SELECT cast(n_nationkey AS bigint) AS id,
    CASE n_nationkey % 6 WHEN 0 THEN concat('Test ', n_name) WHEN 1 THEN concat(n_name, ' Team')
      WHEN 2 THEN concat('Contest ', n_name) WHEN 3 THEN concat('Team ', n_name)
      WHEN 4 THEN NULL ELSE n_name END AS name,
    CASE WHEN n_nationkey % 5 = 0 THEN 'CLOSED' ELSE 'ACTIVE' END AS status, n_nationkey, n_name, n_regionkey
  FROM nation),
listing AS (
  SELECT cast(g.n_nationkey * 100 AS bigint) AS "MerchantGroupID", g.name AS "MerchantGroupName",
    concat('PO Box ', cast(g.n_nationkey AS varchar)) AS "MerchantGroupAddress",
    g.n_name AS "MerchantGroupCity", cast(g.n_regionkey AS varchar) AS "MerchantGroupState",
    cast(10000 + g.n_nationkey AS varchar) AS "MerchantGroupZip",
    a.id AS "MerchantAccountDatabaseID", a.name AS "MerchantAccountName",
    concat('G', cast(a.c_custkey AS varchar)) AS "MerchantAccountGatewayID",
    a.c_name AS "MerchantAccountUUID", a.c_custkey * 10 AS "MerchantAccountMID",
    concat('GM', cast(a.c_nationkey AS varchar)) AS "MerchantAccountGatewayMerchantID",
    a.c_custkey + 7 AS "MerchantAccountFiservSalesID",
    concat(cast(a.c_custkey AS varchar), ' Main St') AS "MerchantAccountAddress",
    'Springfield' AS "MerchantAccountCity", 'IL' AS "MerchantAccountState",
    concat('0', cast(a.c_custkey AS varchar)) AS "MerchantAccountZip",
    timestamp '2020-01-01 00:00:00' + to_days(cast(a.c_custkey % 365 AS integer)) AS "MerchantAccountCreated",
    concat(u.s_name, '@example.org') AS "ContactEmail", u.s_name AS "ContactFirstName",
    cast(u.s_nationkey AS varchar) AS "ContactLastName"
  FROM accounts a JOIN grps g ON g.id = a.merchant_id JOIN supplier u ON u.s_suppkey = a.contact
  WHERE lower(a.status) = 'active' AND lower(g.status) = 'active'
    AND g.name NOT ILIKE '%test%' AND g.name NOT ILIKE '%team')
"""

MERCHANTS_TYPED = """
clean AS (
  SELECT
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE cast(c_nationkey AS bigint) END AS "MerchantGroupID",
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS "MerchantGroupName",
    'NONE' AS "MerchantGroupAddress", cast(NULL AS varchar) AS "MerchantGroupCity",
    'IL' AS "MerchantGroupState", concat('00', cast(c_nationkey AS varchar)) AS "MerchantGroupZip",
    CASE WHEN c_custkey % 17 <> 0 AND c_custkey % 29 = 0 THEN NULL
         ELSE cast(c_custkey AS integer) END AS "MerchantAccountDatabaseID",
    c_name AS "MerchantAccountName", cast(NULL AS varchar) AS "MerchantAccountGatewayID",
    cast(NULL AS varchar) AS "MerchantAccountUUID",
    CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_custkey * 10 END AS "MerchantAccountMID",
    'GM' AS "MerchantAccountGatewayMerchantID", cast(NULL AS bigint) AS "MerchantAccountFiservSalesID",
    '1 Main St' AS "MerchantAccountAddress", 'Springfield' AS "MerchantAccountCity",
    CASE WHEN c_custkey % 23 = 0 THEN repeat('IL', 26) ELSE 'IL' END AS "MerchantAccountState",
    '01234' AS "MerchantAccountZip",
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE timestamp '2020-02-29 10:11:12' END AS "MerchantAccountCreated",
    concat(c_name, '@example.org') AS "ContactEmail", 'Jo' AS "ContactFirstName",
    cast(NULL AS varchar) AS "ContactLastName",
    CASE WHEN c_custkey % 17 <> 0 AND c_custkey % 29 = 0 THEN 'MerchantAccountDatabaseID: missing'
         WHEN c_custkey % 19 = 0 THEN 'MerchantAccountMID: not whole'
         WHEN c_custkey % 23 = 0 THEN 'MerchantAccountState: longer than 50' END AS reject_reason
  FROM customer)
"""

# --- daily metrics -----------------------------------------------------------

OK = "status = 'succeeded'"


def bound(before: object = None, start: object = None) -> str:
    text = "transaction_date IS NOT NULL AND mid IS NOT NULL"
    if before:
        text += f" AND cast(transaction_date AS date) < date '{before}'"
    if start:
        text += f" AND cast(transaction_date AS date) >= date '{start}'"
    return text


def first(name: str, before: object = None, start: object = None) -> str:
    """The earliest row of each mid, by rank; mids without one stay."""

    def earliest(above: int) -> str:
        return f"""(SELECT mid, transaction_date FROM tx
      WHERE {bound(before, start)} AND {OK} AND amount > {above}
      QUALIFY row_number() OVER (PARTITION BY mid ORDER BY transaction_date) = 1)"""

    return f"""{name} AS (
  SELECT m.mid, paid.transaction_date AS first_transaction_date,
    business.transaction_date AS first_business_transaction_date
  FROM (SELECT DISTINCT mid FROM tx WHERE {bound(before, start)}) m
  LEFT JOIN {earliest(0)} paid ON paid.mid = m.mid
  LEFT JOIN {earliest(1000)} business ON business.mid = m.mid)"""


def daily(name: str, before: object = None, start: object = None) -> str:
    """A ledger with one entry for each transaction, added up by kind and laid beside the days."""
    entry = "day, mid, merchant_name"
    side = lambda kind: f"""LEFT JOIN {name}_kinds {kind} ON {kind}.kind = '{kind}' AND {kind}.day = d.day
    AND {kind}.mid = d.mid AND {kind}.merchant_name = d.merchant_name"""  # noqa: E731
    dollars = lambda kind: f"coalesce({kind}.cents, 0) * 0.01"
    number = lambda kind: f"coalesce({kind}.n, 0)"
    return f"""{name}_ledger AS (
  SELECT cast(transaction_date AS date) AS day, mid, merchant_name, "SourceAccountCreated",
    CASE WHEN {OK} THEN transaction_type END AS kind,
    CASE transaction_type WHEN 'refund' THEN refunded_amount ELSE amount END AS cents
  FROM tx WHERE {bound(before, start)} AND merchant_name IS NOT NULL),
{name}_kinds AS (
  SELECT {entry}, kind, sum(cents) AS cents, sum(CASE sign(cents) WHEN 1 THEN 1 ELSE 0 END) AS n
  FROM {name}_ledger GROUP BY {entry}, kind),
{name} AS (
  SELECT d.*, {dollars('charge')} AS amount_sum, cast({number('charge')} AS integer) AS amount_count,
    {dollars('refund')} AS refund_sum, cast({number('refund')} AS integer) AS refund_count,
    {dollars('void')} AS void_sum, cast({number('void')} AS integer) AS voidcount,
    (coalesce(charge.cents, 0) - coalesce(refund.cents, 0)) * 0.01 AS total,
    cast({number('charge')} + {number('refund')} AS integer) AS totalcount
  FROM (SELECT {entry}, max("SourceAccountCreated") AS "sourceAccountCreated" FROM {name}_ledger GROUP BY {entry}) d
  {side('charge')} {side('refund')} {side('void')})"""


def running(name: str, source: str) -> str:
    """Each row beside all rows of its mid and year that are not later."""
    return f"""{name} AS (
  SELECT own.*, sums.mtd_total, sums.ytd_total FROM {source} own JOIN (
    SELECT a.mid, a.day, a.merchant_name, sum(b.total) AS ytd_total,
      sum(CASE WHEN month(b.day) = month(a.day) THEN b.total END) AS mtd_total
    FROM {source} a JOIN {source} b ON b.mid = a.mid AND year(b.day) = year(a.day)
      AND (b.day < a.day OR b.day = a.day AND b.merchant_name <= a.merchant_name)
    GROUP BY a.mid, a.day, a.merchant_name) sums USING (mid, day, merchant_name))"""


def sunk(name: str, source: str, first_name: str) -> str:
    """Rows in the form of the stored table."""
    money = ("amount_sum", "refund_sum", "void_sum", "total", "mtd_total", "ytd_total")
    rounded = ", ".join(f"cast(round(r.{c}, 2) AS decimal(18,2)) AS {c}" for c in money)
    return f"""{name} AS (
  SELECT r.day, cast(r.mid AS varchar) AS mid, r.merchant_name, r."sourceAccountCreated", {rounded},
    r.amount_count, r.refund_count, r.voidcount, r.totalcount,
    f.first_transaction_date, f.first_business_transaction_date
  FROM {source} r LEFT JOIN {first_name} f ON f.mid = r.mid)"""


def refreshed(before: object) -> str:
    return ", ".join(
        (TX, first("mfd", before), daily("da", before), running("rt", "da"), sunk("stored", "rt", "mfd"))
    )


def updated(before: object, lookback: int = 0) -> str:
    """A table stored before a cut, then brought up to date from its watermark."""
    wm = f"(SELECT max(day) - {lookback} FROM stored)"
    return ", ".join(
        (
            refreshed(before),
            f"wm AS (SELECT {wm} AS day)",
            first("mfd_all"),
            daily("da_all"),
            f"""joined AS (
  SELECT day, mid, merchant_name, total FROM da_all WHERE day >= {wm}
  UNION ALL
  SELECT day, cast(mid AS bigint), merchant_name, total FROM stored WHERE day < {wm})""",
            running("rt_all", "joined"),
            f"""fresh AS (
  SELECT d.*, r.mtd_total, r.ytd_total FROM da_all d
  JOIN rt_all r ON r.day = d.day AND r.mid = d.mid AND r.merchant_name = d.merchant_name
  WHERE d.day >= {wm})""",
            sunk("fresh_rows", "fresh", "mfd_all"),
            f"""result AS (
  SELECT {columns(REFRESHED)} FROM stored s WHERE s.day < {wm} OR NOT EXISTS (
    SELECT 1 FROM fresh f WHERE f.day = s.day AND cast(f.mid AS varchar) = s.mid)
  UNION ALL
  SELECT {columns(REFRESHED)} FROM fresh_rows)""",
        )
    )


def columns(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


def dec4(*names: str) -> str:
    return ", ".join(f"cast({n} AS decimal(18,4)) AS {n}" for n in names)


REFRESHED_SQL = columns(REFRESHED)
FILLED_SQL = columns(FILLED)

SUMMARY = """SELECT min(day) AS earliest_date, max(day) AS latest_date, count(*) AS total_records,
  count(DISTINCT mid) AS unique_merchants, sum(amount_sum) AS total_amount,
  cast(sum(amount_count) AS bigint) AS total_amount_transactions, sum(refund_sum) AS total_refunds,
  cast(sum(refund_count) AS bigint) AS total_refund_transactions, sum(void_sum) AS total_voids,
  cast(sum(voidcount) AS bigint) AS total_void_transactions, sum(total) AS net_total,
  min(first_transaction_date) AS earliest_transaction,
  min(first_business_transaction_date) AS earliest_business_transaction FROM stored"""

RANKED = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_uuid ORDER BY {FIRST_ORDER}) AS pick,
    count(*) OVER (PARTITION BY transaction_uuid) AS copies FROM tx)"""

# The transactions with one row per key, in place of all of them.
UNIQUE_TX = (
    TX.replace("\ntx AS (", "\nall_tx AS (").rstrip()
    + ", "
    + RANKED.replace("FROM tx", "FROM all_tx")
    + ", tx AS (SELECT * EXCLUDE (pick, copies) FROM ranked WHERE pick = 1)"
)

LATER_FIRST = ", ".join(f'"{name}" DESC NULLS LAST' for name in FILLED)

STORED_KEYS = f"SELECT transaction_uuid FROM tx WHERE transaction_date < timestamp '{STORED_BEFORE} 00:00:00'"

# In each file the first row of a key; of the accepted ones the first file's.
LOADED = f"""{typed()}, {TX}, in_file AS (
  SELECT *, CASE WHEN transaction_uuid IS NULL THEN 1 ELSE row_number() OVER (
      PARTITION BY source_file, transaction_uuid ORDER BY source_block, source_row) END AS pick
  FROM typed),
kept AS (SELECT * FROM in_file WHERE pick = 1),
by_file AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_uuid ORDER BY source_file) AS file_pick
  FROM kept WHERE reject_reason IS NULL),
appended AS (SELECT * FROM by_file WHERE file_pick = 1 AND transaction_uuid NOT IN ({STORED_KEYS}))"""


def profile_sql() -> str:
    kinds = dict(TRANSACTION_COLUMNS)
    parts = []
    for name in FILLED:
        kind = "string" if kinds[name].startswith("varchar") else kinds[name]
        text = f'cast("{name}" AS varchar)'
        parts.append(
            f"""SELECT '{name}' AS column_name, '{kind}' AS data_type, count("{name}") AS filled_rows,
  count(*) - count("{name}") AS empty_rows,
  (SELECT string_agg(coalesce({text}, 'NULL'), ' | ' ORDER BY n) FROM top3) AS samples FROM tx"""
        )
    return f"""WITH {TX}, top3 AS (
  SELECT *, row_number() OVER (ORDER BY transaction_uuid, {FIRST_ORDER}) AS n FROM tx
  QUALIFY n <= 3)
""" + "\nUNION ALL\n".join(parts)


# --- identifier lists --------------------------------------------------------

TOKENS = """
lists AS (
  SELECT o_orderkey AS list_id,
    concat('00', cast(o_orderkey AS varchar), ', ', cast(o_custkey AS varchar), ';;',
      CASE WHEN o_orderkey % 5 = 0 THEN '000' ELSE '' END, ' ', cast(o_orderkey % 7 AS varchar),
      CASE WHEN o_orderkey % 3 = 0 THEN ',' ELSE '' END) AS id_text
  FROM orders),
split AS (
  SELECT list_id, list_filter(string_split_regex(id_text, '[\\s,;]+'), lambda t: t <> '') AS tokens FROM lists)
"""
STRIPPED = "CASE WHEN ltrim(t, '0') = '' THEN '0' ELSE ltrim(t, '0') END"


def ids(token: str, opening: str = "''", closing: str = "''") -> str:
    one = f"concat({opening}, {token}, {closing})"
    return f"""WITH {TOKENS}
SELECT list_id, array_to_string(list_transform(tokens, lambda t: {one}), ', ') AS formatted FROM split"""


def padded(token: str, width: int) -> str:
    return f"CASE WHEN length({token}) >= {width} THEN {token} ELSE lpad({token}, {width}, '0') END"


QUOTE, OPEN, CLOSE = "''''", "'('''", "''')'"

EXTRACT = f"updated_at <= timestamp '{WINDOW[1]}' AND merchant_account_id > 8"
EXTRACT_SINCE = f"updated_at > timestamp '{WINDOW[0]}' AND {EXTRACT}"

MONEY_PROBLEMS = "\nUNION ALL\n".join(
    f"""SELECT transaction_uuid, '{c}' AS column_name, {c} AS value,
  CASE WHEN {c} IN (' ', 'n/a') THEN 'missing'
       WHEN try_cast({c} AS decimal(38,6)) IS NULL THEN 'not a number'
       ELSE 'too many decimals' END AS problem
FROM landed WHERE {c} IN (' ', 'n/a') OR try_cast({c} AS decimal(38,6)) IS NULL
  OR regexp_matches({c}, '\\.\\d{{3,}}')"""
    for c in ("amount", "refunded_amount")
)

CONTROL_OF = """n AS (
  SELECT source_file, transaction_type = 'void' AS void, try_cast(amount AS decimal(28,4)) AS a,
    try_cast(refunded_amount AS decimal(28,4)) AS r FROM {rows})
SELECT source_file,
  cast(coalesce(sum(CASE WHEN void THEN a END), 0) * 0.01 AS decimal(38,6)) AS void_sum,
  count(CASE WHEN void AND a > 0 THEN 1 END) AS voidcount,
  cast(coalesce(sum(CASE WHEN NOT void THEN a END), 0) * 0.01 AS decimal(38,6)) AS amount_sum,
  count(CASE WHEN NOT void AND a > 0 THEN 1 END) AS amount_count,
  cast(coalesce(sum(CASE WHEN NOT void THEN r END), 0) * 0.01 AS decimal(38,6)) AS refund_sum,
  count(CASE WHEN NOT void AND r > 0 THEN 1 END) AS refund_count
FROM n GROUP BY source_file"""
CONTROL = f"WITH {LANDED}, {CONTROL_OF.format(rows='landed')}"

REPORT = f"""WITH {LOADED}
SELECT t.source_file, count(*) AS rows_read,
  (SELECT count(*) FROM appended a WHERE a.source_file = t.source_file) AS accepted_rows,
  (SELECT count(*) FROM by_file b WHERE b.source_file = t.source_file)
    - (SELECT count(*) FROM appended a WHERE a.source_file = t.source_file) AS duplicates_rows,
  cast(sum(CASE WHEN pick > 1 THEN 1 ELSE 0 END) AS bigint) AS repeated_in_file,
  cast(sum(CASE WHEN pick = 1 AND reject_reason IS NOT NULL THEN 1 ELSE 0 END) AS bigint) AS rejected_rows
FROM in_file t GROUP BY t.source_file"""

CONSTRAINTS = f"""WITH {TX}, found AS (
  SELECT 'not null' AS rule, 'mid' AS column_name, count(*) - count(mid) AS broken_rows FROM tx
  UNION ALL SELECT 'not null', 'merchant_name', count(*) - count(merchant_name) FROM tx
  UNION ALL SELECT 'not null', 'status', count(*) - count(status) FROM tx
  UNION ALL SELECT 'primary key', 'transaction_uuid', cast(coalesce(sum(n), 0) AS bigint) FROM (
    SELECT count(*) AS n FROM tx GROUP BY transaction_uuid HAVING count(*) > 1) AS repeated)
SELECT * FROM found WHERE broken_rows > 0"""

_INTS = {name: kind for name, kind in MERCHANT_COLUMNS if kind == "int"}
LISTING = ", ".join(
    f'cast("{n}" AS integer) AS "{n}"' if n in _INTS else f'"{n}"' for n, _ in MERCHANT_COLUMNS
)

ORACLES = {
    "full_refresh": f"WITH {refreshed(AS_OF)} SELECT {REFRESHED_SQL} FROM stored",
    "full_refresh_in_chunks": f"WITH {refreshed(AS_OF)} SELECT {REFRESHED_SQL} FROM stored",
    "first_dates": f"WITH {TX}, {first('f', AS_OF)} SELECT * FROM f",
    "first_dates_merged": f"WITH {TX}, {first('f')} SELECT * FROM f",
    "single_scan_first_dates": f"""WITH {TX}, {first('f', AS_OF)}, {daily('d', AS_OF)}
SELECT f.*, n.day_rows FROM f LEFT JOIN (SELECT mid, count(*) AS day_rows FROM d GROUP BY mid) n ON n.mid = f.mid""",
    "daily_aggregates": f"""WITH {TX}, {daily('d', AS_OF)}
SELECT day, mid, merchant_name, "sourceAccountCreated", {dec4('amount_sum', 'refund_sum', 'void_sum')},
  amount_count, refund_count, voidcount FROM d""",
    "daily_totals": f"""WITH {TX}, {first('f', AS_OF)}, {daily('d', AS_OF)}
SELECT d.day, d.mid, d.merchant_name, cast(d.total AS decimal(18,4)) AS total, d.totalcount,
  f.first_transaction_date, f.first_business_transaction_date FROM d LEFT JOIN f ON f.mid = d.mid""",
    "running_totals": f"""WITH {TX}, {daily('d')}, {running('r', 'd')}
SELECT day, mid, merchant_name, {dec4('total', 'mtd_total', 'ytd_total')} FROM r""",
    "opening_totals": f"""WITH {TX}, {daily('d')}, {running('r', 'd')}
SELECT day, mid, merchant_name, {dec4('mtd_total', 'ytd_total')} FROM r WHERE day >= date '{CUT}'""",
    "summary_full": f"WITH {refreshed(AS_OF)} {SUMMARY}",
    "distinct_day_mid": f"""WITH {TX} SELECT DISTINCT cast(transaction_date AS date) AS day, mid FROM tx
WHERE {bound()} AND merchant_name IS NOT NULL""",
    "watermark": f"WITH {refreshed(CUT)} SELECT coalesce(max(day), date '1900-01-01') AS last_processed FROM stored",
    "delete_pairs": f"""WITH {refreshed(CUT)} SELECT s.day, s.mid, s.merchant_name, s.total FROM stored s
WHERE NOT EXISTS (SELECT 1 FROM tx t WHERE t.merchant_name IS NOT NULL AND cast(t.mid AS varchar) = s.mid
  AND cast(t.transaction_date AS date) = s.day
  AND cast(t.transaction_date AS date) >= (SELECT max(day) FROM stored))""",
    "incremental_update": f"WITH {updated(CUT)} SELECT * FROM result",
    "incremental_stale_first_dates": f"WITH {updated(EARLY_CUT)} SELECT * FROM result",
    "incremental_lookback": f"WITH {updated(CUT, 40)} SELECT * FROM result",
    "incremental_from_empty": f"WITH {refreshed(None)} SELECT {REFRESHED_SQL} FROM stored",
    "summary_incremental": f"""WITH {updated(CUT)} SELECT min(day) AS earliest_date_processed,
  max(day) AS latest_date_processed, count(*) AS new_records_added,
  cast(sum(amount_count) AS bigint) AS new_amount_transactions,
  cast(sum(refund_count) AS bigint) AS new_refund_transactions FROM result
WHERE day >= (SELECT day FROM wm)""",
    "dynamic_overwrite": f"""WITH {updated(CUT)}, old AS (
  SELECT s.day, s.mid, s.merchant_name, row_number() OVER (ORDER BY day, cast(mid AS bigint), merchant_name) AS id
  FROM stored s),
new AS (
  SELECT day, mid, merchant_name, (SELECT max(id) FROM old)
    + row_number() OVER (ORDER BY day, cast(mid AS bigint), merchant_name) AS id FROM fresh_rows)
SELECT coalesce(n.id, o.id) AS id, {', '.join(f'r."{c}"' for c in REFRESHED)} FROM result r
LEFT JOIN old o ON o.day = r.day AND o.mid = r.mid AND o.merchant_name = r.merchant_name
LEFT JOIN new n ON n.day = r.day AND n.mid = r.mid AND n.merchant_name = r.merchant_name""",
    "surrogate_key": f"""WITH {TX}, {daily('d')}
SELECT row_number() OVER (ORDER BY day, mid, merchant_name) AS id, day, mid, merchant_name FROM d""",
    "merchant_export": f"WITH {SOURCES} SELECT * FROM listing",
    "replace_table": f"WITH {SOURCES} SELECT * FROM listing",
    "merchants_csv_load": f"WITH {SOURCES} SELECT {LISTING} FROM listing",
    "clean_merchants": f"WITH {MERCHANTS_TYPED} SELECT * FROM clean",
    "merchant_constraints": f"""WITH {MERCHANTS_TYPED}
SELECT 'not null' AS rule, 'MerchantAccountDatabaseID' AS column_name,
  count(*) - count("MerchantAccountDatabaseID") AS broken_rows FROM clean
HAVING count(*) - count("MerchantAccountDatabaseID") > 0""",
    "clean_transactions": f"WITH {typed()} SELECT {TYPED_COLUMNS}, reject_reason FROM typed",
    "clean_transactions_compat": f"WITH {typed(True)} SELECT {TYPED_COLUMNS}, reject_reason FROM typed",
    "rejects": f"""WITH {typed()} SELECT reject_reason, count(*) AS row_count FROM typed
WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
    "money_problems": f"WITH {LANDED} {MONEY_PROBLEMS}",
    "tidy_numbers": f"""WITH {LANDED} SELECT transaction_uuid, amount,
  cast(coalesce(CASE WHEN try_cast(amount AS decimal(38,6)) < 0
    THEN -floor(-try_cast(amount AS decimal(38,6)) * 100 + 0.5) / 100
    ELSE floor(try_cast(amount AS decimal(38,6)) * 100 + 0.5) / 100 END, 0) AS decimal(18,2)) AS tidy
FROM landed""",
    "column_profile": profile_sql(),
    "control_totals": CONTROL,
    "dedup_first": f"WITH {TX}, {RANKED} SELECT {FILLED_SQL}, copies FROM ranked WHERE pick = 1",
    "append_ignore": f"""WITH {TX}, {RANKED} SELECT {FILLED_SQL} FROM ranked
WHERE pick = 1 AND transaction_uuid NOT IN ({STORED_KEYS})""",
    "ignored_keys": f"""WITH {TX}, {RANKED} SELECT transaction_uuid FROM ranked
WHERE pick = 1 AND transaction_uuid IN ({STORED_KEYS})""",
    "load_transactions": f"WITH {LOADED} SELECT {TYPED_COLUMNS} FROM appended",
    "load_report": REPORT,
    "constraint_check": CONSTRAINTS,
    "extract_window": f"WITH {TX} SELECT {FILLED_SQL} FROM tx WHERE {EXTRACT_SINCE}",
    "extract_first_run": f"WITH {TX} SELECT {FILLED_SQL} FROM tx WHERE {EXTRACT}",
    "csv_round_trip": f"""WITH {TX} SELECT {FILLED_SQL}, cast(NULL AS varchar) AS reject_reason
FROM tx WHERE {EXTRACT_SINCE}""",
    "stream_daily": f"WITH {refreshed(None).replace(TX, UNIQUE_TX)} SELECT {REFRESHED_SQL} FROM stored",
    "stream_report": f"""WITH {TX} SELECT count(*) AS rows_read,
  count(DISTINCT transaction_uuid) AS accepted_rows, cast(0 AS bigint) AS duplicates_rows,
  count(*) - count(DISTINCT transaction_uuid) AS repeated_in_file, cast(0 AS bigint) AS rejected_rows FROM tx""",
    "load_control_totals": f"""WITH {LANDED}, picked AS (
  SELECT *, CASE WHEN transaction_uuid = 'NULL' THEN 1 ELSE row_number() OVER (
      PARTITION BY source_file, transaction_uuid ORDER BY source_block, source_row) END AS pick FROM landed),
{CONTROL_OF.format(rows='picked WHERE pick = 1')}""",
    "upsert_transactions": f"""WITH {TX}, {RANKED}, versions AS (
  SELECT {FILLED_SQL}, 0 AS stored FROM tx UNION ALL
  SELECT {FILLED_SQL}, 1 FROM ranked WHERE pick = 1 AND transaction_date < timestamp '{STORED_BEFORE} 00:00:00')
SELECT {FILLED_SQL} FROM versions QUALIFY row_number() OVER (PARTITION BY transaction_uuid
  ORDER BY updated_at DESC NULLS LAST, stored DESC, {LATER_FIRST}) = 1""",
    "stream_ingest": f"WITH {TX}, {RANKED} SELECT {FILLED_SQL} FROM ranked WHERE pick = 1",
    "id_list_quoted": ids("t", QUOTE, QUOTE),
    "id_list_bracketed": ids("t", OPEN, CLOSE),
    "id_list_plain": ids("t"),
    "id_strip": ids(STRIPPED, QUOTE, QUOTE),
    "id_pad": ids(padded("t", 5)),
    "id_strip_and_pad": ids(padded(STRIPPED, 12), OPEN, CLOSE),
    "id_tokens": f"""WITH {TOKENS} SELECT list_id, cast(generate_subscripts(tokens, 1) - 1 AS integer) AS position,
  unnest(tokens) AS token FROM split""",
}
ORACLES["running_totals_in_chunks"] = ORACLES["running_totals"]
for name, same in (
    ("upsert_stored", "upsert_transactions"),
    ("append_indexed", "append_ignore"),
    ("update_from_table", "dynamic_overwrite"),
    ("catalog_daily", "dynamic_overwrite"),
    ("extract_in_splits", "extract_window"),
):
    ORACLES[name] = ORACLES[same]
_LANDED_COLUMNS = """transaction_uuid, merchant_account_id, merchant_name, mid, amount, refunded_amount, status,
  transaction_date, transaction_type, updated_at"""
ORACLES["catalog_load"] = f"""WITH {LOADED} SELECT {_LANDED_COLUMNS} FROM appended
UNION ALL SELECT {_LANDED_COLUMNS} FROM tx WHERE transaction_date < timestamp '{STORED_BEFORE} 00:00:00'"""
ORACLES["merchant_export_positions"] = f"""WITH {SOURCES} SELECT row_number() OVER (
  ORDER BY lower("MerchantGroupName") NULLS FIRST, lower("MerchantAccountName") NULLS FIRST,
    "MerchantAccountDatabaseID") AS position, "MerchantAccountDatabaseID" FROM listing"""
ORACLES["daily_aggregates_ignoring_case"] = f"""WITH {TX}, {daily('d', AS_OF)}
SELECT day, mid, lower(merchant_name) AS merchant_name, {dec4('amount_sum', 'refund_sum', 'void_sum')},
  amount_count, refund_count, voidcount FROM d"""
