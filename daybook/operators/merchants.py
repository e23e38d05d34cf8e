"""The joined listing of active merchant accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Output column and the source column behind it, per table.
_GROUP_COLUMNS = (
    ("MerchantGroupID", "merchant_group_id"),
    ("MerchantGroupName", "name"),
    ("MerchantGroupAddress", "address_line1"),
    ("MerchantGroupCity", "address_city"),
    ("MerchantGroupState", "address_state"),
    ("MerchantGroupZip", "address_postal_code"),
)
_ACCOUNT_COLUMNS = (
    ("MerchantAccountDatabaseID", "id"),
    ("MerchantAccountName", "name"),
    ("MerchantAccountGatewayID", "gateway_id"),
    ("MerchantAccountUUID", "uuid"),
    ("MerchantAccountMID", "mid"),
    ("MerchantAccountGatewayMerchantID", "gateway_merchant_id"),
    ("MerchantAccountFiservSalesID", "fiserv_sales_id"),
    ("MerchantAccountAddress", "address_line1"),
    ("MerchantAccountCity", "address_city"),
    ("MerchantAccountState", "address_state"),
    ("MerchantAccountZip", "address_postal_code"),
    ("MerchantAccountCreated", "created_at"),
)
_USER_COLUMNS = (
    ("ContactEmail", "email"),
    ("ContactFirstName", "first_name"),
    ("ContactLastName", "last_name"),
)


def _renamed(df: DataFrame, columns, **keys: str) -> DataFrame:
    return df.select(
        *(F.col(source).alias(name) for name, source in columns),
        *(F.col(source).alias(name) for name, source in keys.items()),
    )


def merchant_export(accounts: DataFrame, groups: DataFrame, users: DataFrame) -> DataFrame:
    """Active accounts of active groups with their contact, 21 columns.

    Status and name tests ignore letter case. Groups without a name, with
    "test" anywhere in it or "Team" at its end are left out, as are accounts
    without a contact. Sorted by group name and account name; the account id
    breaks ties, so equal names do not have to share a task.
    """
    active = F.lower("status") == "active"
    kept_groups = groups.where(
        active & ~F.col("name").ilike("%test%") & ~F.col("name").ilike("%Team")
    )
    listed = (
        _renamed(accounts.where(active), _ACCOUNT_COLUMNS, _group="merchant_id", _user="location_contact_user_id")
        .join(_renamed(kept_groups, _GROUP_COLUMNS, _group="id"), "_group")
        .join(_renamed(users, _USER_COLUMNS, _user="id"), "_user")
    )
    names = [name for name, _ in (*_GROUP_COLUMNS, *_ACCOUNT_COLUMNS, *_USER_COLUMNS)]
    return listed.select(*names).orderBy(
        F.lower("MerchantGroupName"), F.lower("MerchantAccountName"), "MerchantAccountDatabaseID"
    )
