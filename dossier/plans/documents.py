"""Customer documents: flat customers, accounts and addresses, nested per customer."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.address import address_fields, is_malformed
from dossier.functions.balance import cast_balance
from dossier.functions.checks import check_mode, require
from dossier.operators.nesting import Children, attach_children
from dossier.schemas import (
    ACCOUNT,
    ADDRESS,
    ADDRESS_RAW,
    CUSTOMER,
    CUSTOMER_ACCOUNT,
    CUSTOMER_DOCUMENT,
    CUSTOMER_MODEL,
    CUSTOMER_STATS,
)
from dossier.sources.binding import conform

KEY = "customerId"


def account_rows(accounts: DataFrame, mode: str) -> DataFrame:
    return cast_balance(accounts, mode).select(ACCOUNT.fieldNames())


def _accounts(accounts: DataFrame, mode: str) -> Children:
    return Children(account_rows(accounts, mode), "accounts", ACCOUNT.fieldNames())


def _addresses(addresses: DataFrame, mode: str) -> Children:
    """Addresses to be parsed once they are grouped by customer.

    A malformed one is no error yet, as its customer may be unknown: the fault
    travels with the group, to be raised by ``require_addresses``.
    """
    check_mode(mode)
    strict = mode == "strict"

    def parse(rows: DataFrame) -> DataFrame:
        parsed = rows.withColumns(address_fields())
        return parsed.withColumn("malformed", is_malformed()) if strict else parsed

    return Children(
        addresses.select(ADDRESS_RAW.fieldNames()),
        "address",
        ADDRESS.fieldNames(),
        totals={"malformed": F.max("malformed")} if strict else {},
        finish=parse,
    )


def require_addresses(rows: DataFrame) -> DataFrame:
    """``rows``, none of which is ``malformed``; the job fails on others."""
    return require(
        rows,
        ~F.coalesce(F.col("malformed"), F.lit(False)),
        F.concat(F.lit("malformed address of customer "), F.col(KEY)),
    )


def _totals() -> dict[str, Column]:
    return {"numberAccounts": F.count(F.lit(1)).cast("int"), "totalBalance": F.sum("balance")}


def _filled(stats: DataFrame) -> DataFrame:
    """Totals of customers without accounts as 0, and the mean."""
    number, total = F.col("numberAccounts"), F.col("totalBalance")
    return stats.withColumns(
        {
            "numberAccounts": F.coalesce(number, F.lit(0)),
            "totalBalance": F.coalesce(total, F.lit(0).cast("bigint")),
        }
    ).withColumn(
        # Not avg(): it rounds otherwise for totals beyond 2^53, and is null for no rows.
        "averageBalance",
        F.when(number == 0, F.lit(0.0)).otherwise(total.cast("double") / number),
    )


def build_customer_stats(
    customers: DataFrame, accounts: DataFrame, mode: str = "strict"
) -> DataFrame:
    """Every customer with the number of its accounts, their total and mean balance; no arrays.

    Accounts are added up before they are shuffled, so a customer may have any
    number of them. In strict mode a bad balance fails the job.
    """
    totals = (
        account_rows(accounts, mode)
        .groupBy(KEY)
        .agg(*[c.alias(name) for name, c in _totals().items()])
    )
    joined = customers.select(CUSTOMER.fieldNames()).join(totals, KEY, "left")
    return conform(_filled(joined), CUSTOMER_STATS)


def build_customer_accounts(
    customers: DataFrame, accounts: DataFrame, mode: str = "strict", **limits
) -> DataFrame:
    """Every customer with its accounts, their number, and their total and mean balance.

    In strict mode a bad balance fails the job, be its customer known or not.
    ``limits`` go to ``attach_children``, here and below.
    """
    kind = _accounts(accounts, mode)._replace(totals=_totals())
    attached = attach_children(customers.select(CUSTOMER.fieldNames()), KEY, [kind], **limits)
    return conform(_filled(attached), CUSTOMER_ACCOUNT)


def _as_documents(attached: DataFrame, mode: str) -> DataFrame:
    if mode == "strict":
        attached = require_addresses(attached)
    return conform(attached, CUSTOMER_DOCUMENT)


def build_customer_documents(
    customer_accounts: DataFrame, addresses: DataFrame, mode: str = "strict", **limits
) -> DataFrame:
    """Every customer with its accounts and its parsed addresses.

    In strict mode a malformed address fails the job, but only if its customer
    is known.
    """
    parents = customer_accounts.select(*CUSTOMER.fieldNames(), "accounts")
    kinds = [_addresses(addresses, mode)]
    return _as_documents(attach_children(parents, KEY, kinds, **limits), mode)


def build_documents(
    customers: DataFrame,
    accounts: DataFrame,
    addresses: DataFrame,
    mode: str = "strict",
    **limits,
) -> DataFrame:
    """The documents of both builds in one plan, without the stage between them."""
    parents = customers.select(CUSTOMER.fieldNames())
    kinds = [_accounts(accounts, mode), _addresses(addresses, mode)]
    return _as_documents(attach_children(parents, KEY, kinds, **limits), mode)


def build_customer_model(customers: DataFrame) -> DataFrame:
    """Every customer with its full name as a struct."""
    return conform(
        customers.withColumn(
            "fullname", F.struct(F.col("forename").alias("firstName"), F.col("surname"))
        ),
        CUSTOMER_MODEL,
    )
