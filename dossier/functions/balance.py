"""Balances as whole numbers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.functions.checks import check_mode, require


def cast_balance(accounts: DataFrame, mode: str = "strict") -> DataFrame:
    """``accounts`` with ``balance`` as bigint.

    A balance that is missing or no whole number fails the job in strict mode
    and is null in lenient mode.
    """
    check_mode(mode)
    if mode == "strict":
        accounts = require(
            accounts,
            F.col("balance").try_cast("bigint").isNotNull(),
            F.concat(
                F.lit("balance is not a whole number: "),
                F.coalesce(F.col("balance").cast("string"), F.lit("(null)")),
                F.lit(", customer "),
                F.coalesce(F.col("customerId"), F.lit("(null)")),
            ),
        )
    return accounts.withColumn("balance", F.col("balance").try_cast("bigint"))
