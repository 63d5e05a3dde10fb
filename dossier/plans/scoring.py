"""Customers linked to a watch-list of countries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.address import is_malformed, parse_address
from dossier.functions.checks import check_mode
from dossier.plans.documents import KEY, require_addresses

# The default watch-list, the name of its flag, and the text of the report.
WATCH_LIST = ["British Virgin Islands"]
FLAG = "linkToBVI"
REPORT = "Number of customers linked to %s: %d"


def _listed(countries: list[str]) -> Column:
    """Whether an address of this row is in a listed country; never null.

    Works on the projected field so that only that field is read from Parquet.
    """
    found = F.col("address.country")
    if len(countries) == 1:
        match = F.array_contains(found, F.lit(countries[0]))
    else:
        match = F.arrays_overlap(found, F.array(*map(F.lit, countries)).cast("array<string>"))
    return F.coalesce(match, F.lit(False))


def score_link(
    documents: DataFrame, countries: list[str] = WATCH_LIST, flag: str = FLAG
) -> DataFrame:
    """``documents`` with the boolean ``flag``: any address in a listed country.

    Names match as a whole, by case and blanks.
    """
    return documents.withColumn(flag, _listed(countries))


def count_linked(scored: DataFrame, flag: str = FLAG) -> DataFrame:
    """One row, ``linkedCustomers``: the number of flagged customers, repeated ones included."""
    return scored.where(flag).agg(F.count(F.lit(1)).alias("linkedCustomers"))


def score_parts(
    parts: DataFrame, countries: list[str] = WATCH_LIST, flag: str = FLAG
) -> DataFrame:
    """``customerId`` and ``flag`` of every customer in ``parts``: any address of any part in a listed country."""
    return parts.groupBy(KEY).agg(F.max(_listed(countries)).alias(flag))


def count_linked_parts(customers: DataFrame, scored: DataFrame, flag: str = FLAG) -> DataFrame:
    """``count_linked`` of customers whose children are stored in parts, flagged by ``score_parts``."""
    linked = scored.where(flag).select(KEY)
    rows = customers.groupBy(KEY).agg(F.count(F.lit(1)).alias("rows")).join(linked, KEY)
    return rows.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("linkedCustomers"))


def report_linked(counted: DataFrame, countries: list[str] = WATCH_LIST) -> DataFrame:
    """``counted`` with the column ``report``, the count as a line of text."""
    names = F.lit(" or ".join(countries))
    return counted.withColumn("report", F.format_string(REPORT, names, "linkedCustomers"))


def _relevant(addresses: DataFrame, countries: list[str], mode: str) -> DataFrame:
    """Customers with a listed or a malformed address, one row each, shrunk before the shuffle."""
    check_mode(mode)
    parsed = parse_address(addresses, mode="lenient").select(
        KEY,
        F.coalesce(F.col("country").isin(countries), F.lit(False)).alias("linked"),
        (is_malformed() if mode == "strict" else F.lit(False)).alias("malformed"),
    )
    return (
        parsed.where(F.col("linked") | F.col("malformed"))
        .groupBy(KEY)
        .agg(F.max("linked").alias("linked"), F.max("malformed").alias("malformed"))
    )


def flag_customers(
    customers: DataFrame,
    addresses: DataFrame,
    countries: list[str] = WATCH_LIST,
    flag: str = FLAG,
    mode: str = "strict",
) -> DataFrame:
    """Every customer with ``flag``, straight from the flat inputs, without building documents."""
    joined = customers.join(_relevant(addresses, countries, mode), KEY, "left")
    flagged = require_addresses(joined).withColumn(flag, F.coalesce(F.col("linked"), F.lit(False)))
    return flagged.select(*customers.columns, flag)


def count_linked_flat(
    customers: DataFrame,
    addresses: DataFrame,
    countries: list[str] = WATCH_LIST,
    mode: str = "strict",
) -> DataFrame:
    """``count_linked`` straight from the flat inputs, without building documents.

    Both sides shrink to one row per customer before they are shuffled, so hot
    keys on either side cost nothing extra.
    """
    rows = customers.groupBy(KEY).agg(F.count(F.lit(1)).alias("rows"))
    sound = require_addresses(rows.join(_relevant(addresses, countries, mode), KEY))
    return sound.where("linked").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("linkedCustomers")
    )
