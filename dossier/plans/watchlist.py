"""A watch-list as a table: any number of names, joined, with the names that matched.

A list of names in the query becomes part of its plan; a table does not. Customers'
countries are told apart before they meet the names, so that a country or a customer
with very many addresses is one row for each pair. Spark broadcasts the names if it
finds them small enough, and else shuffles both sides by name.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.functions.address import is_malformed, parse_address
from dossier.functions.checks import check_mode
from dossier.plans.documents import KEY, require_addresses
from dossier.plans.scoring import FLAG

MATCHES = "matchedNames"


def watch_names(names: DataFrame, column: str) -> DataFrame:
    """The names of a watch-list, each once, as ``_name``; a null is no name."""
    return names.select(F.col(column).alias("_name")).where("_name IS NOT NULL").distinct()


def _matched(countries: DataFrame, names: DataFrame, matches: str) -> DataFrame:
    """For each customer of ``countries`` (``customerId``, ``country``) with any listed one: these, in order."""
    pairs = countries.where("country IS NOT NULL").distinct()
    listed = pairs.join(names, F.col("country") == F.col("_name"))
    return listed.groupBy(KEY).agg(F.array_sort(F.collect_list("country")).alias(matches))


def _with_flag(rows: DataFrame, flag: str, matches: str, columns: list[str]) -> DataFrame:
    found = F.coalesce(matches, F.array().cast("array<string>"))
    return rows.withColumn(matches, found).select(*columns, (F.size(matches) > 0).alias(flag), matches)


def _free(columns: list[str], *names: str) -> None:
    taken = sorted(set(columns) & set(names))
    if taken:
        raise ValueError(f"columns already there: {', '.join(taken)}")


def score_listed(
    documents: DataFrame, names: DataFrame, column: str, flag: str = FLAG, matches: str = MATCHES
) -> DataFrame:
    """``documents`` with ``flag``, as by ``score_link``, and ``matches``, the listed countries of all its addresses.

    Customers that are repeated share their addresses, and so their flag.
    """
    _free(documents.columns, flag, matches)
    countries = documents.select(KEY, F.explode(F.array_distinct("address.country")).alias("country"))
    found = _matched(countries, watch_names(names, column), matches)
    return _with_flag(documents.join(found, KEY, "left"), flag, matches, documents.columns)


def flag_listed(
    customers: DataFrame,
    addresses: DataFrame,
    names: DataFrame,
    column: str,
    flag: str = FLAG,
    matches: str = MATCHES,
    mode: str = "strict",
) -> DataFrame:
    """Every customer with ``flag`` and ``matches``, straight from the flat inputs."""
    check_mode(mode)
    _free(customers.columns, flag, matches)
    parsed = parse_address(addresses, mode="lenient").select(KEY, "country", is_malformed().alias("malformed"))
    if mode == "strict":
        faults = parsed.where("malformed").select(KEY, "malformed").distinct()
        joined = require_addresses(customers.join(faults, KEY, "left")).select(customers.columns)
    else:
        joined = customers
    found = _matched(parsed.select(KEY, "country"), watch_names(names, column), matches)
    return _with_flag(joined.join(found, KEY, "left"), flag, matches, customers.columns)


def count_listed(scored: DataFrame, matches: str = MATCHES) -> DataFrame:
    """For each name that matched: ``linkedCustomers``, how many customer rows it did."""
    each = scored.select(F.explode(matches).alias("name"))
    return each.groupBy("name").agg(F.count(F.lit(1)).alias("linkedCustomers"))
