"""Documents in parts, for customers whose children are too many for one row.

Every customer's children come in parts, be they few or many: rows of
``customerId`` and ``part`` with some of its accounts or some of its addresses.
Sorted by part, the arrays of either kind are the children in ascending order.
Totals are of whole customers and come from ``build_customer_stats``.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dossier.functions.address import is_malformed, parse_address
from dossier.functions.checks import check_mode
from dossier.operators.repeats import find_crowded
from dossier.operators.staging import staged
from dossier.plans.documents import KEY, account_rows, require_addresses
from dossier.schemas import ACCOUNT, ADDRESS, ADDRESS_RAW, DOCUMENT_PART, PART
from dossier.sources.binding import conform

# Layout only: a part holds at most so many children.
PART_SIZE = 10_000
# A customer of more children than this is spread over tasks; changes costs alone.
MAX_CHILDREN = 1_000_000


def _in_order(rows: DataFrame, fields: list[str], name: str) -> DataFrame:
    """``rows`` of known order: ``_place`` ascends with customer and record.

    They are sorted in ranges of customers and records, so that a large customer is
    spread over tasks. Copies of one record are told apart by the task that read
    them, so that they spread too. The stored result fixes the places.
    """
    ties = rows.withColumn("_reader", F.spark_partition_id())
    placed = ties.repartitionByRange(KEY, *fields, "_reader").sortWithinPartitions(KEY, *fields)
    return staged(placed.drop("_reader").withColumn("_place", F.monotonically_increasing_id()), name)


def _in_parts(
    rows: DataFrame, known: DataFrame, large: DataFrame | None, fields: list[str], part_size: int, name: str
) -> list[DataFrame]:
    """The ``rows`` of ``known`` customers with their ``PART``, those of ``large`` customers by themselves.

    All others are shuffled by customer once, to meet ``known``, and numbered and
    grouped where they are.
    """
    window = Window.partitionBy(KEY).orderBy(*fields)
    place = F.row_number().over(window).cast("bigint") - 1
    usual = rows if large is None else rows.join(large, KEY, "left_anti")
    placed = [usual.join(known, KEY, "left_semi").withColumn("_place", place)]
    if large is not None:
        rest = rows.join(large, KEY, "left_semi").join(known, KEY, "left_semi")
        placed.append(_in_order(rest.select(rows.columns), fields, name))
    return [x.withColumn(PART, F.expr(f"_place div {part_size}")) for x in placed]


def _nested(rows: DataFrame, fields: list[str], as_col: str) -> DataFrame:
    """Neighbouring records of one customer each, as one array for each part."""
    return rows.groupBy(KEY, PART).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(as_col))


def build_document_parts(
    customers: DataFrame,
    accounts: DataFrame,
    addresses: DataFrame,
    mode: str = "strict",
    part_size: int = PART_SIZE,
    max_children: int = MAX_CHILDREN,
) -> DataFrame:
    """The children of all known customers in parts of at most ``part_size``.

    A part has either accounts or addresses; the other array is empty. Parts are
    numbered in ascending order, with gaps. Customers without children have none.

    Customers of more than ``max_children`` accounts or addresses are found by a
    count; theirs are sorted in ranges, so that no task holds all of them.
    """
    check_mode(mode)
    if part_size < 1:
        raise ValueError(f"part_size must be at least 1, not {part_size}")
    known = customers.select(KEY)
    account_fields, address_fields = ACCOUNT.fieldNames(), ADDRESS.fieldNames()

    large = find_crowded(accounts, KEY, max_children).table
    owned = account_rows(accounts, mode).select(account_fields)
    first = [
        _nested(rows, account_fields, "accounts")
        for rows in _in_parts(owned, known, large, account_fields, part_size, "part-accounts")
    ]

    large = find_crowded(addresses, KEY, max_children).table
    lived, second = addresses.select(ADDRESS_RAW.fieldNames()), []
    for rows in _in_parts(lived, known, large, ADDRESS_RAW.fieldNames(), part_size, "part-addresses"):
        parsed = parse_address(rows, mode="lenient")
        if mode == "strict":
            parsed = require_addresses(parsed.withColumn("malformed", is_malformed()))
        second.append(_nested(parsed, address_fields, "address"))

    none = {name: F.array().cast(DOCUMENT_PART[name].dataType) for name in ("accounts", "address")}
    # Even numbers for accounts, odd ones for addresses.
    numbered = [x.withColumn("address", none["address"]).withColumn(PART, F.col(PART) * 2) for x in first]
    numbered += [x.withColumn("accounts", none["accounts"]).withColumn(PART, F.col(PART) * 2 + 1) for x in second]
    return conform(reduce(DataFrame.unionByName, numbered), DOCUMENT_PART)
