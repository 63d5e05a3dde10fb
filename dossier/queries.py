"""The query catalogue over the driver tables, each query next to its SQL.

Two families of inputs, both over whole tables:

* customers with their orders as accounts (and, in some queries, events as
  accounts: nine customers in ten have none);
* orders with their line items as accounts, and the suppliers' places as
  addresses (one order in sixty has no line item).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dossier.functions.address import FIELDS, parse_address
from dossier.operators.staging import scratch_dir
from dossier.plans.countries import count_linked_in, linked_by, read_countries, write_countries
from dossier.plans.documents import (
    build_customer_accounts,
    build_customer_documents,
    build_customer_model,
    build_customer_stats,
    build_documents,
)
from dossier.plans.parts import build_document_parts
from dossier.plans.scoring import (
    count_linked,
    count_linked_flat,
    flag_customers,
    report_linked,
    score_link,
    score_parts,
)
from dossier.plans.sifting import ADDRESS, BALANCE, bad_address, bad_balance, sift
from dossier.plans.stages import run_flat, run_stages, stored_count, write_counted
from dossier.plans.watchlist import count_listed, flag_listed, score_listed
from dossier.schemas import ADDRESS_RAW
from dossier.sources.files import (
    read_customer_accounts,
    read_customer_documents,
    read_customer_model,
    read_document_parts,
    read_scored_documents,
    write_stage,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

LINK = ["NATION_1"]
LINKS = ["NATION_1", "NATION_7", "NATION_22"]


def _query(sql: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLE[query.__name__] = sql
        return query

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def customers(spark, sf_dir):
    name = F.split("c_name", "#")
    return _table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("customerId"),
        name[0].alias("forename"),
        name[1].alias("surname"),
    )


def customer_orders(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select(
        _text("o_custkey").alias("customerId"),
        _text("o_orderkey").alias("accountId"),
        _cents("o_totalprice").alias("balance"),
    )


def customer_events(spark, sf_dir):
    return _table(spark, sf_dir, "events").select(
        _text("user_id").alias("customerId"),
        _text("event_id").alias("accountId"),
        _cents("value").alias("balance"),
    )


def event_owners(spark, sf_dir):
    """One customer row per event: the same customer many times over."""
    return _table(spark, sf_dir, "events").select(
        _text("user_id").alias("customerId"),
        F.col("event_type").alias("forename"),
        _text("event_id").alias("surname"),
    )


def orders(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("customerId"),
        F.col("o_orderpriority").alias("forename"),
        F.col("o_orderstatus").alias("surname"),
    )


def order_lines(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("customerId"),
        _text("l_linenumber").alias("accountId"),
        _cents("l_extendedprice").alias("balance"),
    )


def order_addresses(spark, sf_dir):
    """Each line item's supplier, joined one small table at a time, which Spark can size."""
    return (
        _table(spark, sf_dir, "lineitem")
        .join(_table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _text("l_linenumber").alias("addressId"),
            _text("l_orderkey").alias("customerId"),
            F.concat_ws(", ", "s_suppkey", "s_name", "r_name", "n_name").alias("address"),
        )
    )


def uneven_addresses(spark, sf_dir):
    """Addresses of all shapes, by order priority: only urgent and low ones are sound."""
    three = F.concat_ws(", ", "o_custkey", "o_orderstatus", "o_orderpriority")
    four = F.concat_ws(", ", three, F.month("o_orderdate"))
    shapes = {
        "1-URGENT": four,
        "2-HIGH": F.concat(three, F.lit(", ")),
        "3-MEDIUM": F.concat(F.lit(" "), four),
        "5-LOW": F.concat_ws(", ", four, "o_orderkey"),
    }
    address = F.lit(None).cast("string")
    for priority, shape in shapes.items():
        address = F.when(F.col("o_orderpriority") == priority, shape).otherwise(address)
    return _table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("addressId"),
        _text("o_custkey").alias("customerId"),
        address.alias("address"),
    )


def orphaned_customers(spark, sf_dir):
    """All customers, but those of one segment without a key and those of another under unknown keys."""
    key = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("x"), "c_custkey"))
        .otherwise(_text("c_custkey"))
    )
    return _table(spark, sf_dir, "customer").select(
        key.alias("customerId"),
        F.col("c_name").alias("forename"),
        F.col("c_mktsegment").alias("surname"),
    )


def keyless_addresses(spark, sf_dir):
    """Uneven addresses, some of orders that name no customer."""
    addresses = uneven_addresses(spark, sf_dir)
    named = F.when(~F.col("addressId").endswith("7"), F.col("customerId"))
    return addresses.withColumn("customerId", named)


def text_balances(spark, sf_dir):
    """Orders as accounts whose balance is text, whole or not, by priority."""
    shapes = {
        "1-URGENT": _text("o_orderkey"),
        "2-HIGH": F.concat(F.lit("-"), "o_custkey"),
        "3-MEDIUM": F.concat("o_orderkey", F.lit(".5")),
        "5-LOW": F.lit("n/a"),
    }
    balance = F.lit(None).cast("string")
    for priority, shape in shapes.items():
        balance = F.when(F.col("o_orderpriority") == priority, shape).otherwise(balance)
    return _table(spark, sf_dir, "orders").select(
        _text("o_custkey").alias("customerId"),
        _text("o_orderkey").alias("accountId"),
        balance.alias("balance"),
    )


def order_documents(spark, sf_dir):
    return build_documents(
        orders(spark, sf_dir), order_lines(spark, sf_dir), order_addresses(spark, sf_dir)
    )


_CUSTOMERS = """customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customerId, str_split(c_name, '#')[1] AS forename,
         str_split(c_name, '#')[2] AS surname
  FROM customer)"""

_CUSTOMER_ORDERS = """accounts AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customerId, CAST(o_orderkey AS VARCHAR) AS accountId,
         CAST(round(o_totalprice * 100) AS BIGINT) AS balance
  FROM orders)"""

_CUSTOMER_EVENTS = """accounts AS (
  SELECT CAST(user_id AS VARCHAR) AS customerId, CAST(event_id AS VARCHAR) AS accountId,
         CAST(round(value * 100) AS BIGINT) AS balance
  FROM events)"""

_EVENT_OWNERS = """customers AS (
  SELECT CAST(user_id AS VARCHAR) AS customerId, event_type AS forename,
         CAST(event_id AS VARCHAR) AS surname
  FROM events)"""

_ORDERS = """customers AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS customerId, o_orderpriority AS forename,
         o_orderstatus AS surname
  FROM orders)"""

_ORDER_LINES = """accounts AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS customerId, CAST(l_linenumber AS VARCHAR) AS accountId,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS balance
  FROM lineitem)"""

_ORDER_ADDRESSES = """raw_addresses AS (
  SELECT CAST(l_linenumber AS VARCHAR) AS addressId, CAST(l_orderkey AS VARCHAR) AS customerId,
         CAST(s_suppkey AS VARCHAR) || ', ' || s_name || ', ' || r_name || ', ' || n_name AS address
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_UNEVEN_ADDRESSES = """raw_addresses AS (
  SELECT addressId, customerId, CASE o_orderpriority
           WHEN '1-URGENT' THEN three || ', ' || month(o_orderdate)
           WHEN '2-HIGH' THEN three || ', '
           WHEN '3-MEDIUM' THEN ' ' || three || ', ' || month(o_orderdate)
           WHEN '5-LOW' THEN three || ', ' || month(o_orderdate) || ', ' || addressId
         END AS address
  FROM (SELECT *, CAST(o_orderkey AS VARCHAR) AS addressId, CAST(o_custkey AS VARCHAR) AS customerId,
               o_custkey || ', ' || o_orderstatus || ', ' || o_orderpriority AS three
        FROM orders))"""


def _parsed(source: str = "raw_addresses", text: str = "address") -> str:
    return f"""addresses AS (
  SELECT * EXCLUDE (words), words[2] AS road, words[3] AS city, words[4] AS country,
         CASE WHEN regexp_full_match(words[1], '[+-]?[0-9]+') THEN TRY_CAST(words[1] AS INTEGER) END AS number
  FROM (SELECT *, str_split(regexp_replace({text}, '(, )+$', ''), ', ') AS words FROM {source}))"""


_STATS = """stats AS (
  SELECT customerId, CAST(count(*) AS INTEGER) AS numberAccounts,
         CAST(sum(balance) AS BIGINT) AS totalBalance
  FROM accounts GROUP BY customerId)"""

_WITH_STATS = """SELECT c.customerId, c.forename, c.surname,
       COALESCE(s.numberAccounts, 0) AS numberAccounts,
       COALESCE(s.totalBalance, 0) AS totalBalance,
       CASE WHEN s.numberAccounts IS NULL THEN 0.0::DOUBLE
            ELSE s.totalBalance::DOUBLE / s.numberAccounts END AS averageBalance
FROM customers c LEFT JOIN stats s ON c.customerId = s.customerId"""


def _listed(countries: list[str]) -> str:
    return ", ".join(f"'{c}'" for c in countries)


def _scored(countries: list[str]) -> str:
    return f"""owned AS (SELECT customerId, CAST(count(*) AS INTEGER) AS n FROM accounts GROUP BY customerId),
placed AS (
  SELECT customerId, CAST(count(*) AS INTEGER) AS n,
         COALESCE(bool_or(country IN ({_listed(countries)})), false) AS linked
  FROM addresses GROUP BY customerId)
SELECT c.customerId, c.forename, c.surname, COALESCE(o.n, 0) AS numberAccounts,
       COALESCE(p.n, 0) AS numberAddresses, COALESCE(p.linked, false) AS linked
FROM customers c LEFT JOIN owned o ON c.customerId = o.customerId
LEFT JOIN placed p ON c.customerId = p.customerId"""


_ORPHANED = """customers AS (
  SELECT CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN 'x' || c_custkey
         ELSE CAST(c_custkey AS VARCHAR) END AS customerId, c_name AS forename, c_mktsegment AS surname
  FROM customer)"""

_KEYLESS_ADDRESSES = _UNEVEN_ADDRESSES.replace("raw_addresses AS (", "uneven AS (") + """, raw_addresses AS (
  SELECT addressId, CASE WHEN NOT ends_with(addressId, '7') THEN customerId END AS customerId, address
  FROM uneven)"""

# Whole documents as text: every field of every child, in order.
_WHOLE = """, account_lists AS (
  SELECT customerId, string_agg(accountId || ':' || balance, '|' ORDER BY accountId, balance) AS accounts
  FROM accounts GROUP BY customerId),
address_lists AS (
  SELECT customerId, string_agg(concat_ws(':', addressId, customerId, COALESCE(address, '-'),
           COALESCE(CAST(number AS VARCHAR), '-'), COALESCE(road, '-'), COALESCE(city, '-'), COALESCE(country, '-')),
         '|' ORDER BY addressId, address) AS address
  FROM addresses GROUP BY customerId)
SELECT c.customerId, c.forename, c.surname, COALESCE(a.accounts, '') AS accounts, COALESCE(d.address, '') AS address
FROM customers c LEFT JOIN account_lists a ON c.customerId = a.customerId
LEFT JOIN address_lists d ON c.customerId = d.customerId"""

_ORDER_DOCUMENTS = f"WITH {_ORDERS}, {_ORDER_LINES}, {_ORDER_ADDRESSES}, {_parsed()}"

_WITH_FLAGS = f"""
SELECT customerId, forename, surname, COALESCE(customerId IN (
         SELECT customerId FROM addresses WHERE country IN ({_listed(LINK)})), false) AS linked
FROM customers"""

_LINKED = f"""{_ORDER_DOCUMENTS}, linked AS (
  SELECT count(*) AS n FROM customers WHERE customerId IN (
    SELECT customerId FROM addresses WHERE country IN ({_listed(LINK)})))"""


def _sizes(scored: DataFrame) -> DataFrame:
    """Scored documents with the number of children in place of the children."""
    return scored.select(
        "customerId",
        "forename",
        "surname",
        F.size("accounts").alias("numberAccounts"),
        F.size("address").alias("numberAddresses"),
        "linked",
    )


def _as_text(documents: DataFrame) -> DataFrame:
    """Documents with each array as one text, every field of every child in order."""
    dash = F.lit("-")

    def account(a):
        return F.concat_ws(":", a["accountId"], a["balance"].cast("string"))

    def place(a):
        optional = [F.coalesce(a[name].cast("string"), dash) for name in ("address", *FIELDS)]
        return F.concat_ws(":", a["addressId"], a["customerId"], *optional)

    return documents.select(
        "customerId",
        "forename",
        "surname",
        F.array_join(F.transform("accounts", account), "|").alias("accounts"),
        F.array_join(F.transform("address", place), "|").alias("address"),
    )


def _model(model: DataFrame) -> DataFrame:
    return model.select(
        "customerId",
        "forename",
        "surname",
        "fullname.firstName",
        F.col("fullname.surname").alias("lastName"),
    )


def _no_addresses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ADDRESS_RAW)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@_query(f"WITH {_CUSTOMERS}, {_CUSTOMER_ORDERS}, {_STATS} {_WITH_STATS}")
def q01_account_stats(spark, sf_dir):
    return build_customer_stats(customers(spark, sf_dir), customer_orders(spark, sf_dir))


@_query(f"""WITH {_CUSTOMERS}, {_CUSTOMER_ORDERS}, ranked AS (
  SELECT *, CAST(row_number() OVER (
           PARTITION BY customerId ORDER BY accountId, balance) - 1 AS INTEGER) AS position
  FROM accounts)
SELECT c.customerId, r.position, r.accountId, r.balance
FROM customers c LEFT JOIN ranked r ON c.customerId = r.customerId""")
def q02_accounts_attached(spark, sf_dir):
    documents = build_customer_accounts(customers(spark, sf_dir), customer_orders(spark, sf_dir))
    return documents.select(
        "customerId", F.posexplode_outer("accounts").alias("position", "account")
    ).select("customerId", "position", "account.accountId", "account.balance")


@_query(f"""WITH {_CUSTOMERS}, {_CUSTOMER_EVENTS}, listed AS (
  SELECT customerId, string_agg('{{"customerId":"' || customerId || '","accountId":"' || accountId
         || '","balance":' || balance || '}}', ',' ORDER BY accountId, balance) AS accounts
  FROM accounts GROUP BY customerId)
SELECT c.customerId, c.forename, c.surname, '[' || COALESCE(l.accounts, '') || ']' AS accounts
FROM customers c LEFT JOIN listed l ON c.customerId = l.customerId""")
def q03_account_documents(spark, sf_dir):
    documents = build_customer_accounts(customers(spark, sf_dir), customer_events(spark, sf_dir))
    return documents.select(
        "customerId", "forename", "surname", F.to_json("accounts").alias("accounts")
    )


@_query(f"""WITH {_ORDER_ADDRESSES}, {_parsed()}
SELECT addressId, customerId, address, number, road, city, country FROM addresses""")
def q04_parsed_addresses(spark, sf_dir):
    return parse_address(order_addresses(spark, sf_dir))


@_query(f"""{_ORDER_DOCUMENTS}, ranked AS (
  SELECT *, CAST(row_number() OVER (
           PARTITION BY customerId ORDER BY addressId, address) - 1 AS INTEGER) AS position
  FROM addresses),
owned AS (SELECT customerId, CAST(count(*) AS INTEGER) AS n FROM accounts GROUP BY customerId)
SELECT c.customerId, COALESCE(o.n, 0) AS numberAccounts, r.position, r.addressId, r.address,
       r.number, r.road, r.city, r.country
FROM customers c LEFT JOIN owned o ON c.customerId = o.customerId
LEFT JOIN ranked r ON c.customerId = r.customerId""")
def q05_documents(spark, sf_dir):
    return (
        order_documents(spark, sf_dir)
        .select(
            "customerId",
            F.size("accounts").alias("numberAccounts"),
            F.posexplode_outer("address").alias("position", "place"),
        )
        .select(
            "customerId",
            "numberAccounts",
            "position",
            "place.addressId",
            "place.address",
            *[f"place.{name}" for name in FIELDS],
        )
    )


@_query(f"{_ORDER_DOCUMENTS}, {_scored(LINK)}")
def q06_scored_documents(spark, sf_dir):
    return _sizes(score_link(order_documents(spark, sf_dir), LINK, "linked"))


@_query(f"""{_LINKED}
SELECT n AS linkedCustomers, 'Number of customers linked to NATION_1: ' || n AS report FROM linked""")
def q07_linked_count(spark, sf_dir):
    scored = score_link(order_documents(spark, sf_dir), LINK, "linked")
    return report_linked(count_linked(scored, "linked"), LINK)


@_query(f"{_LINKED} SELECT n AS linkedCustomers FROM linked")
def q08_linked_count_flat(spark, sf_dir):
    return count_linked_flat(orders(spark, sf_dir), order_addresses(spark, sf_dir), LINK)


@_query(f"{_ORDER_DOCUMENTS}, {_scored(LINKS)}")
def q09_watch_list(spark, sf_dir):
    return _sizes(score_link(order_documents(spark, sf_dir), LINKS, "linked"))


@_query(f"""WITH {_CUSTOMERS}
SELECT customerId, forename, surname, forename AS firstName, surname AS lastName FROM customers""")
def q10_customer_model(spark, sf_dir):
    return _model(build_customer_model(customers(spark, sf_dir)))


@_query(f"""WITH {_UNEVEN_ADDRESSES}, {_parsed()}
SELECT addressId, customerId, address, number, road, city, country FROM addresses""")
def q11_lenient_addresses(spark, sf_dir):
    return parse_address(uneven_addresses(spark, sf_dir), mode="lenient")


@_query(f"{_ORDER_DOCUMENTS}, {_scored(LINK)}")
def q12_staged(spark, sf_dir):
    out_dir = _folder(spark, "staged")
    return _sizes(
        run_flat(
            orders(spark, sf_dir),
            order_lines(spark, sf_dir),
            order_addresses(spark, sf_dir),
            out_dir,
            LINK,
            "linked",
        )
    )


@_query(f"WITH {_CUSTOMERS}, {_CUSTOMER_EVENTS}, {_STATS} {_WITH_STATS}")
def q13_mostly_childless(spark, sf_dir):
    return build_customer_stats(customers(spark, sf_dir), customer_events(spark, sf_dir))


@_query(f"WITH {_EVENT_OWNERS}, {_CUSTOMER_ORDERS}, {_STATS} {_WITH_STATS}")
def q14_repeated_customers(spark, sf_dir):
    """Customers given once per event; the limit deals out the frequent ones."""
    documents = build_customer_accounts(
        event_owners(spark, sf_dir), customer_orders(spark, sf_dir), max_repeats=64
    )
    return documents.drop("accounts")


@_query(f"""WITH {_CUSTOMERS}, {_CUSTOMER_EVENTS}, {_STATS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customerId ORDER BY accountId, balance) AS position
  FROM accounts)
SELECT c.customerId, COALESCE(s.numberAccounts, 0) AS numberAccounts,
       COALESCE(s.totalBalance, 0) AS totalBalance, a.position, a.accountId, a.balance
FROM customers c LEFT JOIN ranked a ON c.customerId = a.customerId
LEFT JOIN stats s ON c.customerId = s.customerId""")
def q15_split_customers(spark, sf_dir):
    """Children in parts of at most 16, put together again in the order of the parts."""
    parts = build_document_parts(
        customers(spark, sf_dir), customer_events(spark, sf_dir), _no_addresses(spark), part_size=16
    )
    in_order = Window.partitionBy("customerId").orderBy("part", "index")
    children = (
        parts.select("customerId", "part", F.posexplode("accounts").alias("index", "account"))
        .withColumn("position", F.row_number().over(in_order).cast("bigint"))
        .select("customerId", "position", "account.accountId", "account.balance")
    )
    stats = build_customer_stats(customers(spark, sf_dir), customer_events(spark, sf_dir))
    return stats.select("customerId", "numberAccounts", "totalBalance").join(
        children, "customerId", "left"
    )


@_query(f"""WITH {_CUSTOMERS}, {_CUSTOMER_ORDERS}, {_UNEVEN_ADDRESSES}, {_parsed()},
{_scored(["1", "2"])}""")
def q16_lenient_scored(spark, sf_dir):
    """Flags over addresses whose country is often null."""
    documents = build_customer_documents(
        build_customer_accounts(customers(spark, sf_dir), customer_orders(spark, sf_dir)),
        uneven_addresses(spark, sf_dir),
        mode="lenient",
    )
    return _sizes(score_link(documents, ["1", "2"], "linked"))


@_query(f"""WITH texts AS (SELECT doc_id, text FROM documents), {_parsed("texts", "text")}
SELECT doc_id, number, road, city, country FROM addresses""")
def q17_lenient_texts(spark, sf_dir):
    """The parser over free text of any length."""
    texts = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return parse_address(texts, "text", mode="lenient").drop("text")


@_query(f"""WITH {_CUSTOMERS}, {_CUSTOMER_ORDERS}, raw_addresses AS (
  SELECT CAST(c_custkey AS VARCHAR) AS addressId, CAST(c_custkey AS VARCHAR) AS customerId,
         c_custkey || ', ' || c_mktsegment || ', ' || r_name || ', ' || n_name AS address
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
{_parsed()}, {_STATS}, flags AS ({_WITH_FLAGS}), stats_of AS ({_WITH_STATS})
SELECT s.*, f.linked, CAST(NULL AS BIGINT) AS linkedCustomers
FROM stats_of s JOIN flags f ON s.customerId = f.customerId
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*) FROM flags WHERE linked""")
def q18_csv_inputs(spark, sf_dir):
    """The staged run from CSV files to the count, a row of its own; values are text, quoted where needed."""
    places = (
        _table(spark, sf_dir, "customer")
        .join(_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _text("c_custkey").alias("addressId"),
            _text("c_custkey").alias("customerId"),
            F.concat_ws(", ", "c_custkey", "c_mktsegment", "r_name", "n_name").alias("address"),
        )
    )
    folder = _folder(spark, "csv")
    customers(spark, sf_dir).write.csv(f"{folder}/customers", header=True)
    customer_orders(spark, sf_dir).write.csv(f"{folder}/accounts", header=True)
    places.write.csv(f"{folder}/addresses", header=True)
    scored = run_stages(
        spark,
        f"{folder}/customers",
        f"{folder}/accounts",
        f"{folder}/addresses",
        f"{folder}/out",
        countries=LINK,
        flag="linked",
    )
    stats = read_customer_accounts(spark, f"{folder}/out/customer_accounts").drop("accounts")
    flagged = stats.join(scored.select("customerId", "linked"), "customerId")
    return flagged.unionByName(count_linked(scored, "linked"), allowMissingColumns=True)


@_query(f"""{_ORDER_DOCUMENTS}
SELECT c.customerId, c.forename, c.surname, c.customerId IN (
         SELECT customerId FROM addresses WHERE country IN ({_listed(LINK)})) AS linked
FROM customers c""")
def q19_split_scored(spark, sf_dir):
    """Flags of customers whose children are stored in parts of at most three."""
    path = _folder(spark, "parts")
    parts = build_document_parts(
        orders(spark, sf_dir),
        order_lines(spark, sf_dir),
        order_addresses(spark, sf_dir),
        part_size=3,
    )
    write_stage(parts, path)
    flags = score_parts(read_document_parts(spark, path), LINK, "linked")
    return (
        orders(spark, sf_dir)
        .join(flags, "customerId", "left")
        .withColumn("linked", F.coalesce("linked", F.lit(False)))
    )


@_query(f"""WITH {_ORPHANED}, {_CUSTOMER_ORDERS}, ranked AS (
  SELECT *, CAST(row_number() OVER (
           PARTITION BY customerId ORDER BY accountId, balance) - 1 AS INTEGER) AS position
  FROM accounts WHERE customerId IS NOT NULL), {_STATS}
SELECT c.customerId, c.forename, c.surname, COALESCE(s.numberAccounts, 0) AS numberAccounts,
       COALESCE(s.totalBalance, 0) AS totalBalance, r.position, r.accountId, r.balance
FROM customers c LEFT JOIN ranked r ON c.customerId = r.customerId
LEFT JOIN stats s ON c.customerId = s.customerId""")
def q20_orphan_accounts(spark, sf_dir):
    """Customers of one segment have no key, and those of another are unknown: their accounts vanish."""
    documents = build_customer_accounts(
        orphaned_customers(spark, sf_dir), customer_orders(spark, sf_dir)
    )
    return documents.select(
        "customerId",
        "forename",
        "surname",
        "numberAccounts",
        "totalBalance",
        F.posexplode_outer("accounts").alias("position", "account"),
    ).select(
        "customerId",
        "forename",
        "surname",
        "numberAccounts",
        "totalBalance",
        "position",
        "account.accountId",
        "account.balance",
    )


@_query(f"""WITH {_ORPHANED}, {_CUSTOMER_ORDERS}, {_KEYLESS_ADDRESSES}, {_parsed()}
{_WHOLE}""")
def q21_orphan_documents(spark, sf_dir):
    """Documents where some parents and some addresses have no key, and some children no parent."""
    documents = build_documents(
        orphaned_customers(spark, sf_dir),
        customer_orders(spark, sf_dir),
        keyless_addresses(spark, sf_dir),
        mode="lenient",
    )
    return _as_text(documents)


@_query(f"{_ORDER_DOCUMENTS} {_WHOLE}")
def q22_whole_documents(spark, sf_dir):
    """Both arrays in full and in order, from the build in one plan."""
    return _as_text(order_documents(spark, sf_dir))


@_query(f"{_ORDER_DOCUMENTS} {_WHOLE}")
def q23_whole_staged_documents(spark, sf_dir):
    """Both arrays in full and in order, from the build in two stages."""
    out_dir = _folder(spark, "staged")
    run_flat(
        orders(spark, sf_dir),
        order_lines(spark, sf_dir),
        order_addresses(spark, sf_dir),
        out_dir,
        LINK,
    )
    return _as_text(read_customer_documents(spark, f"{out_dir}/customer_documents"))


@_query(f"""WITH {_CUSTOMERS}
SELECT customerId, forename, surname, forename AS firstName, surname AS lastName FROM customers""")
def q24_stored_model(spark, sf_dir):
    """The customer model written and read back."""
    path = _folder(spark, "model")
    write_stage(build_customer_model(customers(spark, sf_dir)), path)
    return _model(read_customer_model(spark, path))


@_query(f"""WITH {_CUSTOMERS}, accounts AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customerId, CAST(o_orderkey AS VARCHAR) AS accountId,
         CASE WHEN regexp_full_match(shape, '[+-]?[0-9]+') THEN TRY_CAST(shape AS BIGINT) END AS balance
  FROM (SELECT *, CASE o_orderpriority
          WHEN '1-URGENT' THEN CAST(o_orderkey AS VARCHAR) WHEN '2-HIGH' THEN '-' || o_custkey
          WHEN '3-MEDIUM' THEN o_orderkey || '.5' WHEN '5-LOW' THEN 'n/a' END AS shape FROM orders)),
listed AS (
  SELECT customerId, CAST(count(*) AS INTEGER) AS numberAccounts,
         CAST(COALESCE(sum(balance), 0) AS BIGINT) AS totalBalance,
         string_agg(accountId || '=' || COALESCE(CAST(balance AS VARCHAR), 'none'), ',' ORDER BY accountId) AS accounts
  FROM accounts GROUP BY customerId)
SELECT c.customerId, COALESCE(l.numberAccounts, 0) AS numberAccounts,
       COALESCE(l.totalBalance, 0) AS totalBalance, COALESCE(l.accounts, '') AS accounts
FROM customers c LEFT JOIN listed l ON c.customerId = l.customerId""")
def q25_lenient_balances(spark, sf_dir):
    """Balances as text, many of them no whole number: null, but counted."""
    documents = build_customer_accounts(
        customers(spark, sf_dir), text_balances(spark, sf_dir), mode="lenient"
    )
    shown = F.transform(
        "accounts",
        lambda a: F.concat(
            a["accountId"], F.lit("="), F.coalesce(a["balance"].cast("string"), F.lit("none"))
        ),
    )
    return documents.select(
        "customerId", "numberAccounts", "totalBalance", F.array_join(shown, ",").alias("accounts")
    )


@_query(f"{_ORDER_DOCUMENTS} {_WITH_FLAGS}")
def q26_flat_flags(spark, sf_dir):
    """The flag of every customer from flat rows, without documents."""
    return flag_customers(orders(spark, sf_dir), order_addresses(spark, sf_dir), LINK, "linked")


@_query(f"""WITH texts AS (
  SELECT page_id, page_id || ', ' || url || ', ' || length(html) || ', ' || url || '#' AS address
  FROM pages), {_parsed("texts")}
SELECT page_id, number, road, city, country FROM addresses""")
def q27_page_lines(spark, sf_dir):
    """The parser in strict mode over lines made of pages' columns."""
    line = F.concat_ws(", ", "page_id", "url", F.length("html"), F.concat("url", F.lit("#")))
    pages = _table(spark, sf_dir, "pages").select("page_id", line.alias("address"))
    return parse_address(pages).drop("address")


_LISTED = """names AS (SELECT DISTINCT n_name AS name FROM nation WHERE n_regionkey = 1),
pairs AS (SELECT DISTINCT customerId, country FROM addresses JOIN names ON country = name),
matched AS (SELECT customerId, string_agg(country, '|' ORDER BY country) AS names FROM pairs GROUP BY customerId)"""


def listed_nations(spark, sf_dir):
    """A watch-list: the nations of one region."""
    return _table(spark, sf_dir, "nation").where("n_regionkey = 1")


def _with_names(scored: DataFrame) -> DataFrame:
    return scored.withColumn("names", F.array_join("matchedNames", "|")).drop("matchedNames")


@_query(f"""{_ORDER_DOCUMENTS}, {_LISTED}
SELECT c.customerId, c.forename, c.surname, COALESCE(m.names, '') AS names, m.names IS NOT NULL AS linked
FROM customers c LEFT JOIN matched m ON c.customerId = m.customerId""")
def q28_listed_documents(spark, sf_dir):
    """Documents against a watch-list that is a table, with the names that matched."""
    scored = score_listed(order_documents(spark, sf_dir), listed_nations(spark, sf_dir), "n_name", "linked")
    return _with_names(scored.drop("accounts", "address"))


@_query(f"""WITH {_ORPHANED}, {_KEYLESS_ADDRESSES}, {_parsed()},
names AS (SELECT DISTINCT l_linestatus AS name FROM lineitem UNION SELECT CAST(n_nationkey AS VARCHAR) FROM nation),
pairs AS (SELECT DISTINCT customerId, country FROM addresses JOIN names ON country = name),
matched AS (SELECT customerId, string_agg(country, '|' ORDER BY country) AS names FROM pairs GROUP BY customerId)
SELECT c.customerId, c.forename, c.surname, COALESCE(m.names, '') AS names, m.names IS NOT NULL AS linked
FROM customers c LEFT JOIN matched m ON c.customerId = m.customerId""")
def q29_listed_customers(spark, sf_dir):
    """Flat customers, some without a key, against a watch-list with names that nobody has."""
    names = _table(spark, sf_dir, "nation").select(_text("n_nationkey").alias("name"))
    names = names.union(_table(spark, sf_dir, "lineitem").select("l_linestatus"))
    customers = orphaned_customers(spark, sf_dir)
    flagged = flag_listed(customers, keyless_addresses(spark, sf_dir), names, "name", "linked", mode="lenient")
    return _with_names(flagged)


@_query(f"""{_ORDER_DOCUMENTS}, {_LISTED}
SELECT p.country AS name, count(*) AS linkedCustomers
FROM customers c JOIN pairs p ON c.customerId = p.customerId GROUP BY p.country""")
def q30_count_by_name(spark, sf_dir):
    """How many customers each name of a watch-list matched."""
    names = listed_nations(spark, sf_dir)
    return count_listed(flag_listed(orders(spark, sf_dir), order_addresses(spark, sf_dir), names, "n_name"))


@_query(f"""{_LINKED}
SELECT n AS linkedCustomers, 'Number of customers linked to NATION_1: ' || n AS report FROM linked""")
def q31_counted_while_writing(spark, sf_dir):
    """The count taken in the job that writes the scored documents."""
    path = _folder(spark, "counted")
    return report_linked(write_counted(order_documents(spark, sf_dir), path, LINK, "linked"), LINK)


@_query(f"""{_ORDER_DOCUMENTS}, scored AS ({_WITH_FLAGS})
SELECT *, (SELECT count(*) FROM scored WHERE linked) AS linkedCustomers FROM scored""")
def q32_stored_count(spark, sf_dir):
    """Stored flags, and beside each the count that was stored with them."""
    path = _folder(spark, "counted")
    write_counted(order_documents(spark, sf_dir), path, LINK, "linked")
    stored = read_scored_documents(spark, path, "linked").drop("accounts", "address")
    count = stored_count(spark, path).first()[0]
    return stored.withColumn("linkedCustomers", F.lit(count).cast("bigint"))


@_query(f"""{_ORDER_DOCUMENTS} {_WHOLE}""")
def q33_resumed_run(spark, sf_dir):
    """A run whose second stage was lost: it goes on from the first, which it reads by its buckets."""
    out_dir = _folder(spark, "resumed")
    inputs = [make(spark, sf_dir) for make in (orders, order_lines, order_addresses)]
    run_flat(*inputs[:2], inputs[2].where("addressId < '0'"), out_dir, LINK)
    run_flat(*inputs, out_dir, LINK)
    return _as_text(read_customer_documents(spark, f"{out_dir}/customer_documents"))


@_query(f"""WITH shaped AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS accountId, CASE o_orderpriority
    WHEN '1-URGENT' THEN CAST(o_orderkey AS VARCHAR) WHEN '2-HIGH' THEN '-' || o_custkey
    WHEN '3-MEDIUM' THEN o_orderkey || '.5' WHEN '5-LOW' THEN 'n/a' END AS balance,
    CAST(o_custkey AS VARCHAR) AS customerId FROM orders),
{_UNEVEN_ADDRESSES}, {_parsed()}
SELECT 'account' AS kind, CASE WHEN regexp_full_match(balance, '[+-]?[0-9]+') THEN accountId END AS id,
  CASE WHEN regexp_full_match(balance, '[+-]?[0-9]+') THEN balance END AS value,
  CASE WHEN NOT COALESCE(regexp_full_match(balance, '[+-]?[0-9]+'), false) THEN '{BALANCE}' END AS reason,
  CASE WHEN NOT COALESCE(regexp_full_match(balance, '[+-]?[0-9]+'), false)
       THEN customerId || ',' || accountId || ',' || COALESCE(balance, '') END AS record
FROM shaped
UNION ALL
SELECT 'address', CASE WHEN number IS NOT NULL AND country IS NOT NULL THEN addressId END,
  CASE WHEN number IS NOT NULL AND country IS NOT NULL THEN address END,
  CASE WHEN number IS NULL OR country IS NULL THEN '{ADDRESS}' END,
  CASE WHEN number IS NULL OR country IS NULL
       THEN addressId || ',' || customerId || ',' || COALESCE('"' || address || '"', '') END
FROM addresses""")
def q34_sifted_rows(spark, sf_dir):
    """Sound accounts and addresses, and the text of the others with the reason."""
    found = []
    for kind, rows, faults, key, value in (
        ("account", text_balances(spark, sf_dir), {BALANCE: bad_balance()}, "accountId", "balance"),
        ("address", uneven_addresses(spark, sf_dir), {ADDRESS: bad_address()}, "addressId", "address"),
    ):
        parts = sift(rows, faults, _folder(spark, "sifted"))
        none = F.lit(None).cast("string")
        kept = [F.lit(kind).alias("kind"), F.col(key).alias("id"), F.col(value).alias("value")]
        found.append(parts.sound.select(*kept, none.alias("reason"), none.alias("record")))
        empty = [F.lit(kind).alias("kind"), none.alias("id"), none.alias("value")]
        found.append(parts.rejected.select(*empty, "reason", "record"))
    return found[0].union(found[1]).union(found[2]).union(found[3])


@_query(f"{_LINKED} SELECT n AS linkedCustomers FROM linked")
def q35_indexed_count(spark, sf_dir):
    """The count by the documents' side table of countries, of which a list reads few row groups."""
    path = _folder(spark, "countries")
    write_countries(order_documents(spark, sf_dir), path)
    return count_linked_in(read_countries(spark, path), LINK)


@_query(f"""{_ORDER_DOCUMENTS}, {_LISTED}
SELECT DISTINCT p.customerId FROM pairs p JOIN customers c ON c.customerId = p.customerId""")
def q36_indexed_watch_list(spark, sf_dir):
    """The customers whom a watch-list that is a table links, by the side table."""
    path = _folder(spark, "countries")
    write_countries(order_documents(spark, sf_dir), path)
    return linked_by(read_countries(spark, path), listed_nations(spark, sf_dir), "n_name").select("customerId")
