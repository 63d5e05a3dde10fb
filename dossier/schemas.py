"""Record types, one ``StructType`` each. Field order is part of the output."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The column names, their order and their types are the data contract.


def _record(*fields):
    return StructType([StructField(name, kind) for name, kind in fields])


CUSTOMER = _record(
    ("customerId", StringType()),
    ("forename", StringType()),
    ("surname", StringType()),
)

# An account as it stands in a CSV file, before its balance is cast.
ACCOUNT_RAW = _record(
    ("customerId", StringType()),
    ("accountId", StringType()),
    ("balance", StringType()),
)

ACCOUNT = _record(
    ("customerId", StringType()),
    ("accountId", StringType()),
    ("balance", LongType()),
)

CUSTOMER_ACCOUNT = _record(
    ("customerId", StringType()),
    ("forename", StringType()),
    ("surname", StringType()),
    ("accounts", ArrayType(ACCOUNT)),
    ("numberAccounts", IntegerType()),
    ("totalBalance", LongType()),
    ("averageBalance", DoubleType()),
)

# What a customer's accounts come to, without the accounts.
CUSTOMER_STATS = _record(
    ("customerId", StringType()),
    ("forename", StringType()),
    ("surname", StringType()),
    ("numberAccounts", IntegerType()),
    ("totalBalance", LongType()),
    ("averageBalance", DoubleType()),
)

ADDRESS_RAW = _record(
    ("addressId", StringType()),
    ("customerId", StringType()),
    ("address", StringType()),
)

ADDRESS = _record(
    ("addressId", StringType()),
    ("customerId", StringType()),
    ("address", StringType()),
    ("number", IntegerType()),
    ("road", StringType()),
    ("city", StringType()),
    ("country", StringType()),
)

CUSTOMER_DOCUMENT = _record(
    ("customerId", StringType()),
    ("forename", StringType()),
    ("surname", StringType()),
    ("accounts", ArrayType(ACCOUNT)),
    ("address", ArrayType(ADDRESS)),
)

SCORED_DOCUMENT = StructType([*CUSTOMER_DOCUMENT.fields, StructField("linkToBVI", BooleanType())])

FULL_NAME = _record(
    ("firstName", StringType()),
    ("surname", StringType()),
)

CUSTOMER_MODEL = _record(
    ("customerId", StringType()),
    ("forename", StringType()),
    ("surname", StringType()),
    ("fullname", FULL_NAME),
)

# A part of a customer's children, in the one array or in the other; see ``plans/parts.py``.
PART = "part"
DOCUMENT_PART = _record(
    ("customerId", StringType()),
    (PART, LongType()),
    ("accounts", ArrayType(ACCOUNT)),
    ("address", ArrayType(ADDRESS)),
)
