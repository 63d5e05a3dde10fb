"""Readers and writers: CSV inputs and the Parquet stages between jobs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from dossier.functions.checks import check_mode
from dossier.schemas import (
    ACCOUNT_RAW,
    ADDRESS_RAW,
    CUSTOMER,
    CUSTOMER_ACCOUNT,
    CUSTOMER_DOCUMENT,
    CUSTOMER_MODEL,
    DOCUMENT_PART,
)
from dossier.sources.binding import conform
from dossier.sources.stored import open_stage, refuse_own_input

# The text of a row that does not fit its file's header.
CORRUPT = "_corrupt"


def read_csv(spark: SparkSession, path: str, schema: StructType, mode: str = "strict") -> DataFrame:
    """CSV with a header, bound by header name, every value a string.

    No schema goes to the reader, as that would bind by position; checking each
    file's header (``enforceSchema``) makes a file with another column order an
    error. Strict mode fails on rows with too few or too many values, whatever
    columns are used in the end: Spark only checks the columns it parses.
    """
    check_mode(mode)
    strict = mode == "strict"
    reader = spark.read.option("columnPruning", str(not strict).lower())
    raw = reader.csv(
        path, header=True, enforceSchema=False, mode="FAILFAST" if strict else "PERMISSIVE"
    )
    return conform(raw, schema)


def read_csv_whole(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV as by ``read_csv``, with the column ``CORRUPT``: the whole text of rows with too few or too many values."""
    names = spark.read.csv(path, header=True).columns
    full = StructType([StructField(name, StringType()) for name in (*names, CORRUPT)])
    reader = spark.read.option("columnPruning", "false").option("columnNameOfCorruptRecord", CORRUPT)
    raw = reader.csv(path, schema=full, header=True, enforceSchema=False, mode="PERMISSIVE")
    return conform(raw, StructType([*schema.fields, StructField(CORRUPT, StringType())]))


def read_customers(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    return read_csv(spark, path, CUSTOMER, mode)


def read_accounts(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Accounts with the balance still text; see ``cast_balance``."""
    return read_csv(spark, path, ACCOUNT_RAW, mode)


def read_addresses(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    return read_csv(spark, path, ADDRESS_RAW, mode)


def read_stage(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stage, committed or plain Parquet, bound by name, nested fields included."""
    return conform(open_stage(spark, path), schema)


def read_customer_accounts(spark: SparkSession, path: str) -> DataFrame:
    return read_stage(spark, path, CUSTOMER_ACCOUNT)


def read_customer_documents(spark: SparkSession, path: str) -> DataFrame:
    return read_stage(spark, path, CUSTOMER_DOCUMENT)


def read_customer_model(spark: SparkSession, path: str) -> DataFrame:
    return read_stage(spark, path, CUSTOMER_MODEL)


def read_scored_documents(spark: SparkSession, path: str, flag: str) -> DataFrame:
    """Documents stored with a flag of that name."""
    schema = StructType([*CUSTOMER_DOCUMENT.fields, StructField(flag, BooleanType())])
    return read_stage(spark, path, schema)


def read_document_parts(spark: SparkSession, path: str) -> DataFrame:
    return read_stage(spark, path, DOCUMENT_PART)


def write_stage(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with plain Parquet files; an error if ``df`` is read from it."""
    refuse_own_input(df, path)
    df.write.mode("overwrite").parquet(path)
