"""Bad input rows set aside, with the reason, instead of failing the job or leaving nulls.

One pass over the input writes sound and rejected rows to one committed stage, each kind
in a folder of its own, and counts them as they are written. What is sound passes strict
mode, with one exception: strict mode forgives malformed addresses of unknown customers.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dossier.functions.address import address_fields
from dossier.schemas import ACCOUNT_RAW, ADDRESS_RAW, CUSTOMER
from dossier.sources.files import CORRUPT, read_csv_whole
from dossier.sources.stored import Manifest, commit_stage, open_stage, read_manifest

# The reasons, in the order in which they are looked for, and where the columns of rejects come from.
ROW, BALANCE, ADDRESS = "row does not fit the header", "balance is not a whole number", "malformed address"
REASON, SOURCE, RECORD = "reason", "source", "record"
_REJECTED = "_rejected"
_AS_IT_IS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def bad_balance() -> Column:
    return F.col("balance").try_cast("bigint").isNull()


def bad_address() -> Column:
    fields = address_fields()
    return fields["number"].isNull() | fields["country"].isNull()


class Sifted(NamedTuple):
    """Sound rows as they were, rejected ones as ``reason``, ``source`` (the file) and ``record`` (the text)."""

    sound: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def sift(rows: DataFrame, faults: dict[str, Column], path: str) -> Sifted:
    """Part ``rows`` by ``faults``: for each reason, which rows have it. A row is rejected for the first one that it has.

    ``counts`` has ``rows``, ``sound`` and one number for each reason, taken in the pass that writes.
    """
    kept = [name for name in rows.columns if name != CORRUPT]
    reason = F.lit(None).cast("string")
    for name, bad in reversed(faults.items()):
        reason = F.when(F.coalesce(bad, F.lit(True)), name).otherwise(reason)
    text = F.to_csv(F.struct(*kept), _AS_IT_IS)
    if CORRUPT in rows.columns:
        text = F.coalesce(CORRUPT, text)
    marked = rows.withColumns({"_reason": reason, "_source": F.input_file_name(), "_record": text})
    bad = F.col("_reason").isNotNull()
    # Rejected rows have no use for the columns, sound ones none for the text.
    columns = [F.when(~bad, F.col(name)).alias(name) for name in kept]
    told = [F.when(bad, F.col(name)).alias(name) for name in ("_reason", "_source", "_record")]
    counts = {"sound": F.count_if(F.col("_reason").isNull())}
    counts |= {name: F.count_if(F.col("_reason").eqNullSafe(F.lit(name))) for name in faults}
    table = marked.select(*columns, *told, bad.alias(_REJECTED))
    return _opened(rows.sparkSession, path, commit_stage(table, path, counts=counts, split_by=_REJECTED))


def _opened(spark: SparkSession, path: str, manifest: Manifest) -> Sifted:
    table = open_stage(spark, path)
    rejected = F.col(_REJECTED)
    told = [F.col(f"_{name}").alias(name) for name in (REASON, SOURCE, RECORD)]
    kept = [name for name in table.columns if name not in (_REJECTED, "_reason", "_source", "_record")]
    return Sifted(table.where(~rejected).select(kept), table.where(rejected).select(told), manifest.counts)


def sifted(spark: SparkSession, path: str) -> Sifted:
    """What ``sift`` left at ``path``."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        raise ValueError(f"nothing was sifted at {path}")
    return _opened(spark, path, manifest)


def _sift_csv(spark: SparkSession, csv: str, path: str, schema: StructType, faults: dict[str, Column]) -> Sifted:
    return sift(read_csv_whole(spark, csv, schema), {ROW: F.col(CORRUPT).isNotNull(), **faults}, path)


def sift_customers(spark: SparkSession, csv: str, path: str) -> Sifted:
    return _sift_csv(spark, csv, path, CUSTOMER, {})


def sift_accounts(spark: SparkSession, csv: str, path: str) -> Sifted:
    return _sift_csv(spark, csv, path, ACCOUNT_RAW, {BALANCE: bad_balance()})


def sift_addresses(spark: SparkSession, csv: str, path: str) -> Sifted:
    return _sift_csv(spark, csv, path, ADDRESS_RAW, {ADDRESS: bad_address()})
