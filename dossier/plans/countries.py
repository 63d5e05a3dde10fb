"""Stored documents' countries beside them, so that a rare country is found without reading the others.

Documents hold their countries inside arrays, of which Parquet keeps no useful bounds: a
selective watch-list reads every row group. The side table has a row for each document
and country, sorted by country, with a Bloom filter in each row group; a filter on the
country then skips nearly all groups by their bounds, and others by their filters.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.plans.documents import KEY
from dossier.plans.scoring import WATCH_LIST
from dossier.plans.watchlist import watch_names
from dossier.sources.stored import commit_stage, open_stage

DOCUMENT, COUNTRY = "document", "country"

# Bytes of a row group: small ones are skipped more exactly.
GROUP_BYTES = 8 << 20


def write_countries(documents: DataFrame, path: str, group_bytes: int = GROUP_BYTES) -> None:
    """Store ``document`` (a number for each row), ``customerId`` and ``country``, each country of a document once.

    Rows are dealt by ranges of country and document, so that a country of a third of
    all documents is spread over tasks. Null countries are left out: no list has them.
    """
    numbered = documents.select(KEY, F.array_distinct("address.country").alias("_countries"))
    numbered = numbered.withColumn(DOCUMENT, F.monotonically_increasing_id())
    rows = numbered.select(DOCUMENT, KEY, F.explode("_countries").alias(COUNTRY)).where(f"{COUNTRY} IS NOT NULL")
    placed = rows.repartitionByRange(COUNTRY, DOCUMENT).sortWithinPartitions(COUNTRY, DOCUMENT)
    options = {f"parquet.bloom.filter.enabled#{COUNTRY}": "true", "parquet.block.size": str(group_bytes)}
    commit_stage(placed, path, options=options)


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    return open_stage(spark, path)


def linked_in(countries: DataFrame, listed: list[str]) -> DataFrame:
    """The documents, by number and customer, with any listed country, from their side table."""
    return countries.where(F.col(COUNTRY).isin(listed)).select(DOCUMENT, KEY).distinct()


def linked_by(countries: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """``linked_in`` for a watch-list that is a table; a small one skips row groups too, by what the join knows of it."""
    listed = watch_names(names, column)
    return countries.join(listed, F.col(COUNTRY) == F.col("_name"), "left_semi").select(DOCUMENT, KEY).distinct()


def count_linked_in(countries: DataFrame, listed: list[str] = WATCH_LIST) -> DataFrame:
    """``count_linked`` of the documents whose side table this is."""
    return linked_in(countries, listed).agg(F.count(F.lit(1)).alias("linkedCustomers"))
