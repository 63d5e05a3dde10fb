"""The side table of countries: same counts, and row groups that are not read."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dossier.plans.countries import count_linked_in, linked_by, linked_in, read_countries, write_countries
from dossier.plans.documents import build_documents
from dossier.plans.scoring import count_linked, score_link
from dossier.sources.stored import read_manifest
from tests.util import accounts, addresses, customers

LANDS = [f"Land {i:02}" for i in range(20)]


def documents(spark):
    adr = [(f"D{i}", f"C{i % 37}", f"{i}, r, c, {LANDS[(i * i) % 19]}") for i in range(300)]
    adr += [("X1", "C5", "1, r, c, Rare"), ("X2", "C5", "2, r, c, Rare"), ("X3", "C6", "odd")]
    cus = customers(spark, *[f"C{i}" for i in range(45)], "C5", (None, "f", "s"))
    return build_documents(cus, accounts(spark), addresses(spark, *adr).repartition(3), "lenient")


@pytest.mark.parametrize("listed", [["Rare"], ["Nowhere"], [], ["Land 00", "Rare"], LANDS])
def test_counts_equal_those_of_the_documents(spark, tmp_path, listed):
    stored, path = documents(spark), str(tmp_path / "countries")
    write_countries(stored, path)
    countries = read_countries(spark, path)
    expected = count_linked(score_link(stored, listed or ["Nowhere"])).first()[0]
    assert count_linked_in(countries, listed).first()[0] == (expected if listed else 0)
    names = spark.createDataFrame([(n,) for n in [*listed, None]], "n string")
    by_table = linked_by(countries, names, "n")
    assert sorted(by_table.collect()) == sorted(linked_in(countries, listed).collect())


def scanned(spark, make):
    """How many rows the scan handed on: those of the row groups that were read."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = make()
        df.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    leaf = df._jdf.queryExecution().executedPlan()
    while leaf.children().size():
        leaf = leaf.children().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture
def many(spark, tmp_path):
    """400,000 documents with one country each, 200 countries, in row groups of a few thousand rows."""
    place = F.struct(*[F.lit("x").alias(n) for n in ("addressId", "customerId", "address")], F.concat(F.lit("Land "), F.lpad((F.col("id") % 200).cast("string"), 3, "0")).alias("country"))
    stored = spark.range(0, 400_000, 1, 4).select(F.col("id").cast("string").alias("customerId"), F.array(place).alias("address"))
    path = str(tmp_path / "countries")
    write_countries(stored, path, group_bytes=64 << 10)
    return path


def test_a_rare_country_skips_row_groups(spark, many):
    files = glob.glob(f"{many}/{read_manifest(spark, many).data}/*.parquet")
    assert sum(pq.ParquetFile(f).metadata.num_row_groups for f in files) > 8
    countries = read_countries(spark, many)
    one = linked_in(countries, ["Land 123"])
    assert one.count() == 2000 and scanned(spark, lambda: linked_in(countries, ["Land 123"])) < 400_000 / 5
    # Within the bounds of a row group, but not in its filter.
    assert scanned(spark, lambda: linked_in(countries, ["Land 123x"])) == 0


def test_a_hot_country_is_spread_over_tasks(spark, tmp_path):
    place = F.struct(F.lit("Hot").alias("country"))
    stored = spark.range(0, 50_000, 1, 4).select(F.col("id").cast("string").alias("customerId"), F.array(place).alias("address"))
    path = str(tmp_path / "hot")
    write_countries(stored, path)
    files = glob.glob(f"{path}/{read_manifest(spark, path).data}/*.parquet")
    rows = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert sum(rows) == 50_000 and (len(rows) == 1 or max(rows) < 40_000)
