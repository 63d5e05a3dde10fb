"""What the physical plans must and must not hold."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from dossier.operators.nesting import Children, attach_children
from dossier.plans.documents import build_customer_accounts, build_customer_stats, build_documents
from dossier.plans.scoring import count_linked, score_link
from dossier.queries import QUERIES
from dossier.sources.files import read_customer_documents, write_stage
from tests.util import accounts, addresses, customers, plan

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def operators(text, name):
    return len(re.findall(rf"^\(\d+\) {name}\b", text, re.M))


def inputs(spark):
    return (customers(spark, "C1", "C2"), accounts(spark, ("C1", "A1", "4")), addresses(spark, ("D1", "C1", "1, a, b, c")))


def test_accounts_shuffle_each_side_once(spark, no_broadcast):
    cus, acc, _ = inputs(spark)
    text = plan(build_customer_accounts(cus, acc))
    assert operators(text, "Exchange") == 2 and operators(text, "SortMergeJoin") == 1


def test_documents_shuffle_each_input_once(spark, no_broadcast):
    text = plan(build_documents(*inputs(spark)))
    assert operators(text, "Exchange") == 3 and operators(text, "SortMergeJoin") == 2


def scans(text, path):
    return len(re.findall(rf"^Location: .*{re.escape(path)}", text, re.M))


@pytest.mark.parametrize("limits", [{}, {"max_repeats": 1}], ids=str)
def test_each_input_is_scanned_once_and_shuffled_at_most_twice(spark, no_broadcast, tmp_path, limits):
    """Repeated parents cost each input one shuffle more, and no other scan."""
    cus, acc, adr = inputs(spark)
    read = []
    for name, df in (("cus", cus.union(cus)), ("acc", acc), ("adr", adr)):
        df.write.parquet(str(tmp_path / name))
        read.append(spark.read.parquet(str(tmp_path / name)))
    text = plan(build_documents(*read, **limits))
    assert [scans(text, str(tmp_path / name)) for name in ("cus", "acc", "adr")] == [1, 1, 1]
    marks = scans(text, "repeats-")
    assert operators(text, "Exchange") - marks <= 6


def test_stats_add_up_before_they_shuffle(spark, no_broadcast):
    cus, acc, _ = inputs(spark)
    text = plan(build_customer_stats(cus, acc))
    # The accounts' shuffle gets sums; the customers' own rows are all that is wanted of them.
    assert re.search(r"partial_sum\(balance", text) and operators(text, "Exchange") == 2
    assert re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text, re.M)[1].count("sum#") == 1
    assert "collect_list" not in text


def test_addresses_are_shuffled_unparsed(spark, no_broadcast):
    text = plan(build_documents(*inputs(spark)))
    shuffled = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text, re.M)
    assert any("address#" in columns for columns in shuffled)
    assert not any("country#" in columns for columns in shuffled)


def test_count_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "documents")
    write_stage(build_documents(*inputs(spark)), path)
    text = plan(count_linked(score_link(read_customer_documents(spark, path))))
    assert re.findall(r"ReadSchema: (.*)", text) == ["struct<address:array<struct<country:string>>>"]
    assert operators(text, "Exchange") == 1  # of counts


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_join_in_any_query(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for banned in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "MapElements",
                   "CartesianProduct", "BroadcastNestedLoopJoin", "GlobalLimit", "CollectLimit"):
        assert banned not in text


def test_projection_prunes_children_of_parquet(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.sql("SELECT 'a' k, 'c' c, 'unused' u").write.parquet(path)
    df = attach_children(spark.sql("SELECT 'a' k"), "k", [Children(spark.read.parquet(path), "kids", ["c"])])
    assert all("u:" not in s for s in re.findall(r"ReadSchema: (.*)", plan(df)))


@pytest.fixture
def eager_skew_handling(spark):
    """No broadcasts, and adaptive execution that calls small partitions skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def final_plan(df):
    """The plan a one-row result ended up with, and that row."""
    row = df.collect()[0]
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    plan_text = text.getvalue()
    assert "isFinalPlan=true" in plan_text
    return plan_text.split("== Initial Plan ==")[0], row


def mostly_hot(spark, name):
    """20,000 rows in 8 tasks, nine in ten of key ``hot``, none like another."""
    key = F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("hot")
    return spark.range(0, 20_000, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias(name))


def test_hot_parents_are_split_even_without_broadcasts(spark, eager_skew_handling):
    """The join that marks a hot parent's rows is one that Spark splits; after it they are dealt out."""
    kids = [Children(spark.sql("SELECT 'hot' k, explode(sequence(1, 3)) c"), name, ["c"]) for name in ("a", "b")]
    df = attach_children(mostly_hot(spark, "p"), "k", kids)
    text, row = final_plan(df.agg(
        F.sum(F.size("a")).alias("a"), F.sum(F.size("b")).alias("b"), F.count("p").alias("rows"),
        F.max("p").alias("p")))
    assert "SortMergeJoin(skew=true)" in text and "_salt" in text
    assert tuple(row)[:3] == (54_000, 54_000, 20_000)
