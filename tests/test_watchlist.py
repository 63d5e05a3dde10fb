import random

import pytest
from pyspark.sql import functions as F

from dossier.plans.documents import build_documents
from dossier.plans.scoring import count_linked, flag_customers, score_link
from dossier.plans.watchlist import count_listed, flag_listed, score_listed
from tests.test_plans import no_broadcast  # noqa: F401
from tests.util import accounts, addresses, customers, plan

LANDS = [f"Land {i}" for i in range(12)]


def made(spark, seed):
    rnd = random.Random(seed)
    cus = [f"C{i}" for i in range(30)] + ["C1", "C1", (None, "f", "s")]
    adr = [(f"D{i}", rnd.choice(["C0", f"C{rnd.randrange(35)}"]), f"{i}, r, c, {rnd.choice(LANDS)}") for i in range(150)]
    adr += [("DX", None, "1, r, c, Land 3"), ("DY", "C99", "not an address")]
    return customers(spark, *cus), addresses(spark, *adr).repartition(3)


def names_of(spark, names):
    return spark.createDataFrame([(n,) for n in names], "country string")


@pytest.mark.parametrize("names", [[], ["Land 3"], ["Land 1", "Land 1", None, "Land 7", "land 2", "Nowhere"], LANDS])
@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_flags_equal_those_of_a_list(spark, names, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    cus, adr = made(spark, len(names))
    documents = build_documents(cus, accounts(spark), adr)
    real = [n for n in names if n is not None]
    wanted = {
        (r.customerId, tuple(sorted({a.country for a in r.address} & set(real))))
        for r in documents.collect()
    }
    scored = score_listed(documents, names_of(spark, names), "country", "hit", "names")
    flat = flag_listed(cus, adr, names_of(spark, names), "country", "hit", "names")
    for df in (scored, flat):
        rows = df.collect()
        assert len(rows) == 33 and {(r.customerId, tuple(r.names)) for r in rows} == wanted
        assert all(r.hit == bool(r.names) for r in rows)
    if real:
        listed = score_link(documents, real, "hit")
        assert sorted((str(r.customerId), r.hit) for r in listed.collect()) == sorted((str(r.customerId), r.hit) for r in scored.collect())
        flags = flag_customers(cus, adr, real, "hit")
        assert count_linked(flags, "hit").first()[0] == count_linked(flat, "hit").first()[0]
    counts = {r.name: r.linkedCustomers for r in count_listed(scored, "names").collect()}
    assert counts == {n: sum(n in r.names for r in scored.collect()) for n in {n for _, ns in wanted for n in ns}}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_plan_of_constant_size_for_any_number_of_names(spark):
    cus, adr = made(spark, 1)
    few = spark.range(3).select(F.concat(F.lit("Land "), "id").alias("country"))
    many = spark.range(100_000).select(F.concat(F.lit("Land "), "id").alias("country"))
    texts = [plan(flag_listed(cus, adr, names, "country")) for names in (few, many)]
    assert abs(len(texts[0]) - len(texts[1])) < 100
    wanted = flag_listed(cus, adr, names_of(spark, LANDS), "country")
    assert sorted(map(str, flag_listed(cus, adr, many, "country").collect())) == sorted(map(str, wanted.collect()))


def test_hot_countries_and_customers_shrink_before_the_join(spark, no_broadcast):  # noqa: F811
    cus, adr = made(spark, 2)
    text = plan(flag_listed(cus, adr, names_of(spark, LANDS), "country"))
    join = text.index("Join Inner") if "Join Inner" in text else text.index("SortMergeJoin")
    assert "HashAggregate" in text[:join]


def test_a_malformed_address_of_a_known_customer_fails(spark):
    cus, adr = customers(spark, "C1"), addresses(spark, ("D1", "C1", "no address"))
    names = names_of(spark, ["x"])
    with pytest.raises(Exception, match="malformed address of customer C1"):
        flag_listed(cus, adr, names, "country").count()
    assert [r.linkToBVI for r in flag_listed(cus, adr, names, "country", mode="lenient").collect()] == [False]
    assert flag_listed(cus, addresses(spark, ("D1", "C2", "no address")), names, "country").count() == 1


def test_columns_that_are_there_already(spark):
    cus, adr = made(spark, 3)
    with pytest.raises(ValueError, match="already there: matchedNames"):
        flag_listed(cus.withColumn("matchedNames", F.lit(1)), adr, names_of(spark, []), "country")
