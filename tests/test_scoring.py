import pytest

from dossier.plans.documents import build_documents
from dossier.plans.scoring import count_linked, count_linked_flat, report_linked, score_link
from dossier.schemas import CUSTOMER_DOCUMENT, SCORED_DOCUMENT
from tests.util import accounts, addresses, customers, plain

BVI = "British Virgin Islands"


def address(i, customer, country):
    return (f"D{i}", customer, f"{i}, r, c, {country}")


def documents(spark, cus, adr, **options):
    return build_documents(customers(spark, *cus), accounts(spark), addresses(spark, *adr), **options)


def flags(scored, flag="linkToBVI"):
    return sorted((r.customerId, r[flag]) for r in scored.collect())


def test_any_match(spark):
    adr = [address(1, "one", "Denmark"), address(2, "one", BVI), address(3, "two", "Ireland"),
           address(4, "lower", BVI.lower()), address(5, "blank", BVI + " "), address(6, "longer", BVI + "x")]
    cus = ["one", "two", "none", "lower", "blank", "longer"]
    scored = score_link(documents(spark, cus, adr))
    assert scored.schema.simpleString() == SCORED_DOCUMENT.simpleString()
    assert [c for c, linked in flags(scored) if linked] == ["one"]
    assert all(linked is not None for _, linked in flags(scored))


def test_null_countries_and_null_arrays_are_false(spark):
    schema = CUSTOMER_DOCUMENT
    null = ("D1", "C", "x", None, None, None, None)
    match = ("D2", "C", "x", 1, "r", "c", BVI)
    rows = [("nulls", "f", "s", [], [null]), ("both", "f", "s", [], [null, match]),
            ("empty", "f", "s", [], []), ("missing", "f", "s", [], None)]
    df = spark.createDataFrame(rows, schema)
    for countries in ([BVI], [BVI, "Ireland"]):
        assert [c for c, linked in flags(score_link(df, countries)) if linked] == ["both"]
        assert all(linked is not None for _, linked in flags(score_link(df, countries)))


def test_watch_list(spark):
    adr = [address(1, "a", BVI), address(2, "b", "Ireland"), address(3, "c", "Denmark")]
    scored = score_link(documents(spark, "abc", adr), [BVI, "Ireland"], "risky")
    assert flags(scored, "risky") == [("a", True), ("b", True), ("c", False)]


def test_empty_watch_list(spark):
    adr = [address(1, "a", BVI)]
    assert flags(score_link(documents(spark, ["a"], adr), [], "risky"), "risky") == [("a", False)]
    assert count_linked_flat(customers(spark, "a"), addresses(spark, *adr), []).first()[0] == 0


@pytest.mark.parametrize("max_repeats", [1, 2, 100])
def test_count_is_of_rows(spark, max_repeats):
    adr = [address(i, "a", "Denmark") for i in range(9)] + [address(10, "a", BVI), address(11, "a", BVI)]
    adr += [address(i, "b", "Ireland") for i in range(20, 25)] + [address(30, "c", BVI)]
    adr += [address(40, "orphan", BVI), address(41, None, BVI)]
    cus = ["a", "a", "b", "c", "d", None]
    docs = documents(spark, cus, adr, max_repeats=max_repeats)
    scored = score_link(docs)
    assert {(c, linked) for c, linked in flags(scored.where("customerId IS NOT NULL"))} == {
        ("a", True), ("b", False), ("c", True), ("d", False)}
    assert scored.count() == docs.count()
    assert plain(count_linked(scored).first()) == (3,)
    assert plain(count_linked_flat(customers(spark, *cus), addresses(spark, *adr)).first()) == (3,)


def test_count_of_nothing_is_zero(spark):
    adr = [address(1, "a", "Denmark")]
    assert count_linked(score_link(documents(spark, ["a"], adr))).first()[0] == 0
    assert count_linked_flat(customers(spark, "a"), addresses(spark, *adr)).first()[0] == 0


def test_flat_count_is_as_strict_as_documents(spark):
    cus = customers(spark, "a")
    orphan = addresses(spark, address(1, "a", BVI), ("D2", "orphan", "bad"))
    assert count_linked_flat(cus, orphan).first()[0] == 1
    known = addresses(spark, address(1, "a", BVI), ("D2", "a", "bad"))
    with pytest.raises(Exception, match="malformed address of customer a"):
        count_linked_flat(cus, known).collect()
    assert count_linked_flat(cus, known, mode="lenient").first()[0] == 1


def test_orphan_faults_stay_out_of_the_count(spark):
    """The count needs linked customers only, which must not turn the join into an inner one."""
    docs = documents(spark, ["a"], [address(1, "a", BVI), ("D2", "orphan", "bad")])
    assert count_linked(score_link(docs)).first()[0] == 1


def test_report(spark):
    counted = spark.sql("SELECT 28L AS linkedCustomers")
    assert report_linked(counted).first().report == "Number of customers linked to British Virgin Islands: 28"
