"""Documents and scores of random inputs against plain Python."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dossier.operators.repeats import Repeats, find_crowded
from dossier.plans.documents import build_customer_accounts, build_customer_documents, build_documents
from dossier.plans.parts import build_document_parts
from dossier.plans.scoring import (
    count_linked,
    count_linked_flat,
    count_linked_parts,
    flag_customers,
    score_link,
    score_parts,
)
from tests.util import accounts, addresses, customers, plain

LISTED = ["X", "Y"]
KEYS = st.sampled_from([None, "a", "b", "c", "d"])
TEXTS = {
    "1, r, c, X": (1, "r", "c", "X"),
    "2, r, c, Y": (2, "r", "c", "Y"),
    "3, r, c, Z": (3, "r", "c", "Z"),
    "4, r, c, x": (4, "r", "c", "x"),
    "5, r, X, ": (5, "r", "X", None),
    "six, r, c, X": (None, "r", "c", "X"),
    None: (None, None, None, None),
}


def low(value):
    """A sort key with nulls first, at any depth."""
    return tuple(low(v) for v in value) if isinstance(value, tuple) else (value is not None, value or 0)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    cus=st.lists(KEYS, min_size=1, max_size=8),
    acc=st.lists(st.tuples(KEYS, st.sampled_from("123"), st.sampled_from(["7", "8", "bad", None])), max_size=12),
    adr=st.lists(st.tuples(st.sampled_from("12"), KEYS, st.sampled_from(list(TEXTS))), max_size=12),
    limits=st.fixed_dictionaries({"max_repeats": st.sampled_from([1, 2, 100])}),
    at_once=st.booleans(),
)
def test_documents_and_scores(spark, cus, acc, adr, limits, at_once):
    inputs = customers(spark, *cus), accounts(spark, *acc), addresses(spark, *adr)
    if at_once:
        documents = build_documents(*inputs, "lenient", **limits)
    else:
        stage = build_customer_accounts(*inputs[:2], "lenient", **limits)
        documents = build_customer_documents(stage, inputs[2], "lenient", **limits)
    scored = score_link(documents, LISTED, "linked")

    def of(key, rows):
        return tuple(sorted((r for r in rows if key is not None and key in r[:2]), key=low))

    balances = [(k, a, int(b) if b in ("7", "8") else None) for k, a, b in acc]
    places = [(d, k, text, *TEXTS[text]) for d, k, text in adr]
    expected = {}
    for key in set(cus):
        owned = of(key, [b for b in balances if b[0] == key])
        lived = of(key, [p for p in places if p[1] == key])
        expected[key] = (owned, lived, any(p[-1] in LISTED for p in lived))

    found = Counter()
    for row in scored.collect():
        found[row.customerId, plain(row.accounts), plain(row.address), row.linked] += 1
    times = Counter(cus)
    assert found == Counter({(key, *expected[key]): n for key, n in times.items()})
    linked = sum(times[key] for key in times if expected[key][2])
    assert count_linked(scored, "linked").first()[0] == linked
    assert count_linked_flat(inputs[0], inputs[2], LISTED, "lenient").first()[0] == linked
    flags = Counter((r.customerId, r.linked) for r in flag_customers(inputs[0], inputs[2], LISTED, "linked", "lenient").collect())
    assert flags == Counter({(key, expected[key][2]): n for key, n in times.items()})


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    cus=st.lists(KEYS, min_size=1, max_size=6),
    acc=st.lists(st.tuples(KEYS, st.sampled_from("123"), st.sampled_from(["7", "8", "bad", None])), max_size=20),
    adr=st.lists(st.tuples(st.sampled_from("12"), KEYS, st.sampled_from(list(TEXTS))), max_size=12),
    part_size=st.sampled_from([1, 2, 100]),
)
def test_parts(spark, cus, acc, adr, part_size):
    """Parts put together in their order are the children of the known customers, in ascending order."""
    inputs = customers(spark, *cus), accounts(spark, *acc).repartition(3), addresses(spark, *adr).repartition(3)
    parts = build_document_parts(*inputs, "lenient", part_size=part_size)
    owned, lived = {}, {}
    for row in sorted(parts.collect(), key=lambda r: r.part):
        assert 0 < len(row.accounts) + len(row.address) <= part_size and not (row.accounts and row.address)
        owned.setdefault(row.customerId, []).extend(map(plain, row.accounts))
        lived.setdefault(row.customerId, []).extend(map(plain, row.address))
    known = {key for key in cus if key is not None}
    balances = sorted(((k, a, int(b) if b in ("7", "8") else None) for k, a, b in acc if k in known), key=low)
    places = sorted(((d, k, text, *TEXTS[text]) for d, k, text in adr if k in known), key=low)
    assert {k: v for k, v in owned.items() if v} == {k: v for k in known if (v := [b for b in balances if b[0] == k])}
    assert {k: v for k, v in lived.items() if v} == {k: v for k in known if (v := [p for p in places if p[1] == k])}
    scored = score_parts(parts, LISTED, "linked")
    linked = {p[1] for p in places if p[-1] in LISTED}
    assert {r.customerId for r in scored.where("linked").collect()} == linked
    assert count_linked_parts(inputs[0], scored, "linked").first()[0] == sum(k in linked for k in cus)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    cus=st.lists(KEYS, min_size=1, max_size=6),
    acc=st.lists(st.tuples(KEYS, st.sampled_from("123"), st.sampled_from(["7", "8", None])), max_size=20),
    adr=st.lists(st.tuples(st.sampled_from("12"), KEYS, st.sampled_from(list(TEXTS))), max_size=12),
    part_size=st.sampled_from([1, 2, 100]),
)
def test_parts_of_large_customers_are_those_of_others(spark, cus, acc, adr, part_size):
    inputs = customers(spark, *cus), accounts(spark, *acc).repartition(3), addresses(spark, *adr).repartition(3)

    def children(**limits):
        found = {}
        parts = build_document_parts(*inputs, "lenient", part_size=part_size, **limits).collect()
        for row in sorted(parts, key=lambda r: r.part):
            assert 0 < len(row.accounts) + len(row.address) <= part_size and not (row.accounts and row.address)
            of = found.setdefault(row.customerId, ([], []))
            of[0].extend(map(plain, row.accounts))
            of[1].extend(map(plain, row.address))
        return found

    assert children(max_children=2) == children()


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (\w+)\(", plan.split("== Initial Plan ==")[-1])


def test_parts_are_grouped_where_their_customers_were_shuffled_to(spark):
    """One shuffle by customer for each of the two kinds of children and its customers, none of arrays."""
    rows = [("a", str(i), "7") for i in range(8)]
    inputs = customers(spark, "a", "b"), accounts(spark, *rows), addresses(spark, ("1", "a", "1, r, c, X"))
    hints = [x.hint("merge") for x in inputs]
    parts = build_document_parts(*hints, part_size=3)
    assert set(shuffles(parts)) == {"hashpartitioning"} and len(shuffles(parts)) == 4
    assert sorted(len(r.accounts) for r in parts.collect()) == [0, 2, 3, 3]


def test_crowded_keys(spark):
    rows = spark.range(60).selectExpr("CASE WHEN id < 20 THEN 'a' WHEN id < 25 THEN 'b' WHEN id < 50 THEN NULL ELSE 'c' || id END AS k")
    assert [tuple(r) for r in find_crowded(rows, "k", 6).table.collect()] == [("a", 4)]
    assert find_crowded(rows, "k", 20) == Repeats() == find_crowded(rows.limit(0), "k", 1)
