import random
from collections import Counter, defaultdict

import pytest

from dossier.llm import mixing
from dossier.llm.mixing import mixed_documents, mixing_plan, mixture_sizes, targets
from dossier.llm.queries import op6_mixing
from tests.llm.util import documents, prose, words

SF = "/root/testdata/sf0.001"


def expected_targets(sizes):
    """Water filling by repetition: cap what is above three times its size, share the rest anew."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, open_sources, found = float(sum(sizes.values())), set(order), {}
    while open_sources:
        left = total - sum(found.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_sources) for s in open_sources}
        full = {s for s in open_sources if share[s] > 3 * sizes[s]}
        if not full:
            return found | share
        found |= {s: 3.0 * sizes[s] for s in full}
        open_sources -= full
    return found


@pytest.mark.parametrize("seed", range(6))
def test_targets_against_repetition(spark, seed):
    rnd = random.Random(seed)
    names = [*rnd.sample(["a", "B", "é", "z9", "😀", "ab", "", "~", "\ue000"], rnd.randrange(1, 9)), None]
    sizes = {s: rnd.choice([0, 3, 50, 1000, 40_000]) for s in names}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    found = {r.source: r.target for r in targets(rows).collect()}
    assert found == pytest.approx(expected_targets(sizes))


def check(rows, given):
    """Whole results, sizes, targets, and what dependent rounding promises."""
    assert sorted(((r.doc_id, r.source, r["size"]) for r in rows), key=repr) == sorted(given, key=repr)
    sizes = defaultdict(int)
    for _, source, size in given:
        sizes[source] += size
    goals = expected_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goals[r.source])
        assert r.taken % max(1, r["size"]) == 0 and 0 <= r.taken <= 3 * r["size"]
        if r["size"]:
            each = goals[r.source] / sizes[r.source]
            assert int(each + 1e-9) <= r.taken // r["size"] <= -(-each // 1) + 1e-9
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= largest[source] + 1e-6


def corpus(seed):
    rnd = random.Random(seed)
    rows = [(i, prose(rnd, rnd.choice([1, 5, 40, 300])), "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(300)]
    rows += [(900, "", "en", "s1"), (901, None, "en", "s1"), (902, "a b c", "en", None), (None, "no id here", "en", "hot")]
    return rows + [(903, "same same", "en", "hot")] * 40 + [(904, None, None, "empty")] * 3 + [(905, prose(rnd, 20_000), "en", "long")]


def triples(rows):
    return [(i, s, len(words(t))) for i, t, _, s in rows]


@pytest.mark.parametrize("fan_in", [2, 16])
@pytest.mark.parametrize("piece", [7, 10_000])
def test_sources_meet_their_targets(spark, monkeypatch, fan_in, piece):
    monkeypatch.setattr(mixing, "PIECE", piece)
    rows = corpus(fan_in)
    df = documents(spark, *rows).withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "copies")
    check(mixture_sizes(df.repartition(5), fan_in=fan_in).collect(), triples(rows))


def test_reruns_agree_however_rows_are_dealt(spark):
    rows = corpus(1)
    df = documents(spark, *rows)
    first = sorted(map(repr, mixture_sizes(df.repartition(7)).collect()))
    assert first == sorted(map(repr, mixture_sizes(df.repartition(2, "source")).collect()))


def test_each_document_keeps_its_expectation(spark):
    """Over many ids, the share taken once more is near the open probability for large and small documents."""
    rows = [(i, "w " * (1 if i % 2 else 30), "en", "a") for i in range(3000)]
    rows += [(10_000 + i, "w " * 25, "en", "b") for i in range(1000)]
    found = mixture_sizes(documents(spark, *rows)).collect()
    (a,) = {r.target / r.source_size for r in found if r.source == "a"}
    for size in (1, 30):
        copies = [r.copies for r in found if r.source == "a" and r["size"] == size]
        assert sum(copies) / len(copies) == pytest.approx(a, abs=0.04)


def test_documents_with_copies(spark):
    rows = corpus(3)
    df = documents(spark, *rows).repartition(4)
    mixed = mixed_documents(df)
    assert mixed.columns == [*df.columns, "copies"]
    found = Counter()
    for r in mixed.collect():
        assert r.copies > 0
        found[r.doc_id, r.source, len(words(r.text))] += r.copies
    planned = Counter()
    for r in mixing_plan(df).collect():
        planned[r.id, r.source, r["size"]] += r.copies * r.rows + r.more_rows
    assert found == +planned


def test_one_document_and_none(spark):
    (row,) = mixture_sizes(documents(spark, "one two three")).collect()
    assert (row.taken, row.target) == (3, 3.0)
    assert mixture_sizes(documents(spark)).count() == 0
    assert mixed_documents(documents(spark)).count() == 0
    assert [r.taken for r in mixture_sizes(documents(spark, None, "")).collect()] == [0, 0]


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check(op6_mixing(spark, SF).collect(), [(r.doc_id, r.source, len(words(r.text))) for r in rows])


@pytest.mark.parametrize("name", ["_rows", "_number", "_words", "_id", "_size", "_taken", "_source", "_copies", "copies", "_more_rows"])
def test_columns_that_clash(spark, name):
    docs = documents(spark, *[f"some words of text {i}" for i in range(20)]).selectExpr("*", f"doc_id + 100 AS {name}")
    mixed = mixed_documents(docs)
    count = "mix_copies" if name == "copies" else "copies"
    assert mixed.columns == [*docs.columns, count]
    rows = mixed.collect()
    assert rows and all(r[name] == r.doc_id + 100 and r[count] >= 1 for r in rows)
