import os
import random
import uuid
from collections import Counter
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dossier.operators.nesting import Children, attach_children
from dossier.operators.repeats import SALT, WIDTH, Repeats, dealt_out, find_repeats
from dossier.operators.staging import scratch_dir, scratch_run, staged
from tests.util import plain

FIELDS = ["k", "c", "v"]


def totals():
    return {"n": F.count(F.lit(1)), "total": F.sum("v")}


def parents_of(spark, rows):
    return spark.createDataFrame(rows, "k string, p string")


def children_of(spark, rows):
    return spark.createDataFrame(rows, "k string, c string, v long")


def attach(spark, parents, children, **options):
    kids = Children(children_of(spark, children), "kids", FIELDS, totals())
    return attach_children(parents_of(spark, parents), "k", [kids], **options)


def expected(parents, children):
    """Every parent with its sorted children, as a multiset."""
    of = {}
    for child in children:
        of.setdefault(child[0], []).append(child)
    rows = []
    for key, name in parents:
        kids = sorted(of.get(key, []) if key is not None else [],
                      key=lambda c: (c[1] is not None, c[1] or "", c[2] is not None, c[2] or 0))
        values = [c[2] for c in kids if c[2] is not None]
        rows.append((key, name, tuple(kids), len(kids) or None, sum(values) if values else None))
    return Counter(rows)


def whole(df):
    return Counter((r.k, r.p, plain(r.kids), r.n, r.total) for r in df.collect())


def test_children_sorted_counted_and_kept_whole(spark):
    df = attach(spark, [("a", "x")], [("a", "3", 1), ("a", "1", 2), ("a", None, 4)])
    row = df.first()
    assert plain(row.kids) == (("a", None, 4), ("a", "1", 2), ("a", "3", 1))
    assert (row.n, row.total) == (3, 7)


def test_childless_parent_has_an_empty_array(spark):
    row = attach(spark, [("a", "x")], [("b", "1", 1)]).first()
    assert row.kids == [] and row.n is None


def test_repeated_parents_stay_apart(spark):
    parents, children = [("a", "x"), ("a", "x"), ("a", "y")], [("a", "1", 1), ("a", "2", 2)]
    assert whole(attach(spark, parents, children)) == expected(parents, children)


def test_null_keys_match_nothing(spark):
    parents, children = [(None, "x"), ("a", "y")], [(None, "1", 1)]
    assert whole(attach(spark, parents, children)) == expected(parents, children)


LIMITS = [{}, {"max_repeats": 1}, {"max_repeats": 2}, {"max_repeats": 5}]


@pytest.mark.parametrize("limits", LIMITS, ids=str)
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_hot_keys_and_copies(spark, limits, broadcast):
    """One key has most rows on both sides, many of them copies; nothing may be lost or doubled."""
    rnd = random.Random(7)
    children = [("hot", str(rnd.randrange(40)), rnd.randrange(5)) for _ in range(200)]
    children += [("hot", "copy", 1)] * 100 + [(None, "n", 1)] * 20
    children += [(f"k{rnd.randrange(30)}", str(i), i) for i in range(60)] + [("orphan", "o", 1)] * 5
    parents = [("hot", "same")] * 7 + [("hot", "other"), (None, "n"), (None, "n"), (None, "n")]
    parents += [(f"k{i}", "p") for i in range(40)] + [("k1", "q")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert whole(attach(spark, parents, children, **limits)) == expected(parents, children)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


KEYS = st.sampled_from([None, "a", "b", "c", "d"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(KEYS, st.sampled_from(["x", "y"])), min_size=1, max_size=12),
    st.lists(st.tuples(KEYS, st.sampled_from([None, "1", "2", "3"]), st.sampled_from([None, 1, 2])), max_size=25),
    st.sampled_from([1, 2, 100]),
)
def test_any_input_against_brute_force(spark, parents, children, max_repeats):
    df = attach(spark, parents, children, max_repeats=max_repeats)
    assert whole(df) == expected(parents, children)


@pytest.mark.parametrize("max_repeats", [1, 100])
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_several_kinds_of_children(spark, max_repeats, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    parents = [("a", "x"), ("b", "x"), ("b", "x"), (None, "x")]
    kids = children_of(spark, [("a", str(i), 1) for i in range(4)] + [("b", "1", 1)])
    pets = spark.createDataFrame([("a", str(i)) for i in range(7)] + [("b", "z")] * 2, "k string, d string")
    kinds = [Children(kids, "kids", FIELDS), Children(pets, "pets", ["d"])]
    both = attach_children(parents_of(spark, parents), "k", kinds, max_repeats=max_repeats).collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = sorted((repr(r.k), [k.c for k in r.kids], [k.d for k in r.pets]) for r in both)
    assert found == [("'a'", list("0123"), list("0123456")), ("'b'", ["1"], ["z", "z"]), ("'b'", ["1"], ["z", "z"]), ("None", [], [])]


@pytest.mark.parametrize("copies", [False, True])
def test_rows_of_a_hot_parent_spread_over_its_salts(spark, copies):
    rows = spark.range(0, 8000, 1, 16).select(F.lit("hot").alias("k"), (F.lit(1) if copies else F.col("id")).alias("p"))
    repeats = find_repeats(rows, "k", 500)
    sizes = [r["count"] for r in dealt_out(rows, "k", repeats.table).groupBy(SALT).count().collect()]
    assert sum(sizes) == 8000 and len(sizes) >= 8 and max(sizes) <= 2500


def test_repeats_are_exact(spark):
    rows = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4 + [(None,)] * 9, "k string")
    found = find_repeats(rows, "k", 4)
    assert {(r.k, r[WIDTH]) for r in found.table.collect()} == {("a", 2), (None, 3)}
    assert find_repeats(rows, "k", 9) == Repeats()
    assert find_repeats(rows.limit(0), "k", 1) == Repeats()


def test_repeats_found_ahead(spark):
    parents, children = [("a", "x")] * 3 + [("b", "y")], [("a", str(i), i) for i in range(9)] + [("b", "1", 1)]
    repeats = find_repeats(parents_of(spark, parents), "k", 2)
    assert whole(attach(spark, parents, children, repeats=repeats)) == expected(parents, children)


def test_limits_are_positive(spark):
    with pytest.raises(ValueError, match="at least 1"):
        attach(spark, [("a", "x")], [], max_repeats=0)


def jobs_of(spark, build):
    """How many jobs ``build`` starts."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "counted")
    try:
        build()
        return len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def failing(spark, columns):
    """Rows that fail any job that reads them."""
    return spark.range(1).select(*[F.raise_error(F.lit("read")).cast(kind).alias(name) for name, kind in columns])


def test_building_reads_no_children(spark):
    kids = Children(failing(spark, [("k", "string"), ("c", "string"), ("v", "long")]), "kids", FIELDS, totals())
    parents = parents_of(spark, [("a", "x")] * 3)
    for repeats in (None, find_repeats(parents, "k", 1)):
        built = attach_children(parents, "k", [kids], repeats=repeats)
        with pytest.raises(Exception, match="read"):
            built.collect()
    assert jobs_of(spark, lambda: attach_children(parents, "k", [kids], repeats=Repeats())) == 0


def test_a_plain_build_leaves_no_files(spark, checkpoint_dir):
    before = set(os.listdir(checkpoint_dir))
    attach(spark, [("a", "x")], [("a", "1", 1)]).collect()
    assert set(os.listdir(checkpoint_dir)) == before
    find_repeats(spark.range(3).selectExpr("1 AS k"), "k", 1)
    assert any(name.startswith("repeats-") for name in set(os.listdir(checkpoint_dir)) - before)


def session(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)),
        sparkContext=SimpleNamespace(master=master),
    )


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host"])
def test_a_cluster_must_name_its_scratch_dir(master):
    for warehouse in ("file:/home/x", "/home/x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_dir(session(master, **{"spark.sql.warehouse.dir": warehouse}))
    assert scratch_dir(session(master, **{"spark.sql.warehouse.dir": "hdfs://n/w/"})) == "hdfs://n/w"
    assert scratch_dir(session(master, **{"spark.checkpoint.dir": "file:/shared"})) == "file:/shared"
    assert scratch_dir(session(master), "s3://bucket/x/") == "s3://bucket/x"


def test_a_local_session_may_use_its_warehouse():
    assert scratch_dir(session("local[4]", **{"spark.sql.warehouse.dir": "file:/home/x"})) == "file:/home/x"


def test_scratch_dir_follows_the_session(spark, checkpoint_dir):
    assert scratch_dir(spark) == checkpoint_dir


def test_a_run_leaves_no_scratch_behind(spark, checkpoint_dir):
    before = set(os.listdir(checkpoint_dir))
    with scratch_run(spark) as folder:
        inner = staged(spark.range(3), "inner")
        assert os.path.dirname(inner.inputFiles()[0].removeprefix("file://")).startswith(folder) and inner.count() == 3
        kept = staged(inner, "kept", checkpoint_dir)
    assert [name.split("-")[0] for name in set(os.listdir(checkpoint_dir)) - before] == ["kept"] and kept.count() == 3
    with pytest.raises(ZeroDivisionError), scratch_run(spark) as folder:
        staged(spark.range(1), "lost")
        raise ZeroDivisionError
    assert not os.path.exists(folder)
    assert staged(spark.range(1), "after").inputFiles()[0].removeprefix("file://").startswith(f"{checkpoint_dir}/after-")
