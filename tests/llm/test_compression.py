import hashlib

import duckdb
import numpy as np
import pytest

from dossier.llm import compression
from dossier.llm.compression import anchors, compress_vectors, grow_tree, owners
from dossier.llm.queries import ORACLE, op12_vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows):
    """By key: code and error; and the books. Every point against every entry, in whole numbers of any size."""
    whole = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([[int(np.floor(4096 * np.float64(np.float32(c)))) for c in r[1]] for r in whole], object)
    x = x.reshape(len(whole), 8, -1)
    books = [x[:16, p] for p in range(8)]
    for step in range(7):
        chosen = []
        for p in range(8):
            d = ((x[:, p][:, None] - books[p][None]) ** 2).sum(2)
            chosen.append([min(range(len(books[p])), key=lambda e: (row[e], e)) for row in d])
            if step < 6:
                new = books[p].copy()
                for e in set(chosen[p]):
                    own = x[:, p][[i for i, c in enumerate(chosen[p]) if c == e]]
                    new[e] = [s // len(own) for s in own.sum(0)]
                books[p] = new
    found = []
    for i, row in enumerate(whole):
        error = sum(((x[i, p] - books[p][chosen[p][i]]) ** 2).sum() for p in range(8))
        found.append((row[0], "".join(f"{chosen[p][i]:02x}" for p in range(8)), int(error), row[2]))
    digits = ",".join(str(c) for p in range(8) for e in books[p] for c in e)
    return found, hashlib.sha256(digits.encode()).hexdigest()


def check(spark, rows, df=None):
    found, digest = brute(rows)
    errors = {}
    for _, _, error, label in found:
        errors[label] = errors.get(label, 0) + error
    wanted = [(key, code, error, errors[label], digest) for key, code, error, label in found]
    df = spark.createDataFrame(rows, SCHEMA) if df is None else df
    got = [tuple(r) for r in compress_vectors(df).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def clustered(rnd, n, length, scale=1.0):
    centres = rnd.normal(size=(20, length))
    return (centres[rnd.integers(0, 20, n)] + 0.1 * rnd.normal(size=(n, length))) * scale


@pytest.mark.parametrize("chunk, leaf", [(4096, 32), (50, 3), (7, 1)])
def test_against_brute_force(spark, monkeypatch, chunk, leaf):
    monkeypatch.setattr(compression, "CHUNK", chunk)
    monkeypatch.setattr(compression, "LEAF", leaf)
    rnd = np.random.default_rng(chunk)
    vectors = clustered(rnd, 400, 16).astype(np.float32).tolist()
    rows = [(i, v, int(rnd.integers(0, 4)) or None) for i, v in enumerate(vectors)]
    check(spark, rows, spark.createDataFrame(rows, SCHEMA).repartition(5))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 3)] * 8, None) for i in range(20)]
    rows += [(100, None, 1), (101, [nan] + [0.0] * 7, 1), (102, [inf] + [0.0] * 7, 1), (103, [None] + [0.0] * 7, 1)]
    rows += [(None, [-0.5] * 8, 2), (7, [9.0] * 8, 2), (7, [9.0] * 8, 2), (200, [-1e4, 1e4] * 4, 3), (201, [0.0001] * 8, 3)]
    check(spark, rows)


def test_ties_go_to_the_lower_entry(spark):
    rows = [(i, [float(x) for x in [i, -i] * 8], i % 2) for i in range(16)]
    rows += [(100 + i, [i + 0.5, -i - 0.5] * 8, 0) for i in range(40)]
    check(spark, rows)


def test_fewer_rows_than_entries_and_copies(spark):
    check(spark, [(5, [0.25] * 16, 1), (3, [0.5] * 16, 1), (4, [0.5] * 16, None)])
    check(spark, [(i, [0.25] * 8, 1) for i in range(300)] + [(1000, [3.0] * 8, 1)])


def test_empty_table_and_clashing_columns(spark):
    none = compress_vectors(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    rows = [(i, [float(i)] * 8, 1) for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS code", "3 AS error", "4 AS of", "5 AS balls")
    check(spark, rows, df)


@pytest.mark.parametrize("vectors, message", [([[1.0] * 8, [1.0] * 16], "one length"), ([[1.0] * 9], "equal parts"), ([[]], "equal parts")])
def test_lengths_that_cannot_be_cut(spark, vectors, message):
    with pytest.raises(ValueError, match=message):
        compress_vectors(spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], SCHEMA))


def test_numbers_beyond_a_bigint(spark):
    with pytest.raises(ValueError, match="too large"):
        compress_vectors(spark.createDataFrame([(0, [1e30] * 8, 1)], SCHEMA))


def test_anchors_are_nearest():
    points = clustered(np.random.default_rng(0), 300, 4)
    groups = anchors(points, 17)
    assert sorted(np.concatenate(groups)) == list(range(300)) and len(groups) == 17
    assert len(anchors(np.ones((9, 2)), 3)) == 1


def test_balls_hold_their_points_and_sums():
    rnd = np.random.default_rng(2)
    points = (clustered(rnd, 1000, 8) * 4096).astype(np.int64)
    tree = grow_tree(points)
    assert sorted(tree.order) == list(range(1000)) and (points[tree.order] == tree.points).all()
    for a, n, total, radius, left, right in zip(tree.starts, tree.counts, tree.sums, tree.radii, tree.lefts, tree.rights, strict=True):
        own = tree.points[a : a + n].astype(np.int64)
        assert (own.sum(0) == total).all()
        assert np.linalg.norm(own - total / n, axis=1).max() <= radius + 1e-6
        if left >= 0:
            assert tree.counts[left] + tree.counts[right] == n


def test_most_points_are_owned_by_balls():
    rnd = np.random.default_rng(3)
    points = (clustered(rnd, 4000, 8, 10) * 4096).astype(np.int64)
    found = owners(grow_tree(points), points[:16])
    assert len(found.places) < 2000
    tree, entry = grow_tree(points), np.empty(4000, int)
    for ball, e in zip(found.balls, found.ball_entry, strict=True):
        entry[tree.starts[ball] : tree.starts[ball] + tree.counts[ball]] = e
    entry[found.places] = found.place_entry
    exact = ((tree.points[:, None].astype(np.int64) - points[None, :16]) ** 2).sum(2).argmin(1)
    assert (entry == exact).all()


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    wanted = con.execute(ORACLE["op12_vector_codes"])
    names = [c[0] for c in wanted.description]
    assert sorted(tuple(r) for r in op12_vector_codes(spark, sf).select(names).collect()) == sorted(wanted.fetchall())
