import numpy as np
import pytest

from dossier.llm import whitening
from dossier.llm.queries import op13_whitening
from dossier.llm.whitening import count_above, solve_slice, whiten

SCHEMA = "vec_id bigint, embedding array<float>"


def exact(vectors, most=32):
    """Whole numbers, deviations by Python's own integers, and the components by a dense solver."""
    x = np.floor(64 * np.asarray(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    y = (x - sums // n) - (sums % n) / n
    values, found = np.linalg.eigh(y.T @ y / n)
    values, found = values[::-1][:most], found[:, ::-1][:, :most]
    kept = values > 1e-12 * np.trace(y.T @ y / n)
    return n, deviation, y, values[kept], found[:, kept], np.trace(y.T @ y / n)


def check(rows, keys, vectors, most=32, distinct=True):
    n, deviation, y, values, found, trace = exact(vectors, most)
    assert len(rows) == n * len(values)
    w, of = np.zeros((n, len(values))), {k: i for i, k in enumerate(keys)}
    for r in rows:
        i = of[r.vec_id]
        w[i, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == (deviation[i] if deviation[i] < 1 << 63 else None)
        assert abs(r.explained - values[r.component - 1] / trace) <= 1e-10
        assert 0 <= r.identity_error < 1e-6
    assert len({r.identity_error for r in rows}) <= 1
    assert np.abs(w.T @ w / n - np.eye(len(values))).max() < 1e-6
    if distinct:
        wanted = y @ found / np.sqrt(values)
        sign = np.sign((w * wanted).sum(0))
        assert np.abs(w * sign - wanted).max() < 1e-6
    return w


def table(spark, keys, vectors):
    return spark.createDataFrame([(k, [float(x) for x in v]) for k, v in zip(keys, vectors, strict=True)], SCHEMA)


@pytest.mark.parametrize("length, n", [(1, 30), (3, 40), (40, 300), (64, 200)])
def test_against_a_dense_solver(spark, length, n):
    rnd = np.random.default_rng(length)
    vectors = rnd.normal(size=(n, length)) * np.linspace(0.2, 3, length)
    keys = list(range(0, 2 * n, 2))
    check(whiten(table(spark, keys, vectors).repartition(3)).collect(), keys, vectors)


def test_a_wide_spectrum_and_a_near_pair(spark):
    rnd = np.random.default_rng(9)
    vectors = rnd.normal(size=(300, 12)) * np.array([1000, 300, 300.0001, 40, 9, 9, 3, 2, 1, 0.5, 0.3, 0.2])
    check(whiten(table(spark, range(300), vectors)).collect(), range(300), vectors)


def test_equal_eigenvalues(spark):
    """Any orthogonal components of their space will do."""
    vectors = np.concatenate([np.eye(24) * 8, -np.eye(24) * 8])
    check(whiten(table(spark, range(48), vectors)).collect(), range(48), vectors, distinct=False)


def test_fewer_components_than_dimensions(spark):
    rnd = np.random.default_rng(4)
    half = rnd.normal(size=(50, 3)) * 4
    vectors = np.round(np.concatenate([half, half[:, :1], np.full((50, 1), 7.0)], axis=1) * 64) / 64
    rows = whiten(table(spark, range(50), vectors)).collect()
    assert {r.component for r in rows} == {1, 2, 3}
    check(rows, range(50), vectors)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [3.0, -1.0]), (5, [3.0, -1.0]), (None, [0.0, 0.5])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS component", "3 AS at", "4 AS n", "5 AS w")
    got = whiten(df).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((k, c) for k in ("0", "5", "5", "None") for c in (1, 2))
    assert {r.n for r in got} == {4} and all(r.identity_error < 1e-9 for r in got)
    assert len({(r.component, r.whitened, r.deviation) for r in got if r.vec_id == 5}) == 2


def test_no_components(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        none = whiten(spark.createDataFrame(rows, SCHEMA))
        assert none.count() == 0
        assert none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_numbers(spark):
    """Deviations beyond a bigint are null, others exact."""
    vectors = [[1e8, 0.0], [-1e8, 1.0], [0.0, 2.0], [5.0, -3.0]]
    rows = whiten(table(spark, range(4), vectors)).collect()
    _, deviation, *_ = exact(vectors)
    assert {r.vec_id: r.deviation for r in rows} == {i: d if d < 1 << 63 else None for i, d in enumerate(deviation)}
    with pytest.raises(Exception, match="beyond 2"):
        whiten(table(spark, [1, 2], [[1e30], [1.0]]))
    with pytest.raises(ValueError, match="one length"):
        whiten(table(spark, [1, 2], [[1.0], [1.0, 2.0]]))
    with pytest.raises(ValueError, match="longer"):
        whiten(table(spark, [1], [[1.0] * (whitening.MOST_LENGTH + 1)]))


def test_inertia_counts():
    rnd = np.random.default_rng(1)
    for length in (1, 2, 5, 30):
        a = rnd.normal(size=(length, length))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in [*((values[1:] + values[:-1]) / 2), values[0] - 1, values[-1] + 1]:
            assert count_above(a, shift) == (values > shift).sum()
    assert count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert count_above(np.zeros((3, 3)), 0.0) == 0


def test_a_slice_finds_all_it_counts():
    rnd = np.random.default_rng(2)
    basis, _ = np.linalg.qr(rnd.normal(size=(40, 40)))
    values = np.concatenate([np.full(12, 5.0), np.linspace(6, 9, 28)])
    v = basis * values @ basis.T
    found, vectors = solve_slice(v, 4.5, 6.05, 13, values.sum())
    assert np.allclose(np.sort(found), values[:13], atol=1e-10)
    assert np.abs(v @ vectors - vectors * found).max() < 1e-9
    with pytest.raises(RuntimeError, match="of 14"):
        solve_slice(v, 4.5, 6.05, 14, values.sum())


def test_query_against_a_dense_solver(spark):
    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    check(op13_whitening(spark, sf).collect(), [r.vec_id for r in given], [r.embedding for r in given])
