"""Whitening of vectors by their leading principal components, found by contour integration (FEAST).

A component ``c`` counts as the whole number ``floor(64 * c) + 1000000``. Sums and the
centred covariance are added up by tasks over all rows; what reaches the driver are
matrices of the vectors' length squared, whatever the number of rows.

The spectrum of the covariance V is cut into slices by inertia counts: the number of
eigenvalues above a shift is the number of positive pivots of a symmetric factorization
of V minus the shift (Sylvester). Shifts of one round are counted by as many tasks, and
slices with too many eigenvalues are cut again. Then each slice is a task of its own:
the integral of the resolvent along a circle around the slice, by Gauss-Legendre
quadrature, each node a complex shifted solve, takes a few random vectors to the
slice's eigenspace; Rayleigh-Ritz draws out the components; this is repeated until
their residuals are at rounding level. A slice that finds fewer components than its
inertia counts say starts again with more vectors, and fails in the end. At last one
Rayleigh-Ritz step over the components of all slices makes them orthogonal to each
other, and their number is held against the inertia count of the whole range.

Defined results: a vector that is null, or holds a null or a number that is not
finite, has no row; equal rows have equal results; directions without variance (an
eigenvalue of at most 1e-12 of the trace) cannot be whitened and are no components, so
that one row alone, or only equal rows, give no rows, nor does an empty table; equal
eigenvalues have any orthogonal components of their space; ``deviation`` is null where it
is beyond a bigint. Vectors of different lengths, longer than 2,048, or with numbers
beyond 2^52 when scaled are errors. Other columns are not used.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.vectors import finite_vectors, matrix, vector_length

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32

# Matrices of this length squared fit the driver and every worker.
MOST_LENGTH = 2048
# Quadrature nodes on the half circle, vectors besides those wanted, rounds of integration and starts.
NODES, SPARE, ROUNDS, STARTS = 8, 6, 30, 4
# Eigenvalues of a slice; into how many pieces a fuller one is cut at once, and how often.
SLICE, PIECES, CUTS = 8, 8, 14
# Of the trace: eigenvalues that are none, and residuals that are small enough.
ZERO, SMALL = 1e-12, 1e-12

_BIGINT = (1 << 63) - 1


class Moments(NamedTuple):
    """How many vectors, their sums by dimension (exact), and their covariance."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    scaled = np.floor(SCALE * vectors)
    if np.abs(scaled).max(initial=0) >= 1 << 52:
        raise ValueError("numbers beyond 2^52 when scaled")
    return scaled.astype(np.int64) + SHIFT


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - sums / n``, its whole part subtracted exactly."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def _added_up(rows: DataFrame, length: int, size: int, of, kind: str = "double") -> np.ndarray:
    """The sum over all rows of arrays of ``size`` numbers that ``of`` makes of a batch, partly added up by each task.

    ``size`` is bounded by the vectors' length squared, whatever the rows.
    """

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            if batch.num_rows:
                total = total + of(matrix(batch.column(0), length))
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["at", "x"])

    parts = rows.select("vector").mapInArrow(added, f"at int, x {kind}")
    table = parts.groupBy("at").agg(F.sum("x").alias("x")).toArrow()  # ``size`` rows
    total = np.zeros(size, np.int64 if kind == "bigint" else np.float64)
    total[table.column("at").to_numpy()] = table.column("x").to_numpy()
    return total


def _square(flat: np.ndarray, length: int) -> np.ndarray:
    """A symmetric matrix of its upper half."""
    full = np.zeros((length, length))
    full[np.triu_indices(length)] = flat
    return full + np.triu(full, 1).T


def moments(rows: DataFrame, length: int) -> Moments:
    def sums(vectors):
        x = whole_numbers(vectors)
        return np.append(x.sum(0), len(x))

    *total, n = _added_up(rows, length, length + 1, sums, "bigint").tolist()
    total = np.array(total, np.int64)
    half = np.triu_indices(length)

    def products(vectors):
        y = centred(whole_numbers(vectors), n, total)
        return (y.T @ y)[half]

    return Moments(n, total, _square(_added_up(rows, length, len(half[0]), products), length) / n)


def count_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``v`` are above ``shift``: by the pivots of a factorization of ``v - shift``.

    Pivots of one or two rows are taken where they are largest (Bunch and Parlett), which keeps rounding small.
    """
    a = v - shift * np.eye(len(v))
    positive = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        r = int(np.argmax(diagonal))
        off = np.abs(np.triu(a, 1))
        i, j = divmod(int(np.argmax(off)), len(a))
        if diagonal[r] >= 0.64 * off[i, j]:
            pivot, rest = a[r, r], np.delete(np.arange(len(a)), r)
            if pivot == 0:
                break  # nothing is left but zeros
            positive += pivot > 0
            column = a[rest, r]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / pivot)
        else:
            positive += 1  # such a pair has one positive and one negative pivot
            pair, rest = [i, j], np.delete(np.arange(len(a)), [i, j])
            columns = a[np.ix_(rest, pair)]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(a[np.ix_(pair, pair)], columns.T)
        a = (a + a.T) / 2
    return int(positive)


class Slice(NamedTuple):
    """An interval of the spectrum, open above, and how many eigenvalues it has."""

    low: float
    high: float
    count: int


def solve_slice(v: np.ndarray, low: float, high: float, count: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues of ``v`` in a slice and their components, as columns."""
    length = len(v)
    middle, radius = (low + high) / 2, max((high - low) / 2, 1e-9 * scale)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    around = radius * np.exp(1j * np.pi / 2 * (nodes + 1))
    # Those near the circle are only damped by the integral, and so need vectors of their own.
    near = count_above(v, middle - 1.5 * radius) - count_above(v, middle + 1.5 * radius)
    size = min(length, max(count, near) + SPARE)
    edge = 1e-11 * scale
    for start in range(STARTS):
        y = np.random.default_rng(start).standard_normal((length, size))
        for _ in range(ROUNDS):
            q = sum(
                w / 2 * (z * np.linalg.solve((middle + z) * np.eye(length) - v, y.astype(complex))).real
                for z, w in zip(around, weights, strict=True)
            )
            q, triangle = np.linalg.qr(q)
            # A direction that the integral took to nothing is none of the slice's.
            q = q[:, np.abs(np.diag(triangle)) > 1e-13 * np.abs(triangle).max()]
            values, turned = np.linalg.eigh(q.T @ v @ q)
            y = q @ turned
            inside = (values > low - edge) & (values <= high + edge)
            residual = np.linalg.norm(v @ y - y * values, axis=0)
            done = inside & (residual <= SMALL * scale)
            if done.sum() >= count:
                return values[done], y[:, done]
        size = min(length, 2 * size)
    raise RuntimeError(f"{int(done.sum())} of {count} components found between {low} and {high}")


def _over_tasks(spark: SparkSession, jobs: list[tuple], of, schema: str) -> list:
    """The rows that ``of`` makes of each of ``jobs``, one task for each; both are few."""
    given = spark.createDataFrame(list(enumerate(jobs)), "at bigint, job array<double>").repartition(len(jobs), "at")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [column.split()[0] for column in schema.split(", ")]
        for batch in batches:
            for at, job in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = [(at, *row) for row in of(*job)]
                if rows:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows, strict=True))), names)

    return given.mapInArrow(made, schema).collect()


def slices(spark: SparkSession, shared, wanted: int, low: float, high: float) -> list[Slice]:
    """Slices of the spectrum from ``high`` down that hold at least ``wanted`` eigenvalues, or all above ``low``."""

    def counts(shifts: list[float]) -> list[int]:
        found = _over_tasks(
            spark, [(x,) for x in shifts], lambda x: [(count_above(shared.value, x),)], "at bigint, above bigint"
        )
        return [above for _, above in sorted(map(tuple, found))]

    above = {high: 0, low: counts([low])[0]}
    wanted = min(wanted, above[low])
    for _ in range(CUTS):
        edges = sorted(above, reverse=True)
        # Slices beyond the wanted number need no cut.
        full = [(b, a) for a, b in zip(edges, edges[1:], strict=False) if above[b] - above[a] > SLICE and above[a] < wanted]
        cuts = [b + (a - b) * k / PIECES for b, a in full for k in range(1, PIECES) if b < b + (a - b) * k / PIECES < a]
        if not cuts:
            break
        above.update(zip(cuts, counts(cuts), strict=True))
    edges = sorted(above, reverse=True)
    pieces = zip(edges, edges[1:], strict=False)
    return [Slice(b, a, above[b] - above[a]) for a, b in pieces if above[b] > above[a] and above[a] < wanted]


class Components(NamedTuple):
    """Eigenvalues, falling, and their unit eigenvectors as columns."""

    values: np.ndarray
    vectors: np.ndarray


def components(spark: SparkSession, v: np.ndarray, most: int) -> Components:
    """The ``most`` leading components of a covariance, fewer if it has fewer."""
    scale = float(np.trace(v))
    if scale <= 0:
        return Components(np.zeros(0), np.zeros((len(v), 0)))
    low, high = ZERO * scale, scale * (1 + 1e-9)
    shared = spark.sparkContext.broadcast(v)
    parts = slices(spark, shared, most, low, high)

    def solved(*job):
        values, found = solve_slice(shared.value, job[0], job[1], int(job[2]), scale)
        return [(float(x), y.tolist()) for x, y in zip(values, found.T, strict=True)]

    rows = _over_tasks(spark, [tuple(map(float, p)) for p in parts], solved, "at bigint, value double, vector array<double>")
    # At most as many rows as the slices have eigenvalues. One found by two slices, at their common edge, counts once.
    basis, lengths, _ = np.linalg.svd(np.array([row.vector for row in rows]).T, full_matrices=False)
    basis = basis[:, lengths > 1e-6]
    values, turned = np.linalg.eigh(basis.T @ v @ basis)
    values, turned = values[values > low], turned[:, values > low]
    counted, bottom = sum(p.count for p in parts), min(p.low for p in parts)
    edge = 1e-10 * scale
    sure, possible = count_above(v, bottom + edge), count_above(v, bottom - edge)
    if not min(sure, counted) <= len(values) <= max(possible, counted):
        raise RuntimeError(f"{len(values)} components found where inertia counts {sure} to {possible}")
    order = np.argsort(-values)[:most]
    return Components(values[order], basis @ turned[:, order])


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum over dimensions of ``(n * x - sums)`` squared, exactly; None beyond a bigint."""
    most = int(np.abs(x).max(initial=0)) * n + int(np.abs(sums).max(initial=0))
    if most * most * x.shape[1] <= _BIGINT:
        return ((n * x - sums) ** 2).sum(1).tolist()
    if most <= _BIGINT:
        apart = n * x - sums
        if int(np.abs(apart).max()) ** 2 * x.shape[1] <= _BIGINT:
            return (apart**2).sum(1).tolist()
    apart = n * x.astype(object) - sums.astype(object)
    return [d if d <= _BIGINT else None for d in (apart**2).sum(1).tolist()]


class Whitening(NamedTuple):
    """What turns vectors into uncorrelated numbers of variance one."""

    n: int
    sums: np.ndarray
    found: Components
    trace: float

    def of(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ (self.found.vectors / np.sqrt(self.found.values))


def fit_whitening(rows: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """The whitening of all rows of ``vector``; None without any component."""
    length = vector_length(rows, "vector")
    if not length:
        return None
    if length > MOST_LENGTH:
        raise ValueError(f"vectors of {length} components are longer than {MOST_LENGTH}")
    fit = moments(rows, length)
    found = components(rows.sparkSession, fit.covariance, most)
    if not len(found.values):
        return None
    return Whitening(fit.n, fit.sums, found, float(np.trace(fit.covariance)))


def identity_error(rows: DataFrame, shared) -> float:
    """The largest entry, without its sign, of the whitened rows' covariance minus the identity."""
    fitted = shared.value
    size = len(fitted.found.values)
    half = np.triu_indices(size)

    def products(vectors):
        w = shared.value.of(whole_numbers(vectors))
        return np.append((w.T @ w)[half], w.sum(0))

    flat = _added_up(rows, len(fitted.sums), len(half[0]) + size, products)
    mean = flat[len(half[0]) :] / fitted.n
    covariance = _square(flat[: len(half[0])], size) / fitted.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(size)).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row for each whole vector and component: see ``op13_whitening`` for the columns."""
    named = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    rows = finite_vectors(named, "vector")
    spark = vectors.sparkSession
    fitted = fit_whitening(rows, most)
    kinds = {
        "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double",
        "identity_error": "double",
    }
    if fitted is None:
        return vectors.where(F.lit(False)).select(key, *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()])
    shared = spark.sparkContext.broadcast(fitted)
    error = identity_error(rows, shared)
    length, size = len(fitted.sums), len(fitted.found.values)

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            x = whole_numbers(matrix(batch.column(1), length))
            flat = pa.array(own.of(x).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * size, pa.int32()), flat)
            apart = pa.array(deviations(x, own.n, own.sums), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), apart, lists], ["key", "deviation", "whitened"])

    schema = f"key {rows.schema['key'].dataType.simpleString()}, deviation bigint, whitened array<double>"
    done = rows.select("key", "vector").mapInArrow(whitened, schema)
    shares = F.array(*[F.lit(float(x)) for x in fitted.found.values / fitted.trace])
    return done.select("key", "deviation", F.posexplode("whitened").alias("at", "w")).select(
        F.col("key").alias(key),
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n).cast("bigint").alias("n"),
        "deviation",
        F.col("w").alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
