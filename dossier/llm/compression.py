"""Vector codes: each part of a vector as the number of its nearest codebook entry.

A component ``x`` counts as the whole number ``floor(4096 * x)``. Vectors are cut into
8 equal parts. Each part position has a codebook of 16 entries: first that part of
the 16 rows with the smallest keys, then, in each of 6 rounds, the componentwise
``floor(sum / count)`` of all parts nearest to the entry before (squared Euclidean
distance, ties to the lower number); an entry without parts stays as it is.

The rounds run over metric trees, built once. A task takes its rows by thousands and
grows a tree for each part position, middle-out: about as many anchors as the root of
the number of points, each new one the point farthest from its anchor, stealing the
points nearer to it; anchors' balls are merged from the tightest pair up to the root,
and each anchor grows its own subtree likewise. Each ball keeps the sum and the
number of its points. In a round a ball is handed its parent's list of candidate
entries, which shrinks: an entry goes when every point of the ball is surely nearer to
another. A ball with one candidate left is wholly owned and adds its sum and number
unopened; only the points of leaves with several candidates are looked at singly.
Tests on balls leave a margin for rounding; distances of points are exact. So entries
are the same as if every point had been compared with every entry.

Trees are a written table. A round sends the driver the sums of 8 x 16 entries and the
workers the codebooks, both of fixed size.

Defined results: a vector that is null, or holds a null or a number that is not
finite, has no row; a null key counts as the largest; rows of one key are in order of
their vectors; with fewer than 16 rows there are as many entries; repeated rows are
coded each by itself; equal labels, the null one too, have one ``label_error``; an empty
table gives no rows. Vectors of different lengths, of a length that 8 does not divide,
or with components whose squared distances are beyond a bigint are errors. Other columns are not used.
"""

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from dossier.llm.vectors import finite_vectors, matrix, vector_length
from dossier.operators.staging import staged

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

# Layout only: rows of one set of trees, and points of a ball that is not split.
CHUNK = 4096
LEAF = 32


class Tree(NamedTuple):
    """Balls over points: ``order`` are the rows in the order of leaves, a ball has ``counts`` of them from ``starts`` on.

    ``lefts`` and ``rights`` are its halves, -1 for a leaf. The last ball is the root.
    """

    points: np.ndarray
    order: np.ndarray
    starts: np.ndarray
    counts: np.ndarray
    lefts: np.ndarray
    rights: np.ndarray
    sums: np.ndarray
    radii: np.ndarray


def _lengths(differences: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", differences, differences))


def anchors(points: np.ndarray, most: int) -> list[np.ndarray]:
    """The points of each of at most ``most`` anchors, by their numbers; every point is with its nearest anchor."""
    far = _lengths(points - points.mean(0))
    centres = [int(np.argmax(far))]
    distance = _lengths(points - points[centres[0]])
    owner = np.zeros(len(points), np.int64)
    while len(centres) < most:
        new = int(np.argmax(distance))  # the farthest of the widest anchor
        if distance[new] == 0:
            break
        half = _lengths(points[centres] - points[new]) / 2
        # A point nearer to its anchor than half the way to the new one cannot be stolen.
        open_points = np.flatnonzero(distance > half[owner])
        to_new = _lengths(points[open_points] - points[new])
        stolen = to_new < distance[open_points]
        owner[open_points[stolen]] = len(centres)
        distance[open_points[stolen]] = to_new[stolen]
        centres.append(new)
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.searchsorted(owner[order], np.arange(1, len(centres))))


def _merged(centres, counts, radii, one: int):
    """The radii of balls around ball ``one`` and each other."""
    weight = (counts / (counts + counts[one]))[:, None]
    middle = centres * weight + centres[one] * (1 - weight)
    return np.maximum(_lengths(centres - middle) + radii, _lengths(centres[one] - middle) + radii[one])


class _Grown:
    """Balls in the making. A ball is (points in order, left, right); halves come before their whole."""

    def __init__(self, points: np.ndarray):
        self.points, self.balls = points, []

    def _add(self, rows: np.ndarray, left: int = -1, right: int = -1) -> int:
        self.balls.append((rows, left, right))
        return len(self.balls) - 1

    def _shape(self, ball: int) -> tuple[np.ndarray, int, float]:
        points = self.points[self.balls[ball][0]]
        centre = points.mean(0)
        return centre, len(points), float(_lengths(points - centre).max())

    def grow(self, rows: np.ndarray) -> int:
        """The ball of some rows, with all balls inside it."""
        if len(rows) <= LEAF:
            return self._add(rows)
        groups = anchors(self.points[rows], int(np.ceil(np.sqrt(len(rows)))))
        if len(groups) == 1:
            return self._add(rows)  # copies of one point
        return self._joined([self.grow(rows[group]) for group in groups])

    def _joined(self, balls: list[int]) -> int:
        """One ball of all: the two that make the smallest ball are merged, again and again."""
        centres, counts, radii = map(np.array, zip(*map(self._shape, balls), strict=True))
        counts = counts.astype(np.float64)
        costs = np.stack([_merged(centres, counts, radii, i) for i in range(len(balls))])
        np.fill_diagonal(costs, np.inf)
        for _ in range(len(balls) - 1):
            a, b = divmod(int(np.argmin(costs)), len(balls))
            rows = np.concatenate([self.balls[balls[a]][0], self.balls[balls[b]][0]])
            balls[a] = self._add(rows, balls[a], balls[b])
            centres[a], counts[a], radii[a] = self._shape(balls[a])
            costs[b], costs[:, b] = np.inf, np.inf
            gone = np.isinf(costs[a])
            costs[a] = np.where(gone, np.inf, _merged(centres, counts, radii, a))
            costs[:, a] = costs[a]
            last = balls[a]
        return last


def grow_tree(points: np.ndarray) -> Tree:
    """The tree over whole-numbered ``points``, at least one."""
    grown = _Grown(points.astype(np.float64))
    root = grown.grow(np.arange(len(points)))
    lefts, rights = (np.array([ball[i] for ball in grown.balls], np.int32) for i in (1, 2))
    counts = np.array([len(ball[0]) for ball in grown.balls], np.int32)
    starts = np.zeros(len(counts), np.int32)
    for i in range(root, -1, -1):  # a whole comes after its halves
        if lefts[i] >= 0:
            starts[lefts[i]], starts[rights[i]] = starts[i], starts[i] + counts[lefts[i]]
    order = grown.balls[root][0].astype(np.int32)
    placed = points[order]
    before = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(placed, 0, dtype=np.int64)])
    sums = before[starts + counts] - before[starts]
    radii = [_lengths(placed[a : a + n] - s / n).max() for a, n, s in zip(starts, counts, sums, strict=True)]
    return Tree(placed.astype(np.int32), order, starts, counts, lefts, rights, sums, np.array(radii))


class Owned(NamedTuple):
    """Who owns what in one round: balls as wholes, and single points by their place in ``order``."""

    balls: np.ndarray
    ball_entry: np.ndarray
    places: np.ndarray
    place_entry: np.ndarray


def owners(tree: Tree, entries: np.ndarray) -> Owned:
    """The nearest of ``entries`` for all points of a tree, most of them by whole balls."""
    squares = (entries.astype(np.float64) ** 2).sum(1)
    apart = np.sqrt(((entries[:, None] - entries[None]).astype(np.float64) ** 2).sum(2))
    twin = np.triu(apart == 0, 1).any(0)  # never nearer than the same entry before it
    frontier = np.array([len(tree.counts) - 1])
    listed = ~twin[None]
    balls, ball_entry, leaves, leaf_lists = [], [], [], []
    while len(frontier):
        centres = tree.sums[frontier] / tree.counts[frontier][:, None]
        scores = np.where(listed, squares - 2 * centres @ entries.T, np.inf)
        best = scores.argmin(1)
        least = scores[np.arange(len(best)), best][:, None]
        margin = 1e-9 * (1 + np.abs(least) + squares[best][:, None] + squares)
        listed = listed & (scores - least <= 2 * tree.radii[frontier][:, None] * apart[best] + margin)
        listed[np.arange(len(best)), best] = True
        whole = listed.sum(1) == 1
        balls.append(frontier[whole])
        ball_entry.append(best[whole])
        leaf = ~whole & (tree.lefts[frontier] < 0)
        leaves.append(frontier[leaf])
        leaf_lists.append(listed[leaf])
        split = ~whole & ~leaf
        frontier, listed = (
            np.concatenate([tree.lefts[frontier[split]], tree.rights[frontier[split]]]),
            np.concatenate([listed[split], listed[split]]),
        )
    leaves, leaf_lists = np.concatenate(leaves), np.concatenate(leaf_lists)
    sizes = tree.counts[leaves]
    places = np.repeat(tree.starts[leaves] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    nearest = _nearest(tree.points[places], entries, np.repeat(leaf_lists, sizes, axis=0))
    return Owned(np.concatenate(balls), np.concatenate(ball_entry), places, nearest)


def _nearest(points: np.ndarray, entries: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """The nearest of each point's candidates, exactly."""
    most = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if 3 * entries.shape[1] * int(most) ** 2 < 1 << 53 else np.int64
    points, entries = points.astype(kind), entries.astype(kind)
    scores = (entries**2).sum(1) - 2 * points @ entries.T
    return np.where(listed, scores, np.inf if kind is np.float64 else np.iinfo(np.int64).max).argmin(1)


# A tree's arrays in a row: those of all part positions one after the other.
_ARRAYS = {name: np.dtype(kind) for name, kind in zip(
    Tree._fields, ("<i4", "<i4", "<i4", "<i4", "<i4", "<i4", "<i8", "<f8"), strict=True)}


def _packed(trees: list[Tree]) -> dict:
    arrays = {
        name: b"".join(np.ascontiguousarray(getattr(t, name), kind).tobytes() for t in trees)
        for name, kind in _ARRAYS.items()
    }
    return {"balls": [len(t.counts) for t in trees], **arrays}


def _unpacked(rows: int, balls: list[int], packed: dict) -> list[Tree]:
    flat = {name: np.frombuffer(packed[name], kind) for name, kind in _ARRAYS.items()}
    cuts = np.concatenate([[0], np.cumsum(balls)])
    width = len(flat["points"]) // (rows * len(balls))
    points = flat["points"].reshape(len(balls), rows, width)
    order = flat["order"].reshape(len(balls), rows)
    sums = flat["sums"].reshape(-1, width)
    found = []
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        own = {name: flat[name][a:b] for name in ("starts", "counts", "lefts", "rights", "radii")}
        found.append(Tree(points=points[i], order=order[i], sums=sums[a:b], **own))
    return found


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    scaled = np.floor(SCALE * vectors)
    most = np.abs(scaled).max(initial=0)
    if 4 * vectors.shape[1] * most**2 >= 1 << 63:
        raise ValueError(f"components up to {most / SCALE:g} are too large: squared errors are beyond a bigint")
    return scaled.astype(np.int64)


class VectorTrees(NamedTuple):
    """The trees of all rows, ``CHUNK`` rows of ``keys`` and ``labels`` in each row of the table, and where codebooks begin."""

    table: DataFrame
    first: np.ndarray  # part position, entry, component


def build_trees(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> VectorTrees | None:
    """Trees over all whole vectors; None without any."""
    named = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    rows = finite_vectors(named, "vector")
    length = vector_length(rows, "vector")
    if length is None:
        return None
    if length == 0 or length % PARTS:
        raise ValueError(f"vectors of {length} components cannot be cut into {PARTS} equal parts")
    least = rows.orderBy(F.col("key").asc_nulls_last(), "vector").select("vector").limit(ENTRIES).collect()
    first = whole_numbers(np.array([row[0] for row in least]))
    width = length // PARTS

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                points = whole_numbers(matrix(part.column(1), length)).reshape(-1, PARTS, width)
                packed = _packed([grow_tree(points[:, i]) for i in range(PARTS)])
                ends = pa.array([0, part.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, part.column(i)) for i in (0, 2)]
                columns = [pa.array([packed["balls"]], pa.list_(pa.int32()))]
                columns += [pa.array([packed[name]], pa.binary()) for name in _ARRAYS]
                yield pa.RecordBatch.from_arrays([*lists, *columns], ["keys", "labels", "balls", *_ARRAYS])

    kinds = [ArrayType(rows.schema["key"].dataType), ArrayType(rows.schema["label"].dataType), ArrayType(IntegerType())]
    schema = StructType([StructField(n, k) for n, k in zip(("keys", "labels", "balls"), kinds, strict=True)])
    for name in _ARRAYS:
        schema = schema.add(name, BinaryType())
    table = staged(rows.select("key", "vector", "label").mapInArrow(grown, schema), "vector-trees")
    return VectorTrees(table, first.reshape(-1, PARTS, width).transpose(1, 0, 2))


_TREE = ["balls", *_ARRAYS]


def _trees(batch: pa.RecordBatch, first: int) -> Iterator[list[Tree]]:
    """The trees of each row of a batch, whose tree columns start at ``first``."""
    for i in range(batch.num_rows):
        balls, *arrays = (batch.column(first + k)[i] for k in range(len(_TREE)))
        packed = {name: value.as_buffer() for name, value in zip(_ARRAYS, arrays, strict=True)}
        rows = len(packed["order"]) // (PARTS * _ARRAYS["order"].itemsize)
        yield _unpacked(rows, balls.as_py(), packed)


def _totals(table: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum and the number of the parts of each entry."""
    shared = table.sparkSession.sparkContext.broadcast(books)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sums, counts = np.zeros(own.shape, np.int64), np.zeros(own.shape[:2], np.int64)
        for batch in batches:
            for trees in _trees(batch, 0):
                for i, tree in enumerate(trees):
                    found = owners(tree, own[i])
                    np.add.at(sums[i], found.ball_entry, tree.sums[found.balls])
                    np.add.at(counts[i], found.ball_entry, tree.counts[found.balls])
                    np.add.at(sums[i], found.place_entry, tree.points[found.places])
                    np.add.at(counts[i], found.place_entry, 1)
        flat = np.concatenate([sums.ravel(), counts.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "n"])

    parts = table.select(_TREE).mapInArrow(added, "at bigint, n bigint")
    total = np.zeros(books.size + books.shape[0] * books.shape[1], np.int64)
    for at, n in parts.groupBy("at").agg(F.sum("n")).collect():  # a row for each number in the codebooks
        total[at] = n
    return total[: books.size].reshape(books.shape), total[books.size :].reshape(books.shape[:2])


def train_codebooks(trees: VectorTrees, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after all rounds: part position, entry, component."""
    books = trees.first
    for _ in range(rounds):
        sums, counts = _totals(trees.table, books)
        means = sums // np.maximum(counts, 1)[..., None]
        books = np.where((counts > 0)[..., None], means, books)
    return books


def encode(trees: VectorTrees, books: np.ndarray) -> DataFrame:
    """``key``, ``label``, ``code`` (two hex digits for each part) and ``error``, the squared distance to what is coded."""
    shared = trees.table.sparkSession.sparkContext.broadcast(books)
    digits = np.array([f"{i:02x}" for i in range(ENTRIES)], "S2")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for row, found in enumerate(_trees(batch, 2)):
                chosen = np.empty((len(found[0].order), PARTS), np.int64)
                error = np.zeros(len(chosen), np.int64)
                for i, tree in enumerate(found):
                    entry = np.empty(len(chosen), np.int64)
                    mine = owners(tree, own[i])
                    for ball, e in zip(mine.balls.tolist(), mine.ball_entry.tolist(), strict=True):
                        entry[tree.starts[ball] : tree.starts[ball] + tree.counts[ball]] = e
                    entry[mine.places] = mine.place_entry
                    chosen[tree.order, i] = entry
                    error[tree.order] += ((tree.points - own[i][entry]) ** 2).sum(1)
                codes = digits[chosen].view(f"S{2 * PARTS}").ravel().astype(str)
                lists = [batch.column(k)[row].values for k in (0, 1)]
                columns = [*lists, pa.array(codes, pa.string()), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "label", "code", "error"])

    kinds = [trees.table.schema[name].dataType.elementType for name in ("keys", "labels")]
    schema = StructType([
        StructField("key", kinds[0]), StructField("label", kinds[1]),
        StructField("code", StringType()), StructField("error", LongType()),
    ])
    return trees.table.mapInArrow(coded, schema)


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``key``, ``code``, ``error``, ``label_error`` (added up over equal labels) and ``codebooks_sha256``.

    Labels have no bounded number, so Spark decides by the size of their written table how to join them.
    """
    trees = build_trees(vectors, key, vector, label)
    if trees is None:
        none = {"code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
        return vectors.where(F.lit(False)).select(key, *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    books = train_codebooks(trees)
    coded = staged(encode(trees, books), "vector-codes")
    errors = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(staged(errors, "vector-errors"), F.col("label").eqNullSafe(F.col("of")))
    return joined.select(
        F.col("key").alias(key), "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
