"""Near-duplicate documents by SimHash fingerprints that differ in few bits.

Fingerprints are 64 bits, of shingles of words. Equal ones are one node. Cut into
``radius + 2`` blocks, two fingerprints within ``radius`` bits agree in at least
two blocks; so for every two blocks, fingerprints that agree in both form a
shard. The shard is indexed by a BK-tree, whose children are keyed by their
distance to the parent; a search follows only edges within ``radius`` of its own
distance. Links are joined into components.

Defined results: a null or empty text has fingerprint zero, which links like any
other; a null id belongs to its component but never names it; a component whose
ids are all null has a null name; repeated rows have equal fingerprints and so one
component; an empty table gives no rows.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.llm import bloom
from dossier.llm.components import components
from dossier.llm.words import LOWER, slices, words_of
from dossier.operators.staging import staged

# The contract's shingle length, seed and distance.
SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64

# A tree holds at most so many fingerprints; larger shards are several trees, each
# searched for all fingerprints of the shard.
TREE_SIZE = 4096
_VOTES = 1 << 14


def _shingle_hashes(text: bytes, starts: list[int], ends: list[int], length: int) -> list[int]:
    """XXH64 of each run of ``length`` words joined by spaces; of all words if they are fewer."""
    if not starts:
        return []
    digest = xxhash.xxh64_intdigest
    length = min(length, len(starts))
    spaces = text.count(b" ", starts[0], ends[-1])
    if spaces != len(starts) - 1 or any(a + 1 != b for a, b in zip(ends, starts[1:], strict=False)):
        # Not single spaces between all words: hash a copy that has them.
        words = [text[a:b] for a, b in zip(starts, ends, strict=True)]
        text = b" ".join(words)
        ends = (np.cumsum([len(x) + 1 for x in words]) - 1).tolist()
        starts = [0, *(x + 1 for x in ends[:-1])]
    return [digest(text[a:b], SEED) for a, b in zip(starts, ends[length - 1 :], strict=False)]


def _majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    votes = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), _VOTES):
        some = hashes[k : k + _VOTES].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text, as a bigint of the same 64 bits."""

    def of_all(texts: pa.Array) -> pa.Array:
        found = np.zeros(len(texts), np.uint64)
        for part in slices(texts):
            lowered = LOWER[part.data]
            words = words_of(part)
            cuts = np.searchsorted(words.row, np.arange(part.rows + 1)).tolist()
            text, starts, ends = lowered.tobytes(), words.starts.tolist(), words.ends.tolist()
            for i in range(part.rows):
                own = slice(cuts[i], cuts[i + 1])
                hashes = _shingle_hashes(text, starts[own], ends[own], shingle)
                if hashes:
                    found[part.first + i] = _majority(np.array(hashes, np.uint64))
        return pa.array(found.view(np.int64))

    return F.arrow_udf(of_all, "bigint")(text)


class BkTree:
    """Fingerprints by Hamming distance: a node's children are keyed by their distance to it."""

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        node = (value, {})
        if self.root is None:
            self.root = node
            return
        at = self.root
        while True:
            distance = (at[0] ^ value).bit_count()
            if distance not in at[1]:
                at[1][distance] = node
                return
            at = at[1][distance]

    def near(self, value: int, radius: int) -> list[int]:
        """All values within ``radius`` bits of ``value``."""
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            node, children = open_nodes.pop()
            distance = (node ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            if children:
                for key, child in children.items():
                    if distance - radius <= key <= distance + radius:
                        open_nodes.append(child)
        return found


class _Roots:
    """Which values are joined already, by union and find."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.above.get(x, x)) != x:
            self.above[x] = self.above.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.above[max(x, y)] = min(x, y)
        return x != y


def spanning_links(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links within ``radius`` among distinct values, as many as join what all such links join."""
    tree, roots = BkTree(), _Roots()
    for value in values:
        for other in tree.near(value, radius):
            if roots.join(value, other):
                yield value, other
        tree.add(value)


def _masks(radius: int) -> list[int]:
    """For every two of ``radius + 2`` blocks, their bits, as signed numbers."""
    edges = [round(i * BITS / (radius + 2)) for i in range(radius + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [a | b for a, b in combinations(blocks, 2)]
    return [x - (1 << BITS) if x >> (BITS - 1) else x for x in masks]


_LINK = "a bigint, b bigint, mask int, shard bigint"
_LINK_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("mask", pa.int32()), ("shard", pa.int64())])


def _signed(values: list[int]) -> list[int]:
    return [x - (1 << BITS) if x >> (BITS - 1) else x for x in values]


def _batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _LINK_SCHEMA, strict=True)], schema=_LINK_SCHEMA
    )


def _search_shards(radius: int, tree_size: int):
    """Over rows of mask, shard and fingerprint, sorted by the first two: links within each shard.

    The rows of a shard of more than ``tree_size`` fingerprints are handed on as
    they are, in ``a``, with their mask and shard.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, large = None, [], False

        def closed():
            if large or len(held) < 2:
                return _batch([[], [], [], []])
            links = list(spanning_links(held, radius))
            none = [None] * len(links)
            return _batch([_signed([x for x, _ in links]), _signed([y for _, y in links]), none, none])

        for batch in batches:
            mask, shard, value = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (shard[1:] != shard[:-1])) + 1
            cuts = np.concatenate([[0], cuts, [len(mask)]])
            # Shards of one row have no links; only those at the ends of a batch may go on in the next.
            some = np.flatnonzero((np.diff(cuts) > 1) | (cuts[:-1] == 0) | (cuts[1:] == len(mask)))
            for a, b in zip(cuts[some].tolist(), cuts[some + 1].tolist(), strict=True):
                found = (int(mask[a]), int(shard[a]))
                if found != key:
                    yield closed()
                    key, held, large = found, [], False
                held += value[a:b].view(np.uint64).tolist()
                if large or len(held) > tree_size:
                    n = len(held)
                    yield _batch([_signed(held), [None] * n, [key[0]] * n, [key[1]] * n])
                    held, large = [], True
        yield closed()

    return search


def _search_tiles(radius: int):
    """Over rows of mask, shard, tile, whether not of this tile, and fingerprint, sorted: links.

    The fingerprints of a tile come first and make its tree; then all others of the
    shard are searched for, one link for each component of the tile that they meet.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree, roots = None, BkTree(), _Roots()
        for batch in batches:
            links = []
            for *found, other, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if found != key:
                    key, tree, roots = found, BkTree(), _Roots()
                value &= (1 << BITS) - 1
                near = tree.near(value, radius)
                if other:
                    links += [(value, x) for x in {roots.root(x): x for x in near}.values()]
                else:
                    links += [(value, x) for x in near if roots.join(value, x)]
                    tree.add(value)
            none = [None] * len(links)
            yield _batch([_signed([x for x, _ in links]), _signed([y for _, y in links]), none, none])

    return search


def near_links(values: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """``a``, ``b``: links that join all of the distinct ``fp`` in ``values`` that are within ``radius`` bits."""
    shards = F.array(
        *[
            F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("shard"))
            for i, m in enumerate(_masks(radius))
        ]
    )
    dealt = (
        values.select("fp", F.explode(shards).alias("s"))
        .select("s.mask", "s.shard", "fp")
        .repartition("mask", "shard")
        .sortWithinPartitions("mask", "shard")
    )
    found = staged(dealt.mapInArrow(_search_shards(radius, tree_size), _LINK), "simhash-links")
    links = found.where("mask IS NULL").select("a", "b")
    large = found.where("mask IS NOT NULL").select("mask", "shard", F.col("a").alias("fp"))
    # Counted, then dealt to tiles: no task holds a large shard.
    tiles = large.groupBy("mask", "shard").agg(F.ceil(F.count(F.lit(1)) / tree_size).cast("int").alias("tiles"))
    tiled = (
        large.join(tiles, ["mask", "shard"])
        .withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
        .withColumn("tile", F.explode(F.sequence(F.col("_own"), F.col("tiles") - 1)))
        .select("mask", "shard", "tile", (F.col("tile") != F.col("_own")).alias("other"), "fp")
        .repartition("mask", "shard", "tile")
        .sortWithinPartitions("mask", "shard", "tile", "other")
    )
    if large.isEmpty():
        return links
    return links.unionByName(tiled.mapInArrow(_search_tiles(radius), _LINK).select("a", "b"))


def _named(marked: DataFrame, key: str, radius: int, tree_size: int) -> DataFrame:
    """``fp``, ``root`` and ``component_id`` for each distinct fingerprint of ``marked`` (``key``, ``fp``)."""
    nodes = staged(marked.groupBy("fp").agg(F.min(key).alias("least")), "simhash-nodes")
    joined = components(near_links(nodes, radius, tree_size), "simhash-components")
    joined = joined.select(F.col("node").alias("fp"), "root")
    names = joined.join(nodes, "fp").groupBy("root").agg(F.min("least").alias("name"))
    linked = joined.join(names, "root")
    return staged(
        nodes.join(linked, "fp", "left").select(
            "fp",
            F.coalesce("root", "fp").alias("root"),
            F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("name")).alias("component_id"),
        ),
        "simhash-named",
    )


def _marked(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    return staged(docs.select(key, fingerprints(F.col(text), shingle).alias("fp")), "simhash-fingerprints")


def simhash_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    tree_size: int = TREE_SIZE,
) -> DataFrame:
    """One row for each document: ``key``, ``fingerprint`` in hexadecimal, ``component_id``."""
    marked = _marked(docs, key, text, shingle)
    named = _named(marked, key, radius, tree_size)
    return marked.join(named, "fp").select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    tree_size: int = TREE_SIZE,
) -> DataFrame:
    """Of each component the document with the smallest id, with the columns of ``docs``.

    Ids found once are told by id alone. Rows that share their id, or have none,
    are told by fingerprint too, and one of each component is kept.
    """
    marked = _marked(docs, key, text, shingle)
    named = _named(marked, key, radius, tree_size)
    first = F.col(key).eqNullSafe(F.col("component_id")).cast("int")
    by_id = marked.join(named, "fp").where(F.col(key).isNotNull()).groupBy(key)
    told = by_id.agg(F.count(F.lit(1)).alias("_rows"), F.sum(first).alias("_first"))
    others = staged(told.where("_rows > 1 OR _first = 0"), "simhash-others")
    # Documents are shuffled only where their id may be among the others, which grow with the documents.
    maybe, simple = bloom.told_apart(docs, key, others)
    simple = simple.unionByName(maybe.join(others.hint("merge"), key, "left_anti").select(docs.columns))
    if docs.where(F.col(key).isNull()).isEmpty() and others.where("_first > 0").isEmpty():
        return simple.select(docs.columns)
    shared = docs.join(others.where("_first > 0"), key, "left_semi").select(docs.columns)
    shared = shared.unionByName(docs.where(F.col(key).isNull()))
    shared = shared.withColumn("_fp", fingerprints(F.col(text), shingle))
    roots = named.select(F.col("fp").alias("_fp"), F.col("root").alias("_root"), F.col("component_id").alias("_name"))
    firsts = shared.join(roots, "_fp").where(F.col(key).eqNullSafe(F.col("_name")))
    single = simple.where(F.col(key).isNotNull()).select(docs.columns)
    return single.unionByName(firsts.dropDuplicates(["_root"]).select(docs.columns))
