"""Removing lines that nearly repeat an earlier line, by an exact set-similarity join.

A line's tokens are its runs of five words, each once; a shorter line is one
token. Two lines match if the Jaccard similarity of their tokens is at least 0.8;
the later is removed, later by document id, then by a hash of the document's text,
and then by place in the document.

Tokens are ordered by rarity, as counted over all documents in a table of fixed
size. If two lines match, they share a token among the rarest of each (their
prefixes). So lines meet by prefix token; pairs that differ too much in length,
or whose shared token stands too far back in either, are dropped; the tokens of
the others are compared.

Lines with the same tokens are one class, whose first line stands for all. Where
many classes meet in a token, each is first compared with a few of the earliest
ones. What then follows depends on what is asked for: to remove lines, those that match
none of these are compared with all others that are earlier; for all links between
different lines, all are.

Defined results: a line of one or two words is one token like those of three or
four, and is reported apart; a line without words is no line and is kept; rows
that share their id are told apart by their text, and are one document only if that
is the same; rows without an id come last, as if they shared one; a null text stays null, an empty one empty; an empty table gives no rows; other
columns stay as they are. Tokens are told apart by 56-bit hashes.
"""

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.llm import bloom
from dossier.llm.tables import apart, own, together
from dossier.llm.words import Slice, mixed, slices, windows, word_hashes, words_of
from dossier.operators.staging import staged

TOKEN_WORDS = 5
SIMILARITY = 0.8
# Lines of fewer words are short: reports count them by themselves.
SHORT_WORDS = 3

# The table of token counts; tokens that share an entry count together.
LOG2_ENTRIES = 16
# How many of the earliest classes of a token are at hand for those after them, and how many of these each is paired
# with at first. Both change costs alone: classes that could match others too are paired with all of them later.
EARLIEST = 64
PAIRED = 2
LOG2_FILTER_BITS = 26

# Prefix tokens go to tasks as lists, by buckets of this many tokens. Layout: a task sorts a bucket in memory. One of more
# than ``MOST_IN_BUCKET`` comes in pieces, which leave all of its classes to the second step.
PER_BUCKET = 1 << 16
LEAST_BUCKETS = 1 << 10
MOST_IN_BUCKET = 1 << 22
# How many tokens a task deals into buckets at a time.
DEALT_AT_ONCE = 1 << 20

# A wide signature has so many numbers of 64 bits.
WIDE = 8

_LAST = (1 << 63) - 1
_RARITY_BITS = 8
_KEEP = np.uint64((1 << (64 - _RARITY_BITS)) - 1)


class Tokens:
    """The lines of a slice with words: row, place in the row, how many words, and tokens line after line."""

    def __init__(self, part: Slice):
        words = words_of(part)
        hashes = word_hashes(part.data, words, lower=True)
        feeds = np.flatnonzero(part.data == ord("\n"))
        before = np.bincount(np.searchsorted(words.starts, feeds), minlength=len(words.starts) + 1)
        before = np.cumsum(before[:-1], dtype=np.int32)  # line feeds before each word
        place = before - np.searchsorted(feeds, part.offsets).astype(np.int32)[words.row]
        line = before + words.row  # another number for each line of the slice
        first = np.flatnonzero(np.diff(line, prepend=-1))
        sizes = np.diff(np.append(first, len(line)))
        line_of = np.repeat(np.arange(len(first), dtype=np.int32), sizes)
        runs, at = windows(hashes, line_of, TOKEN_WORDS)
        found, owner = [runs], [line_of[at]]
        for length in range(1, TOKEN_WORDS):
            # A line of fewer words than a token has is one token.
            own = np.flatnonzero(sizes == length)
            if len(own):
                at = (first[own][:, None] + np.arange(length)).ravel()
                runs, _ = windows(hashes[at], np.repeat(own, length), length)
                found.append(mixed(runs + np.uint64(length)))
                owner.append(own)
        self.hashes, owner = np.concatenate(found), np.concatenate(owner)
        if len(found) > 1:
            order = np.argsort(owner, kind="stable")
            self.hashes, owner = self.hashes[order], owner[order]
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        self.row, self.place = words.row[first][owner[starts]], place[first][owner[starts]]
        self.words = sizes[owner[starts]]
        self.starts = np.append(starts, len(owner))

    def entries(self) -> np.ndarray:
        """For each token its place in the table of counts."""
        return (self.hashes >> np.uint64(64 - LOG2_ENTRIES)).astype(np.int64)

    def classes(self) -> np.ndarray:
        """One hash for each line's tokens, in whatever order."""
        if len(self.starts) < 2:
            return np.zeros(0, np.uint64)
        return mixed(np.add.reduceat(mixed(self.hashes), self.starts[:-1]))

    def ordered(self, rarity: np.ndarray | None, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of some lines, each once, rarest first, and where each of these lines starts among them.

        A token is its rarity (common tokens have large ones), if given, followed by 56 bits of its hash.
        """
        sizes = np.diff(self.starts)[lines]
        owner = np.repeat(np.arange(len(lines)), sizes)
        starts = np.cumsum(sizes) - sizes
        own = np.repeat(self.starts[:-1][lines] - starts, sizes) + np.arange(len(owner))
        hashes = self.hashes[own]
        tokens = hashes & _KEEP
        if rarity is not None:
            tokens |= rarity[hashes >> np.uint64(64 - LOG2_ENTRIES)] << np.uint64(64 - _RARITY_BITS)
        _sort_each(tokens, starts, sizes)
        once = np.ones(len(tokens), bool)
        once[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        if once.all():
            return tokens, np.append(starts, len(tokens))
        tokens, owner = tokens[once], owner[once]
        return tokens, np.searchsorted(owner, np.arange(len(lines) + 1))


def _sort_each(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
    """Sorts, in place, each of the stretches of so many ``sizes`` that begin at ``starts``.

    Those of up to 8, 16, 32 ... values are rows of one table, filled up at their ends.
    """
    bands = np.ceil(np.log2(np.maximum(sizes, 8))).astype(np.int64)
    for band in np.unique(bands[sizes > 1]).tolist():
        some = np.flatnonzero(bands == band)
        at = np.arange(1 << band)
        used = at < sizes[some][:, None]
        places = (starts[some][:, None] + at)[used]
        table = np.full(used.shape, np.iinfo(values.dtype).max, values.dtype)
        table[used] = values[places]
        table.sort(axis=1)
        values[places] = table[used]


_LINES = "doc bigint, text_hash bigint, place int, klass bigint, n int, signature bigint, short boolean, counts array<bigint>"


def _doc(key: str) -> Column:
    return F.coalesce(F.col(key).cast("bigint"), F.lit(_LAST)).alias("doc")


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.col(text)).alias("text_hash")


def _signatures(lines: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """For each line how many different tokens it has, and 64 bits: each token turns one over.

    So sets differ in at least as many tokens as bits.
    """
    tokens, starts = lines.ordered(None, np.arange(len(lines.starts) - 1))
    bits = np.uint64(1) << (tokens & np.uint64(63))
    return np.diff(starts), np.bitwise_xor.reduceat(bits, starts[:-1]) if len(tokens) else bits


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All lines with words: class, number of tokens, signature; at the end, the task's ``counts`` of tokens.

    These are a row of place -1, with the count of each entry in order.
    """
    names, kinds = zip(*[x.split() for x in _LINES.split(", ")], strict=True)
    numbers = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    kinds = [numbers.get(x, pa.list_(pa.int64())) for x in kinds]

    def batch_of(*columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
        )

    totals = np.zeros(1 << LOG2_ENTRIES, np.int64)
    for batch in batches:
        docs, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
        for part in slices(batch.column(1)):
            lines = Tokens(part)
            totals += np.bincount(lines.entries(), minlength=len(totals))
            sizes, signatures = _signatures(lines)
            yield batch_of(
                docs[part.first + lines.row],
                hashes[part.first + lines.row],
                lines.place,
                lines.classes().view(np.int64),
                sizes,
                signatures.view(np.int64),
                lines.words < SHORT_WORDS,
                pa.nulls(len(sizes), kinds[-1]),
            )
    yield batch_of([0], [0], [-1], [0], [0], [0], [False], [totals])


def _rarity(listed: DataFrame) -> tuple[np.ndarray, int]:
    """The rarity of each entry of the table: its count over all texts on a logarithmic scale; and the number of all tokens."""
    counts = listed.where("place = -1").select(F.posexplode("counts").alias("entry", "n"))
    table = counts.groupBy("entry").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros(1 << LOG2_ENTRIES, np.int64)  # the table has a row for each entry at most
    totals[table.column("entry").to_numpy()] = table.column("n").to_numpy()
    return np.minimum(np.log2(totals + 1) * 6, (1 << _RARITY_BITS) - 1).astype(np.uint64), int(totals.sum())


def _prefix(sizes: np.ndarray, similarity: float) -> np.ndarray:
    return sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1


class _New:
    """Which classes a task has not met yet. Forgetting some makes rows come again, which does no harm."""

    def __init__(self, most: int = 1 << 18):
        self.met, self.most = set(), most

    def among(self, classes: np.ndarray) -> np.ndarray:
        if len(self.met) > self.most:
            self.met = set()
        new = []
        for i, x in enumerate(classes.tolist()):
            if x not in self.met:
                self.met.add(x)
                new.append(i)
        return np.array(new, np.int64)


# ``size_at``: the number of tokens, and in the lower half the place of this one among them, from the rarest. Lists of
# 64-bit numbers.
_DEALT = "bucket bigint, tokens binary, classes binary, size_at binary, docs binary"
_HALF = 32


def _buckets(tokens: int, similarity: float) -> int:
    """Into how many buckets the prefixes of lines of so many ``tokens`` in all are dealt, a power of two."""
    return max(LEAST_BUCKETS, 1 << min(30, int(tokens * (1 - similarity) / PER_BUCKET).bit_length()))


def _fewest(similarity: float) -> int:
    """The least number of tokens with which a set can match another one: a set of one token more that holds it."""
    return next(n for n in range(1, 1 << 20) if n >= similarity * (n + 1) - 1e-9)


def _in_buckets(columns: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """Rows of ``_DEALT``, one for each bucket of the tokens, which are the first of ``columns``."""
    bucket = columns[0] & (buckets - 1)
    # Small numbers are sorted by radix.
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    offsets = pa.py_buffer((8 * np.append(first, len(order))).astype(np.int32))
    lists = [
        pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(c[order])]) for c in columns
    ]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *lists], [x.split()[0] for x in _DEALT.split(", ")])


def _prefixes(shared, buckets: int, similarity: float):
    """The rarest tokens of each class, with the document of the first of its lines that the task meets.

    A class of so few tokens that it matches no other meets none.
    """
    least = _fewest(similarity)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, new = shared.value, _New()
        held, n_held = [], 0
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            for part in slices(batch.column(1)):
                lines = Tokens(part)
                classes = lines.classes()
                own = np.flatnonzero(np.diff(lines.starts) >= least)
                own = own[new.among(classes[own])]
                tokens, starts = lines.ordered(rarity, own)
                # Lines whose runs repeat may have fewer tokens than runs.
                some = np.flatnonzero(np.diff(starts) >= least)
                own, sizes, starts = own[some], np.diff(starts)[some], starts[some]
                lengths = _prefix(sizes, similarity)
                at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                columns = [
                    tokens[np.repeat(starts, lengths) + at].view(np.int64),
                    np.repeat(classes[own].view(np.int64), lengths),
                    np.repeat(sizes << _HALF, lengths) | at,
                    np.repeat(docs[part.first + lines.row[own]], lengths),
                ]
                held.append(columns)
                n_held += len(at)
                if n_held >= DEALT_AT_ONCE:
                    yield _in_buckets([np.concatenate(c) for c in zip(*held, strict=True)], buckets)
                    held, n_held = [], 0
        if n_held:
            yield _in_buckets([np.concatenate(c) for c in zip(*held, strict=True)], buckets)

    return dealt


def _numbers(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit numbers of a column of lists one after another, and where each list starts among them."""
    _, offsets, data = lists.buffers()
    wide = np.int64 if pa.types.is_large_binary(lists.type) else np.int32
    offsets = np.frombuffer(offsets, wide)[lists.offset : lists.offset + len(lists) + 1].astype(np.int64)
    numbers = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(np.int64)
    return numbers, (offsets - offsets[0]) // 8


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], bool]]:
    """The columns of each bucket, whose rows follow each other, and whether it is whole; else one of its pieces."""
    bucket, held, n_held, whole = None, [], 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy()
        columns = [_numbers(c) for c in batch.columns[1:]]
        starts = columns[0][1]
        cuts = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [len(ids)]]).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if ids[a] != bucket:
                if n_held:
                    yield [np.concatenate(c) for c in zip(*held, strict=True)], whole
                bucket, held, n_held, whole = ids[a], [], 0, True
            for x in range(starts[a], starts[b], MOST_IN_BUCKET):
                y = min(x + MOST_IN_BUCKET, starts[b])
                if n_held + y - x > MOST_IN_BUCKET:
                    yield [np.concatenate(c) for c in zip(*held, strict=True)], False
                    held, n_held, whole = [], 0, False
                held.append([c[x:y] for c, _ in columns])
                n_held += y - x
    if n_held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)], whole


def _may_match(n: int, i: int, m: int, j: int, similarity: float) -> bool:
    """Whether sets of ``n`` and ``m`` tokens can match if the first they share is the i-th and j-th."""
    need = math.ceil(similarity / (1 + similarity) * (n + m) - 1e-9)
    return min(n, m) >= similarity * max(n, m) - 1e-9 and 1 + min(n - i, m - j) - 1 >= need


_FOUND = "a bigint, b bigint, token bigint, n int, i int, seq int, open boolean"
_FOUND_SCHEMA = pa.schema(
    [("a", pa.int64()), ("b", pa.int64()), ("token", pa.int64()), ("n", pa.int32()), ("i", pa.int32()),
     ("seq", pa.int32()), ("open", pa.bool_())]
)


class _Met:
    """The classes that have met in one token, the first ones at hand. ``seq`` is the order in which they came."""

    def __init__(self, token: int):
        self.token, self.head, self.known, self.told, self.seq = token, [], set(), False, 0

    def meet(self, klass: int, n: int, i: int, similarity: float) -> Iterator[tuple]:
        """The rows of ``_FOUND`` that one more line makes."""
        if klass in self.known:
            return
        self.seq += 1
        row = (klass, n, i, self.seq)
        fits = [h[0] for h in self.head if _may_match(n, i, h[1], h[2], similarity)]
        for other in fits[:PAIRED]:
            yield (klass, other, None, None, None, None, None)
        full = len(self.head) >= EARLIEST
        is_open = full or len(fits) > PAIRED
        if is_open and not self.told:
            self.told = True
            for h in self.head:
                yield (h[0], None, self.token, *h[1:], False)
        if self.told:
            yield (klass, None, self.token, n, i, self.seq, is_open)
        if not full:
            self.head.append(row)
            self.known.add(klass)


def _first_pairs(similarity: float):
    """Over buckets of prefix tokens: pairs with the first classes of each token that come.

    Those of a token come in order of documents, so that the first are the
    earliest. Where some class could match more than it was paired with, it is
    ``open``, and all classes of its token are handed on with ``token``, without
    ``b``. So are all classes of a bucket that is too large to be whole.
    """

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tokens, classes, size_at, docs), whole in _by_bucket(batches):
            order = np.argsort(tokens)
            tokens, classes = tokens[order], classes[order]
            cuts = np.concatenate([[0], np.flatnonzero(tokens[1:] != tokens[:-1]) + 1, [len(tokens)]])
            # A token of one class pairs nothing, unless others come with another piece.
            alone = np.minimum.reduceat(classes, cuts[:-1]) == np.maximum.reduceat(classes, cuts[:-1])
            alone &= whole
            rows: list[tuple] = []
            for a, b in zip(cuts[:-1][~alone].tolist(), cuts[1:][~alone].tolist(), strict=True):
                own = order[a:b]
                known = classes[a:b]
                turn = np.lexsort((known, docs[own]))
                sizes, at = size_at[own[turn]] >> _HALF, size_at[own[turn]] & ((1 << _HALF) - 1)
                met = _Met(int(tokens[a]))
                for klass, n, i in zip(known[turn].tolist(), sizes.tolist(), at.tolist(), strict=True):
                    if whole:
                        rows += met.meet(klass, n, i, similarity)
                    else:
                        rows.append((klass, None, met.token, n, i, 0, True))
            found = list(zip(*rows, strict=True)) or [[]] * len(_FOUND_SCHEMA)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(found, _FOUND_SCHEMA, strict=True)], schema=_FOUND_SCHEMA
            )

    return paired


def _wide(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each set a signature of ``WIDE`` numbers, of whose bits each token turns one over."""
    wide = np.zeros((len(starts) - 1, WIDE), np.int64)
    if len(tokens):
        bits = np.uint64(1) << (tokens & np.uint64(63))
        which = (tokens >> np.uint64(6)) % np.uint64(WIDE)
        for i in range(WIDE):
            own = np.where(which == i, bits, np.uint64(0))
            wide[:, i] = np.bitwise_xor.reduceat(own, starts[:-1]).view(np.int64)
    return wide


def _token_sets(texts: DataFrame, shared, wanted: DataFrame) -> DataFrame:
    """``klass``, ``tokens`` and ``wide`` signature of the classes in ``wanted`` (``klass``, ``doc``).

    The documents of their first lines are read again; the rest stays on its task.
    """
    filled = bloom.build(wanted.select(F.col("klass").alias("key"), F.lit(1).alias("level")), LOG2_FILTER_BITS)
    probed = texts.sparkSession.sparkContext.broadcast(filled)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, new = shared.value, _New()
        for batch in batches:
            for part in slices(batch.column(1)):
                lines = Tokens(part)
                classes = lines.classes()
                own = np.flatnonzero(probed.value.has(classes))
                own = own[new.among(classes[own])]
                tokens, starts = lines.ordered(rarity, own)
                sets = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(tokens.view(np.int64)))
                wide = pa.FixedSizeListArray.from_arrays(pa.array(_wide(tokens, starts).ravel()), WIDE)
                columns = [pa.array(classes[own].view(np.int64)), sets, wide.cast(pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["klass", "tokens", "wide"])

    some, _ = bloom.told_apart(texts, "doc", wanted)
    rows = some.mapInArrow(found, "klass bigint, tokens array<bigint>, wide array<bigint>")
    sets = F.any_value(F.struct("tokens", "wide")).alias("set")
    return rows.join(wanted, "klass", "left_semi").groupBy("klass").agg(sets).select("klass", "set.*")


def _near_enough(a: str, b: str, sizes: Column, similarity: float) -> Column:
    """Whether the signatures of two sets differ in no more bits than matching sets of ``sizes`` tokens in all may."""
    apart = F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
    return apart <= F.lit((1 - similarity) / (1 + similarity)) * sizes + 1e-9


def _likely(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` whose signatures allow a match, with the first document of each and the ``later`` of both."""
    at = F.struct("doc", "text_hash", "place")

    def side(x):
        others = [F.col(c).alias(f"{c}_{x}") for c in ("doc", "n", "signature")]
        return classes.select(F.col("klass").alias(x), *others, at.alias(f"at_{x}"))

    near = _near_enough("signature_a", "signature_b", F.col("n_a") + F.col("n_b"), similarity)
    later = F.when(F.col("at_a") > F.col("at_b"), F.col("a")).otherwise(F.col("b"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(near & (F.col("at_a") != F.col("at_b")))
    return joined.select("a", "b", "doc_a", "doc_b", later.alias("later"))


def _all_near_enough(a: str, b: str, sizes: Column, similarity: float) -> Column:
    """``_near_enough`` for wide signatures, by the bits of all their numbers."""
    apart = sum(F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(WIDE))
    return apart <= F.lit((1 - similarity) / (1 + similarity)) * sizes + 1e-9


def _similar(a: str, b: str, similarity: float) -> Column:
    """Whether the Jaccard similarity of two columns of tokens is as asked."""
    both = F.size(F.array_intersect(a, b))
    return both >= F.lit(similarity) * (F.size(a) + F.size(b) - both) - 1e-9


def _links(likely: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of the pairs those whose tokens are as similar as asked, with the ``later`` class of each."""
    of_a = sets.select(F.col("klass").alias("a"), F.col("tokens").alias("ta"))
    of_b = sets.select(F.col("klass").alias("b"), F.col("tokens").alias("tb"))
    return likely.join(of_a, "a").join(of_b, "b").where(_similar("ta", "tb", similarity)).select("a", "b", "later")


def _each_once(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _other_pairs(
    members: DataFrame, settled: DataFrame | None, classes: DataFrame, sets: DataFrame, similarity: float
) -> DataFrame:
    """The classes that are not ``settled`` with every earlier class of their tokens that they may match, not yet paired.

    Without ``settled`` those of all classes. Earlier by their first lines. The order in which a token's classes came may
    be another, and only says which pairs there are: a class that is not ``open`` has been paired with all that came
    before it.

    A token may be in very many classes. So first the sizes and places with which
    it stands in sets are held against each other, and only those classes meet that
    the length and positional filters let match, and only in the first token that both
    have, by the rarer ones that each brings along: so a pair comes from one token, once.
    """
    first = F.struct("doc", "text_hash", "place").alias("first")
    known = classes.select("klass", first).join(sets, "klass").withColumnRenamed("klass", "a")
    rarer = F.slice("tokens", F.lit(1), F.col("i")).alias("rarer")
    # A class may have come to a token from several tasks.
    came = members.groupBy("token", "a", "n", "i").agg(
        F.min("seq").alias("seq"), F.max("seq").alias("last"), F.bool_or("open").alias("open")
    )
    placed = staged(came.join(known, "a").select(*came.columns, "first", "wide", rarer), "lines-placed")
    mine = placed if settled is None else placed.join(settled, "a", "left_anti")
    renamed = {"a": "b", "i": "j", "n": "m", "first": "first_b", "last": "last_b", "wide": "wide_b", "rarer": "rarer_b"}
    others = placed.select("token", *[F.col(x).alias(y) for x, y in renamed.items()])
    n, m, share = F.col("n"), F.col("m"), F.lit(similarity)
    need = F.ceil(share / (1 + share) * (n + m) - 1e-9)
    # Of either kind of place, what the classes there allow at most.
    latest = [F.max("first").alias("latest"), F.min("seq").alias("least_seq"), F.bool_or("open").alias("any_open")]
    earliest = [F.min("first_b").alias("earliest"), F.max("last_b").alias("most_seq")]
    kinds = mine.groupBy("token", "n", "i").agg(*latest).join(others.groupBy("token", "m", "j").agg(*earliest), "token")
    fitting = kinds.where(F.least(n, m) >= share * F.greatest(n, m) - 1e-9).where(
        (F.least(n - F.col("i"), m - F.col("j")) >= need)
        & (F.col("earliest") < F.col("latest"))
        & (F.col("any_open") | (F.col("most_seq") >= F.col("least_seq")))
    )
    fitting = staged(fitting.drop("latest", "least_seq", "any_open"), "lines-kinds")
    # A class goes only to kinds of places where some class is earlier than it.
    going = (F.col("earliest") < F.col("first")) & (F.col("open") | (F.col("most_seq") >= F.col("seq")))
    gone = mine.join(fitting, ["token", "n", "i"]).where(going).drop("earliest", "most_seq")
    met = gone.join(others, ["token", "m", "j"])
    earlier = (F.col("first_b") < F.col("first")) & (F.col("open") | (F.col("last_b") >= F.col("seq")))
    near = _all_near_enough("wide", "wide_b", n + m, similarity)
    found = met.where(earlier & near & ~F.arrays_overlap("rarer", "rarer_b"))
    pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("a").alias("later"))
    return staged(pairs, "lines-others")


_LINE = ["doc", "text_hash", "place"]


def _classes(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The classes, each with its first line and its number of ``lines``; and all lines of classes of several.

    Most classes have one line, which plain least values find; only the others' lines
    are compared as a whole. Size and signature are those of the class.
    """
    columns = [*_LINE, "n", "signature", "short"]
    counted = lines.groupBy("klass").agg(*[F.min(c).alias(c) for c in columns], F.count(F.lit(1)).alias("lines"))
    counted = staged(counted, "lines-counted")
    several = staged(lines.join(counted.where("lines > 1").select("klass"), "klass"), "lines-several")
    first = several.groupBy("klass").agg(F.min(F.struct(*columns)).alias("first"), F.count(F.lit(1)).alias("lines"))
    firsts = first.select("klass", "first.*", "lines")
    return staged(counted.where("lines = 1").unionByName(firsts), "lines-classes"), several


class Joined(NamedTuple):
    """All ``lines`` with words; their ``classes``; the lines of classes of ``several``; the classes ``near`` others; the
    ``links``: pairs ``a``, ``b`` of matching classes and the ``later`` of both."""

    lines: DataFrame
    classes: DataFrame
    several: DataFrame
    near: DataFrame
    links: DataFrame


def joined_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    all_links: bool = False,
) -> Joined:
    """The join of all lines, as tables of classes and of links between them.

    ``links`` are all there are, each once, if ``all_links``; else as many as tell which classes match an earlier one.
    """
    texts = docs.select(_doc(key), F.col(text).alias("text"), _text_hash(text))
    listed = staged(texts.mapInArrow(_listed, _LINES), "lines")
    lines = listed.where("place >= 0").drop("counts")
    rarity, n_tokens = _rarity(listed)
    shared = docs.sparkSession.sparkContext.broadcast(rarity)
    dealt = (
        texts.mapInArrow(_prefixes(shared, _buckets(n_tokens, similarity), similarity), _DEALT)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
    )
    found = staged(dealt.mapInArrow(_first_pairs(similarity), _FOUND), "lines-found")
    classes, several = _classes(lines)

    # Most classes met no other. All that is compared from here on is among the few that did.
    both = found.select(F.explode(F.array("a", "b")).alias("klass")).where("klass IS NOT NULL").distinct()
    near = staged(classes.join(both, "klass", "left_semi"), "lines-near")
    pairs = _each_once(found.where("b IS NOT NULL"))
    likely = staged(_likely(pairs, near, similarity), "lines-likely")
    members = found.where("token IS NOT NULL")
    # The texts are read once more for the tokens of all classes that either step may compare.
    ends = likely.select("a", "doc_a").union(likely.select("b", "doc_b")).toDF("klass", "doc")
    more = members.select(F.col("a").alias("klass")).distinct().join(near.select("klass", "doc"), "klass")
    wanted = staged(ends.union(more).distinct(), "lines-wanted")
    sets = staged(_token_sets(texts, shared, wanted), "lines-sets")
    first = likely.select("a", "b", "later")
    if all_links:
        # Nothing is settled before the second step, so the pairs of both are compared at once.
        pairs = first.union(_other_pairs(members, None, near, sets, similarity)).distinct()
        return Joined(lines, classes, several, near, staged(_links(pairs, sets, similarity), "lines-links"))
    links = staged(_links(first, sets, similarity), "lines-links")
    settled = links.select(F.col("later").alias("a")).distinct()
    others = _other_pairs(members, settled, near, sets, similarity)
    others = _links(others, sets, similarity).join(links, ["a", "b"], "left_anti")
    return Joined(lines, classes, several, near, links.union(staged(others, "lines-links")))


def noted_lines(joined: Joined) -> DataFrame:
    """All lines that others equal or match, the same text's or not, and whether each is ``removed``.

    Their class is that of ``first_doc`` and ``first_place``, its first line; it has so many ``copies`` (lines, its first
    included), and ``links`` to other classes.
    """
    ends = F.array(*[F.struct(F.col(x).alias("klass"), (F.col(x) == F.col("later")).alias("goes")) for x in "ab"])
    marks = joined.links.select(F.explode(ends).alias("end")).groupBy(F.col("end.klass").alias("klass"))
    marks = staged(marks.agg(F.count(F.lit(1)).alias("links"), F.bool_or("end.goes").alias("goes")), "lines-marks")
    first = ["klass", F.struct(*_LINE).alias("first"), F.col("lines").alias("copies")]
    # Classes of one line are lines themselves; of the others all lines go but the first, and that too if it is later.
    ones = joined.near.where("lines = 1").join(marks, "klass").select(*_LINE, "short", *first[1:], "links", "goes")
    marked = joined.classes.where("lines > 1").select(*first).join(marks, "klass", "left")
    rest = joined.several.join(marked, "klass").select(*ones.columns)
    removed = F.coalesce("goes", F.lit(False)) | (F.struct(*_LINE) != F.col("first"))
    return ones.unionByName(rest).select(
        *_LINE, "short", removed.alias("removed"), F.nullif(F.col("first.doc"), F.lit(_LAST)).alias("first_doc"),
        F.col("first.place").alias("first_place"), "copies", F.coalesce("links", F.lit(0)).alias("links"),
    )


def found_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> tuple[DataFrame, DataFrame]:
    """``doc``, ``text_hash``, ``place`` (from 0 in the document) and ``short`` of all lines with words, and of those removed.

    ``doc`` is the id, or the largest number where it is null.
    """
    joined, every = joined_lines(docs, key, text, **options), [*_LINE, "short"]
    return joined.lines.select(every), staged(noted_lines(joined).where("removed").select(every), "lines-gone")


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All lines of ``found_lines`` with ``removed``."""
    lines, gone = found_lines(docs, key, text, **options)
    marked = lines.join(gone.select(*_LINE, F.lit(True).alias("_gone")), _LINE, "left")
    return marked.select(*lines.columns, F.col("_gone").isNotNull().alias("removed"))


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """For each id with any line that is not short: ``n_lines`` of these, and ``removed_lines``, the places removed."""
    lines = repeated_lines(docs, key, text, **options).where("NOT short")
    removed = F.when(F.col("removed"), F.col("place"))
    return lines.groupBy("doc").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.array_sort(F.collect_set(removed)).alias("removed_lines"),
    ).select(F.when(F.col("doc") != _LAST, F.col("doc")).alias(key), "n_lines", "removed_lines")


def document_report(
    docs: DataFrame, key: str = "doc_id", text: str = "text", links: bool = False, **options
) -> DataFrame:
    """For each document ``n_lines`` and ``removed_lines``, ``n_short_lines`` and ``removed_short_lines``.

    With ``links`` also ``linked_lines``: by place, each line that others equal or match, with its class as ``first_doc``
    and ``first_place``, the class's ``copies``, and its ``links`` to other classes, all that there are.
    """
    row = ["doc", "text_hash"]
    joined = joined_lines(docs, key, text, all_links=links, **options)
    columns = {"lines": ~F.col("short"), "short_lines": F.col("short")}
    counts = joined.lines.groupBy(*row).agg(*[F.count_if(some).alias(f"n_{x}") for x, some in columns.items()])
    # Few documents have any such lines, so few are put into lists.
    noted = noted_lines(joined) if links else noted_lines(joined).where("removed")
    link = ["place", "first_doc", "first_place", "copies", "links"]
    each = F.sort_array(F.collect_set(F.struct(*link, "removed", "short"))).alias("_noted")

    def removed(short: bool) -> Column:
        gone = F.filter("_noted", lambda line: line["removed"] & (line["short"] == F.lit(short)))
        return F.transform(gone, lambda line: line["place"])

    lists = {"removed_lines": removed(False), "removed_short_lines": removed(True)}
    if links:
        lists["linked_lines"] = F.transform("_noted", lambda line: F.struct(*[line[x].alias(x) for x in link]))
    places = noted.groupBy(*row).agg(each).select(*row, *[x.alias(name) for name, x in lists.items()])
    report = docs.select(_doc(key), _text_hash(text), F.col(key))
    for found in (counts, places):
        report = report.join(found.hint("merge"), row, "left")
    names = [f"{kind}_{x}" for x in columns for kind in ("n", "removed")] + (["linked_lines"] if links else [])
    none = {x: F.lit(0) if x.startswith("n_") else F.array().cast(report.schema[x].dataType) for x in names}
    return report.select(key, *[F.coalesce(x, none[x]).alias(x) for x in names])


def _without(text: Column, places: Column) -> Column:
    """A text without the lines at ``places``."""
    kept = F.filter(
        F.split(text, "\n"), lambda line, i: ~F.coalesce(F.array_contains(places, i), F.lit(False))
    )
    return F.when(places.isNull(), text).otherwise(F.array_join(kept, "\n"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the lines that repeat earlier ones; a document all of whose lines go, goes.

    A column ``n_chars``, if there is one, counts the characters that are left.
    """
    _, removed = found_lines(docs, key, text, **options)
    removed = removed.groupBy(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"))
    removed = staged(removed.agg(F.collect_set("place").alias("_places")), "lines-removed")
    rows, text = apart(docs), own(text)
    placed = rows.select("*", _doc(own(key)).alias("_doc"), _text_hash(text).alias("_hash"))
    maybe, whole = bloom.told_apart(placed, "_hash", removed)
    # Of documents there is no bound, so neither is of this table: it is not to be broadcast.
    joined = maybe.join(removed.hint("merge"), ["_doc", "_hash"], "left")
    left = joined.withColumn(text, _without(F.col(text), F.col("_places")))
    # Only where lines went can a document have become blank.
    left = left.where(F.col("_places").isNull() | F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        size, before = F.length(text).cast(docs.schema["n_chars"].dataType), own("n_chars")
        left = left.withColumn(before, F.when(F.col("_places").isNull(), F.col(before)).otherwise(size))
    return left.select(together(docs)).unionByName(whole.select(together(docs)))
