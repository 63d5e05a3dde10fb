"""Scores of texts by a language model of word pairs kept in a log-frequency Bloom filter.

Words and pairs of words are counted over all training documents. The filter
holds each n-gram at as many levels as its count has on a logarithmic scale; probed
level by level, it gives the count back, rounded. The probability of a word after
another is that of the pair, smoothed by the word's own:

    P(w | h) = (c(h, w) + M P(w)) / (c(h) + M),   P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))

A text's words stand before others as often as after others, its end token too. So
its score is the sum, over its tokens w, of log10(c(h, w) + M P(w)) - log10(c(w) + M).

More n-grams than one filter holds are split into parts by their last word: all that a
token adds to the score is then in one part. Words with too many pairs for one part have these in several,
and themselves in each of them. The tokens are dealt to these parts, in one pass
over the texts, as a stored table with a folder for each part. The parts go to the
workers one after the other, each to meet its own tokens alone, so that all of them
together cost no more than the tokens do. Beside it stands an exact score by single words. Its
counts come from a table of frequent words on the workers, and by a join for the others.

Words have A-Z lower-cased; each text ends with an end token, which also stands
before its first word. N-grams are told apart by 63-bit hashes.

Defined results: a null or empty text is its end token; documents without an id
train; without training documents all words are unseen (N and V are 0); repeated
rows count and are scored each; an empty table gives no rows.
"""

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dossier.llm import bloom
from dossier.llm.words import Slice, mixed, slices, word_hashes, words_of
from dossier.operators.staging import scratch_path, staged

# The split of the contract, and the constant added to counts.
FOLDS, HELD_OUT = 5, 1
ADDED = 0.5

# Counts are rounded to a scale whose steps grow by this factor.
STEP = 1.5
# M: how many observations the single word's probability is worth.
PRIOR = 100.0
# The most bits of the filter, or of each part of it: 128 MB on each worker.
LOG2_FILTER_BITS = 30
# The least: 8 MB.
LEAST_LOG2_BITS = 26
# The most such parts.
MOST_PARTS = 1 << 12
# N-grams that a task adds up at once.
COUNTED_AT_ONCE = 1 << 22
# Frequent words whose exact counts go to all workers.
TABLE_WORDS = 1 << 19

_END = np.uint64(0xD1B54A32D192ED02)
_WORD_MASK = np.uint64(0xFFFFFFFFFFFFFFFE)
# Of a word's hash, so many bits after the lowest say to which part it belongs. A pair has those of its second word.
_TAG_BITS = 12
_TAGS = np.uint64((1 << _TAG_BITS) - 1)
_PAIR_MASK = np.uint64(((1 << 64) - 1) ^ ((2 << _TAG_BITS) - 1))


def _edges() -> np.ndarray:
    """The least count of each level."""
    edges = [1]
    while edges[-1] < 1 << 61:
        edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * STEP)))
    return np.array(edges, np.int64)


EDGES = _edges()
# The count that a level stands for: 0, then the geometric mean of the level's ends.
VALUES = np.concatenate([[0.0], np.sqrt(EDGES[:-1].astype(float) * (EDGES[1:] - 1))])


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(EDGES, counts, side="right")


def is_held_out(key: Column) -> Column:
    fold = F.pmod(F.crc32(key.cast("string")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def tokens_of(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and pairs of a slice as hashes, the lowest bit 0 for words and 1 for pairs, and their rows."""
    words = words_of(part)
    hashes = word_hashes(part.data, words, lower=True)
    sizes = np.bincount(words.row, minlength=part.rows) + 1
    tokens = np.full(len(hashes) + part.rows, _END, np.uint64)
    tokens[np.arange(len(hashes)) + words.row] = hashes & _WORD_MASK
    before = np.concatenate([np.full(min(1, len(tokens)), _END), tokens[:-1]])
    pairs = (mixed(mixed(before) + tokens) & _PAIR_MASK) | _tag(tokens) << np.uint64(1) | np.uint64(1)
    return tokens, pairs, np.repeat(np.arange(part.rows), sizes)


def _tag(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(1)) & _TAGS


def count_ngrams(texts: DataFrame) -> DataFrame:
    """``gram`` and ``n`` of all words and pairs, each task's added up in memory of fixed size before they are shuffled."""

    def summed(found: list[np.ndarray]) -> pa.RecordBatch:
        grams = np.concatenate(found)
        found.clear()
        grams.sort()
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
        n = np.diff(np.append(first, len(grams)))
        columns = [pa.array(grams[first].view(np.int64)), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["gram", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for part in slices(batch.column(0)):
                tokens, pairs, _ = tokens_of(part)
                found += [tokens, pairs]
                size += 2 * len(tokens)
                if size >= COUNTED_AT_ONCE:
                    yield summed(found)
                    size = 0
        if found:
            yield summed(found)

    rows = texts.mapInArrow(counted, "gram bigint, n bigint")
    return rows.groupBy("gram").agg(F.sum("n").alias("n"))


def _is_word() -> Column:
    return F.col("gram").bitwiseAND(F.lit(1).cast("bigint")) == 0


class Model:
    """What workers need: N, V, the frequent words' exact counts, and the filter or a part of it."""

    def __init__(self, total: int, distinct: int, words: np.ndarray, counts: np.ndarray):
        self.total, self.distinct = total, distinct
        self.words, self.counts = words, counts
        self.norm = total + ADDED * (distinct + 1)

    def with_filter(self, filled: bloom.Bloom) -> "Model":
        model = Model(self.total, self.distinct, self.words, self.counts)
        model.filled = filled
        return model

    def _found(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of some words are frequent, and where these are in the table."""
        if not len(self.words):
            return np.zeros(len(words), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        known = self.words[at] == words
        return known, at[known]

    def look_up(self, words: np.ndarray) -> np.ndarray:
        """The exact counts of the frequent among some words, -1 for others."""
        known, at = self._found(words)
        counts = np.full(len(words), -1)
        counts[known] = self.counts[at]
        return counts

    def rounded(self, grams: np.ndarray) -> np.ndarray:
        """The counts of n-grams as the filter has them."""
        return VALUES[self.filled.levels(grams)]

    @cached_property
    def _frequent(self) -> np.ndarray:
        return self.rounded(self.words)

    def rounded_words(self, words: np.ndarray) -> np.ndarray:
        """The counts of words as a whole filter has them; the frequent ones are probed once on each worker."""
        known, at = self._found(words)
        rounded = np.zeros(len(words))
        rounded[known] = self._frequent[at]
        rounded[~known] = self.rounded(words[~known])
        return rounded

    def log_probabilities(self, own: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """What tokens add to the log10 probability of their texts, from their counts and pairs, all in the filter."""
        distinct, index = np.unique(pairs, return_inverse=True)
        together = self.rounded(distinct)[index]
        return np.log10(together + PRIOR * (own + ADDED) / self.norm) - np.log10(own + PRIOR)


def _cutoff(by_octave: dict[int, int], most: float, weight) -> int:
    """The least power of two such that the n-grams seen at least as often weigh ``most`` at most."""
    held, cutoff = 0.0, 1 << (max(by_octave, default=0) + 1)
    for octave in sorted(by_octave, reverse=True):
        held += by_octave[octave] * weight(octave)
        if held > most:
            break
        cutoff = 1 << octave
    return cutoff


def _room(log2_bits: int) -> float:
    """As many levels as leave half of the bits unset."""
    return (1 << max(log2_bits, bloom.BLOCK_BITS)) * math.log(2) / bloom.PROBES


def _level(octave: int) -> int:
    return int(level_of(np.array((2 << octave) - 1)))


class Parts:
    """To which part of the filter an n-gram goes, by the tag of its last word.

    ``own`` is the part of each tag; -1 for tags too heavy for one part. Their pairs
    are dealt to the ``spread`` last parts by their hashes, and their words are in all of these.
    """

    def __init__(self, own: np.ndarray, packed: int, spread: int):
        self.own, self.packed, self.spread, self.number = own, packed, spread, packed + spread

    def of(self, grams: np.ndarray) -> np.ndarray:
        part = self.own[_tag(grams).view(np.int64)]
        heavy = np.flatnonzero(part < 0)
        if len(heavy):
            hashes = grams[heavy] >> np.uint64(1 + _TAG_BITS)
            part[heavy] = self.packed + (hashes % np.uint64(self.spread)).astype(np.int64)
        return part

    def of_all(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of n-grams and their parts, words of heavy tags several times."""
        part = self.of(grams)
        many = (self.own[_tag(grams).view(np.int64)] < 0) & (grams & np.uint64(1) == 0)
        times = np.where(many, self.spread, 1)
        index = np.repeat(np.arange(len(grams)), times)
        nth = np.arange(len(index)) - np.repeat(np.cumsum(times) - times, times)
        return index, np.where(many[index], self.packed + nth, part[index])


def _packed(words: np.ndarray, pairs: np.ndarray, room: float) -> tuple[Parts, float]:
    """Parts of at most ``room`` levels for tags with so many levels of words and of pairs, and the most that one has."""
    weights = words + pairs
    own, filled = np.full(len(weights), -1), []
    # Each tag to the first part with room for it, heavy ones first.
    for tag in np.argsort(-weights, kind="stable").tolist():
        if weights[tag] <= room / 2:
            fits = (i for i, held in enumerate(filled) if held + weights[tag] <= room)
            if (part := next(fits, len(filled))) == len(filled):
                filled.append(0.0)
            filled[part] += weights[tag]
            own[tag] = part
    heavy = own < 0
    spread, each = 0, words[heavy].sum()
    if heavy.any():
        if each > room / 2:
            raise ValueError("too many words for a part of the filter; give more bits")
        # Dealt by hashes, parts are not quite even.
        spread = math.ceil(pairs[heavy].sum() / (0.9 * (room - each)))
        each += pairs[heavy].sum() / spread
    if len(filled) + spread > MOST_PARTS:
        raise ValueError(f"{len(filled) + spread} parts of the filter are more than {MOST_PARTS}; give more bits")
    return Parts(own, len(filled), spread), max([each, *filled])


class Grams:
    """The stored n-grams, and the parts into which their filter is split. A filter is no larger than it must be."""

    def __init__(self, counted: DataFrame, weight: float, log2_bits: int):
        self.kept, self.parts, heaviest = counted, None, weight
        if weight > _room(log2_bits):
            self.parts, heaviest = _packed(*self._weights(), _room(log2_bits))
        self.log2_bits = min(log2_bits, LEAST_LOG2_BITS)
        while heaviest > _room(self.log2_bits) and self.log2_bits < log2_bits:
            self.log2_bits += 1

    def _weights(self) -> np.ndarray:
        """For words and for pairs, the levels of each tag at most."""
        weights = np.zeros((2, 1 << _TAG_BITS))
        levels = F.get(F.array(*[F.lit(_level(octave)) for octave in range(63)]), F.length(F.bin("n")) - 1)
        tag = F.shiftrightunsigned("gram", 1).bitwiseAND(F.lit(int(_TAGS)).cast("bigint")).alias("tag")
        # Two rows for each tag at most.
        for row in self.kept.groupBy(_is_word().alias("word"), tag).agg(F.sum(levels).alias("k")).collect():
            weights[0 if row.word else 1, row.tag] = row.k
        return weights

    def filters(self) -> Iterator[bloom.Bloom]:
        """The filters of the parts in turn, half of the bits of each unset or more."""
        parts = self.parts

        def leveled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                level = level_of(batch.column(1).to_numpy()).astype(np.int32)
                grams, part = batch.column(0).to_numpy(), np.zeros(len(level), np.int64)
                if parts:
                    index, part = parts.of_all(grams.view(np.uint64))
                    grams, level = grams[index], level[index]
                columns = [pa.array(grams), pa.array(level), pa.array(part, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "level", "part"])

        rows = self.kept.mapInArrow(leveled, "key bigint, level int, part int")
        if not parts:
            yield bloom.build(rows, self.log2_bits)
            return
        # The blocks of all parts are made in one pass over the n-grams.
        log2_blocks = max(0, self.log2_bits - bloom.BLOCK_BITS)
        of = F.shiftright("block", log2_blocks).alias("part")
        filled = bloom.blocks(rows, self.log2_bits, F.col("part")).select("block", "bits", of)
        filled = staged(filled, "lm-filter", by="part")
        for part in range(parts.number):
            yield bloom.assembled(filled.where(F.col("part") == part), self.log2_bits)


def train(texts: DataFrame, log2_bits: int = LOG2_FILTER_BITS, table_words: int = TABLE_WORDS) -> tuple[Model, Grams, DataFrame]:
    """The model of all ``text`` without its filter, the n-grams for that, and the counts of words not in its table."""
    grams = staged(count_ngrams(texts.select("text")), "lm-ngrams")
    word = _is_word()
    octave = (F.length(F.bin("n")) - 1).alias("octave")
    words_by_octave: dict[int, int] = {}
    weight = total = distinct = 0
    # At most 63 octaves for words and for pairs.
    for row in grams.groupBy(word.alias("word"), octave).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).collect():
        weight += row.k * _level(row.octave)
        if row.word:
            words_by_octave[row.octave] = row.k
            total, distinct = total + row.n, distinct + row.k
    frequent = max(1, _cutoff(words_by_octave, table_words, lambda o: 1))

    n = F.col("n")
    table = grams.where(word & (n >= frequent)).toArrow()  # at most table_words rows
    words = table.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(words)
    model = Model(total, distinct, words[order], table.column("n").to_numpy()[order])
    return model, Grams(grams, weight, log2_bits), grams.where(word & (n < frequent))


class _Measured:
    """The documents of a slice: ``n_tokens``, ``n_known``, ``logs``, and as ``others`` the words not in the model's table."""

    def __init__(self, model: Model, part: Slice):
        self.tokens, self.pairs, self.row = tokens_of(part)
        distinct, index = self.told = np.unique(self.tokens, return_inverse=True)
        counts = model.look_up(distinct)
        known = (counts >= 0)[index]
        logs = np.where(counts >= 0, np.log10(np.maximum(counts, 0) + ADDED), 0.0)[index]
        sums = [np.bincount(self.row, some, minlength=part.rows) for some in (None, known, logs)]
        sizes = np.bincount(self.row[~known], minlength=part.rows)
        others = _lists(self.tokens[~known], sizes)
        self.columns = [pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)), pa.array(sums[2]), others]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values.view(np.int64)))


_MEASURES = "n_tokens bigint, n_known bigint, logs double, others array<bigint>"
_NAMES = [x.split()[0] for x in _MEASURES.split(", ")]


def _scores(shared):
    """Measures and score of each text by a model with a whole filter."""
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.float64()]
    empty = pa.StructArray.from_arrays([pa.array([], kind) for kind in kinds], [*_NAMES, "score"])

    def scored(texts: pa.Array) -> pa.Array:
        found = [empty]
        for part in slices(texts):
            measured = _Measured(shared.value, part)
            distinct, index = measured.told
            logs = shared.value.log_probabilities(shared.value.rounded_words(distinct)[index], measured.pairs)
            score = pa.array(np.bincount(measured.row, logs, minlength=part.rows))
            found.append(pa.StructArray.from_arrays([*measured.columns, score], [*_NAMES, "score"]))
        return pa.concat_arrays(found)

    return F.arrow_udf(scored, f"struct<{_MEASURES.replace(' ', ':').replace(',:', ',')},score:double>")


_DEALT = pa.schema(
    [("_row", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64()),
     *[(name, pa.list_(pa.int64())) for name in ("others", "rows", "tokens", "pairs")], ("part", pa.int32())]
)
_DEALT_DDL = f"_row bigint, {_MEASURES}, rows array<bigint>, tokens array<bigint>, pairs array<bigint>, part int"
_SUMS = "_row bigint, score double"
# Stands for a part in the rows of documents.
_DOCUMENT = -1
# Tokens that a task probes at once.
_PROBED_AT_ONCE = 20


def _dealt(shared, parts: Parts):
    """Of ``_row``, a key and a text: a row for each text with its measures, and rows of its slice's tokens for each part."""

    def batch_of(size: int, key: pa.DataType, **columns) -> pa.RecordBatch:
        schema = _DEALT.append(pa.field("_key", key))
        arrays = [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(1).type
            for part in slices(batch.column(2)):
                own = batch.slice(part.first, part.rows)
                measured = _Measured(shared.value, part)
                columns = dict(zip(_NAMES, measured.columns, strict=True), _row=own.column(0), _key=own.column(1))
                yield batch_of(part.rows, key, part=pa.array(np.full(part.rows, _DOCUMENT)), **columns)
                of = parts.of(measured.pairs).astype(np.uint16)
                order, sizes = np.argsort(of, kind="stable"), np.bincount(of)
                some = np.flatnonzero(sizes)
                rows = own.column(0).to_numpy()[measured.row]
                lists = {"rows": rows, "tokens": measured.tokens, "pairs": measured.pairs}
                lists = {name: _lists(values[order], sizes[some]) for name, values in lists.items()}
                yield batch_of(len(some), key, part=pa.array(some), **lists)

    return dealt


def _part_sums(shared):
    """What the tokens of a part add to the scores of their rows."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(batch.column(0).value_lengths().to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff((ends - 1) >> _PROBED_AT_ONCE, prepend=-1))
            for a, b in zip(cuts, np.append(cuts[1:], len(ends)), strict=True):
                rows, tokens, pairs = (c.flatten().to_numpy() for c in batch.slice(a, b - a).columns)
                words, index = np.unique(tokens.view(np.uint64), return_inverse=True)
                logs = shared.value.log_probabilities(shared.value.rounded(words)[index], pairs.view(np.uint64))
                distinct, index = np.unique(rows, return_inverse=True)
                sums = np.bincount(index, logs, minlength=len(distinct))
                yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(sums)], ["_row", "score"])

    return summed


def _scored_in_parts(numbered: DataFrame, key: str, model: Model, grams: Grams) -> DataFrame:
    """What ``_scores`` gives, with ``_row`` and ``key``, by tokens dealt to the parts of the filter."""
    spark = numbered.sparkSession
    kinds = StructType.fromDDL(_DEALT_DDL).add("_key", numbered.schema.fields[1].dataType)
    shared = spark.sparkContext.broadcast(model)
    table = staged(numbered.mapInArrow(_dealt(shared, grams.parts), kinds), "lm-dealt", by="part")
    shared.destroy()
    path = scratch_path(spark, "lm-sums")
    for part, filled in enumerate(grams.filters()):
        shared = spark.sparkContext.broadcast(model.with_filter(filled))
        own = table.where(F.col("part") == part).select("rows", "tokens", "pairs")
        own.mapInArrow(_part_sums(shared), _SUMS).write.mode("append").parquet(path)
        shared.destroy()
    score = spark.read.schema(_SUMS).parquet(path).groupBy("_row").agg(F.sum("score").alias("score"))
    documents = table.where(F.col("part") == _DOCUMENT)
    return documents.join(score, "_row").select("_row", F.col("_key").alias(key), *_NAMES, "score")


def score_documents(docs: DataFrame, train_texts: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every document.

    ``train_texts`` has the texts to learn from as ``text``.
    """
    model, grams, rare = train(train_texts, **options)
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), key, F.col(text).alias("_text"))
    if grams.parts:
        rows = staged(_scored_in_parts(numbered, key, model, grams), "lm-scores")
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model.with_filter(next(grams.filters())))
        rows = numbered.select("_row", key, _scores(shared)(F.col("_text")).alias("_s"))
        rows = staged(rows.select("_row", key, "_s.*"), "lm-scores")
        shared.destroy()
    # Words that are not in the table: their counts are joined, and what they add is summed up by document.
    others = rows.select("_row", F.explode("others").alias("gram"))
    n = F.coalesce("n", F.lit(0))
    added = (
        others.groupBy("_row", "gram")
        .agg(F.count(F.lit(1)).alias("times"))
        .join(rare, "gram", "left")
        .groupBy("_row")
        .agg(
            F.sum(F.col("times") * F.log10(n + ADDED)).alias("_logs"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("_known"),
        )
    )
    norm = F.lit(math.log10(model.norm))
    return rows.join(added, "_row", "left").select(
        key,
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("_logs", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"),
        "score",
    )
