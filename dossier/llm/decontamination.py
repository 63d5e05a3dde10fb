"""Finding copies of benchmark items in documents, edited ones included.

Runs of three words are counted over all documents, as far as a benchmark item
has them. Of any few neighbouring runs of an item the rarest is a seed. Where a
document holds a seed, its passage around is aligned with the item, word by word,
by Smith and Waterman's method; the score counts what is equal, less edits.

Any five words in a row that a copy leaves unedited hold a seed. Words are
compared with A-Z lower-cased and ASCII punctuation taken out.

Defined results: null and empty texts, and items of fewer than three words, match
nothing; a null id is an id; repeated rows are searched each by itself, and
repeated items report each; empty tables give no rows; other columns are not read.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.llm.tables import apart, own, together
from dossier.llm.words import LOWER, Slice, row_starts, slices, windows, word_hashes, words_of
from dossier.operators.staging import staged

RUN = 3
# Of so many neighbouring runs of an item, one is a seed.
WINNOW = 3

# Alignment: equal words, other words, and words left out or put in.
MATCH, MISMATCH, GAP = 2, -1, -1
# Share of the score of an exact copy of the whole item that makes a copy.
MIN_SCORE = 0.5
# Of an item of any length, an alignment makes a copy that scores as much as so many equal words.
MIN_WORDS = 26
# A passage may be longer than its item by this share of the item, on either side.
SLACK = 0.5

# Items are broadcast in blocks of at most so many words (plus one item); more items mean more blocks, one after the other.
BLOCK_WORDS = 1 << 19

COPY = "item_id:bigint,score:double,start_word:bigint,end_word:bigint,equal_words:bigint"
_COPY_FIELDS = [
    (x.split(":")[0], pa.float64() if x.endswith("double") else pa.int64()) for x in COPY.split(",")
]

# Bytes as words see them: A-Z lower-cased, other ASCII signs as spaces.
_PLAIN = LOWER.copy()
_PLAIN[[i for i in range(128) if not chr(i).isalnum()]] = ord(" ")


class Items(NamedTuple):
    """A block of items: their words' hashes one after the other, and the runs of all."""

    ids: list
    starts: np.ndarray  # where each item's words start, and where the last end
    words: np.ndarray
    runs: np.ndarray  # distinct hashes of runs, sorted
    at: np.ndarray  # for each place in words where a run starts, its index in runs; else -1


def _text_words(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    plain = part._replace(data=_PLAIN[part.data])
    words = words_of(plain)
    return word_hashes(plain.data, words), words.row


def gathered(ids: list, texts: list) -> Items:
    hashes, lengths = [np.zeros(0, np.uint64)], []
    for part in slices(pa.array(texts, pa.string())):
        found, row = _text_words(part)
        hashes.append(found)
        lengths.extend(np.bincount(row, minlength=part.rows).tolist())
    words = np.concatenate(hashes)
    starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(ids)), lengths)
    found, place = windows(words, row, RUN)
    runs, index = np.unique(found, return_inverse=True)
    at = np.full(len(words), -1)
    at[place] = index
    return Items(ids, starts, words, runs, at)


def _member(found: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The index in the sorted ``table`` of each value found, -1 if it is not there."""
    if not len(table) or not len(found):
        return np.full(len(found), -1)
    # Most values are not there: a small map of their lowest bits says so first.
    low = np.uint64(0xFFFFF)
    seen = np.zeros(1 << 20, bool)
    seen[(table & low).astype(np.int64)] = True
    index = np.full(len(found), -1)
    maybe = np.flatnonzero(seen[(found & low).astype(np.int64)])
    place = np.minimum(np.searchsorted(table, found[maybe]), len(table) - 1)
    hit = table[place] == found[maybe]
    index[maybe[hit]] = place[hit]
    return index


def run_counts(texts: DataFrame, shared) -> DataFrame:
    """``run`` (index) and ``n``: in how many documents each run of the items occurs."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        totals = np.zeros(len(items.runs), np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                hashes, row = _text_words(part)
                found, place = windows(hashes, row, RUN)
                index = _member(found, items.runs)
                hit = index >= 0
                pairs = np.unique(row[place[hit]] * len(items.runs) + index[hit])
                totals += np.bincount(pairs % len(items.runs), minlength=len(totals)) if len(pairs) else 0
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], ["run", "n"])

    return texts.mapInArrow(counted, "run bigint, n bigint").groupBy("run").agg(F.sum("n").alias("n"))


def seed_places(items: Items, counts: np.ndarray) -> np.ndarray:
    """The places in ``items.words`` where a seed starts: the rarest run of each few neighbours."""
    chosen = set()
    for i in range(len(items.ids)):
        first, last = int(items.starts[i]), int(items.starts[i + 1]) - RUN + 1
        places = list(range(first, max(first, last)))
        for k in range(max(len(places) - WINNOW + 1, min(1, len(places)))):
            few = places[k : k + WINNOW]
            chosen.add(min(few, key=lambda p: (counts[items.at[p]], p)))
    return np.array(sorted(chosen), np.int64)


class Alignment(NamedTuple):
    score: int
    start: int
    end: int
    equal: int


def align(item: np.ndarray, passage: np.ndarray) -> Alignment:
    """The best local alignment: its score, the passage's words it covers, and how many are equal.

    Row by row of the table of scores, of which two are kept: each cell has with its
    score where its alignment began and how many equal words it has. So memory
    grows with the passage alone.
    """
    steps = np.arange(len(passage) + 1)
    above, began, equal = np.zeros(len(steps), np.int64), steps.copy(), np.zeros(len(steps), np.int64)
    best = Alignment(0, 0, 0, 0)
    for word in item:
        score = np.maximum(above + GAP, 0)
        same = passage == word
        across = above[:-1] + np.where(same, MATCH, MISMATCH)
        taken = np.flatnonzero(across >= score[1:]) + 1
        score[taken] = across[taken - 1]
        began[taken], equal[taken] = began[taken - 1], equal[taken - 1] + same[taken - 1]
        # With any number of words put in, each of one cost: from the last place whose score, less that, is highest.
        level = score - GAP * steps
        highest = np.maximum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == highest, steps, 0))
        above = highest + GAP * steps
        began, equal = began[source], equal[source]
        nothing = above == 0
        began[nothing], equal[nothing] = steps[nothing], 0
        end = int(above.argmax())
        if above[end] > best.score:
            best = Alignment(int(above[end]), int(began[end]), end, int(equal[end]))
    return best


def least_score(words: int, min_score: float = MIN_SCORE, min_words: int = MIN_WORDS) -> float:
    """What an alignment with an item of so many words must score to make a copy."""
    return MATCH * min(min_score * words, min_words)


def _passages(places: np.ndarray, offsets: np.ndarray, length: int, words: int) -> list[tuple[int, int]]:
    """Stretches of a document of ``words`` words in which copies of an item may lie around its seeds."""
    slack = int(length * SLACK) + RUN
    spans: list[tuple[int, int]] = []
    for place, offset in sorted(zip(places.tolist(), offsets.tolist(), strict=True)):
        start, end = max(0, place - offset - slack), min(words, place - offset + length + slack)
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def best_copy(item: np.ndarray, document: np.ndarray, spans: list[tuple[int, int]], least: float) -> Alignment | None:
    """The best alignment of at least ``least`` in any span; long spans are aligned in overlapping pieces."""
    best, step = None, 8 * len(item)
    for start, end in spans:
        for first in range(start, max(start + 1, end - 2 * len(item)), step):
            passage = document[first : min(end, first + step + 3 * len(item))]
            # No alignment has more equal words than the passage has words of the item.
            if MATCH * np.isin(passage, item).sum() < least:
                continue
            found = align(item, passage)
            if found.score >= least and (best is None or found.score > best.score):
                best = found._replace(start=found.start + first, end=found.end + first)
    return best


def copies_in(shared, min_score: float, min_words: int):
    """A column function from texts to the copies they hold, an array of ``COPY``.

    A document is searched by the task that reads it; nothing is shuffled.
    """

    def searched(texts: pa.Array) -> pa.Array:
        items, places = shared.value
        seeds = items.runs[items.at[places]]
        order = np.argsort(seeds, kind="stable")
        seeds, places = seeds[order], places[order]
        owner = np.searchsorted(items.starts, places, side="right") - 1
        table = np.unique(seeds)
        found: list[list[dict]] = [[] for _ in range(len(texts))]
        for part in slices(texts):
            hashes, row = _text_words(part)
            starts = row_starts(row, part.rows)
            runs, at = windows(hashes, row, RUN)
            hit = np.flatnonzero(_member(runs, table) >= 0)
            # Each hit with all places of its seed; a seed may stand in several items.
            first = np.searchsorted(seeds, runs[hit], side="left")
            many = np.searchsorted(seeds, runs[hit], side="right") - first
            where = np.repeat(at[hit], many)
            which = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
            pairs = row[where] * len(items.ids) + owner[which]
            by_pair = np.argsort(pairs, kind="stable")
            cuts = np.flatnonzero(np.diff(pairs[by_pair])) + 1
            for group in np.split(by_pair, cuts) if len(by_pair) else []:
                i, k = divmod(int(pairs[group[0]]), len(items.ids))
                item = items.words[items.starts[k] : items.starts[k + 1]]
                document = hashes[starts[i] : starts[i + 1]]
                offsets = places[which[group]] - items.starts[k]
                spans = _passages(where[group] - starts[i], offsets, len(item), len(document))
                best = best_copy(item, document, spans, least_score(len(item), min_score, min_words))
                if best:
                    found[part.first + i].append(
                        {
                            "item_id": items.ids[k],
                            "score": best.score / (MATCH * len(item)),
                            "start_word": best.start,
                            "end_word": best.end,
                            "equal_words": best.equal,
                        }
                    )
        return pa.array(found, pa.list_(pa.struct(_COPY_FIELDS)))

    return F.arrow_udf(searched, f"array<struct<{COPY}>>")


def with_copies(
    docs: DataFrame,
    benchmark: DataFrame,
    min_score: float = MIN_SCORE,
    min_words: int = MIN_WORDS,
    block_words: int = BLOCK_WORDS,
    as_col: str = "copies",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the copies each holds: item, score (1 for an exact copy), the words it covers.

    A copy is an alignment that scores ``min_score`` of an exact copy of its item, or
    as much as ``min_words`` equal words. The benchmark is the query set: its words
    are counted, and its items go to the workers in blocks of bounded size, one after
    the other, each of which meets all documents.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    letters = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A word has at least a letter and a space, so this many words there may be at most.
    blocks = 1 + letters // 2 // block_words
    marked = docs.withColumn(as_col, F.array().cast(f"array<struct<{COPY}>>"))
    for block in range(blocks):
        own_items = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = own_items.orderBy("item_id", "text").collect()  # a block's items
        block_items = gathered([r.item_id for r in rows], [r.text for r in rows])
        shared = spark.sparkContext.broadcast(block_items)
        counts = np.zeros(len(block_items.runs), np.int64)
        for row in run_counts(docs.select(text_col), shared).collect():  # a row for each run of the block at most
            counts[row.run] = row.n
        shared.destroy()
        seeds = spark.sparkContext.broadcast((block_items, seed_places(block_items, counts)))
        found = copies_in(seeds, min_score, min_words)(F.col(text_col))
        marked = marked.withColumn(as_col, F.concat(as_col, found))
        if blocks > 1:
            # Written block by block, so that workers never hold more than one.
            marked = staged(marked, "copies")
            seeds.destroy()
    return marked


def find_copies(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for each pair of a document and an item it holds a copy of."""
    texts = docs.select("doc_id", "text")
    marked = with_copies(texts, benchmark, as_col="_copies", **options)
    return marked.select("doc_id", F.explode("_copies").alias("_copy")).select("doc_id", "_copy.*")


def without_copies(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no copy of an item, with the columns of ``docs``."""
    marked = with_copies(apart(docs), benchmark, as_col="_copies", text_col=own("text"), **options)
    return marked.where(F.size("_copies") == 0).select(*together(docs))
