"""Words of UTF-8 text in numpy arrays: whole Arrow columns, without a Python object per word.

A word is a longest run of bytes other than space and 0x09-0x0D. White space of
other kinds, and all that is not ASCII, belongs to words.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import as_strided

# The pattern of a word, for Spark's and Python's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Text is taken in slices of about so many bytes, so that its arrays stay small.
SLICE_BYTES = 1 << 18
# Longer words are hashed singly.
_LONG_WORD = 1 << 10

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Slice(NamedTuple):
    """Some rows' text: row ``first + i`` has the bytes ``offsets[i]`` to ``offsets[i + 1]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """The words of a slice: where each starts and ends, and its row within the slice."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The rows of a string column, nulls as empty text, some at a time; a longer text stands alone."""
    column = column.fill_null("")
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return
    offsets = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Slice(
            first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        )
        first = last


def per_row(part: Slice, marked: np.ndarray) -> np.ndarray:
    """How many bytes of each row are marked."""
    sums = np.concatenate([[0], np.cumsum(marked, dtype=np.int64)])
    return sums[part.offsets[1:]] - sums[part.offsets[:-1]]


def words_of(part: Slice) -> Words:
    # Bytes wrap around: the five signs from 0x09 on are all that is below 5 then.
    word = (part.data != 0x20) & (part.data - np.uint8(0x09) >= 5)
    if not len(word):
        none = np.zeros(0, np.int64)
        return Words(none, none, none)
    # Words begin and end in turn where bytes of words and of space meet.
    turns = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        turns = np.concatenate([[0], turns])
    if word[-1]:
        turns = np.append(turns, len(word))
    # So do they where two rows meet inside a word, which ends there and begins.
    edges = part.offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(word))]
    edges = np.unique(edges[word[edges] & word[edges - 1]])
    if len(edges):
        turns = np.insert(turns, np.repeat(np.searchsorted(turns, edges), 2), np.repeat(edges, 2))
    starts, ends = turns[::2], turns[1::2]
    rows = np.bincount(np.searchsorted(starts, part.offsets[:-1]), minlength=len(starts) + 1)[: len(starts)]
    return Words(starts, ends, np.cumsum(rows) - 1)


def mixed(hashes: np.ndarray) -> np.ndarray:
    """64-bit values spread over all bits; different values stay different."""
    h = hashes ^ (hashes >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray, words: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; with ``lower``, of the word with A-Z lower-cased.

    Eight bytes at a time, of all words that are as long, with the length mixed in.
    """
    starts, sizes = words.starts, words.ends - words.starts
    text = np.zeros(len(data) + 8, np.uint8)
    text[: len(data)] = data
    if lower:
        text |= (text - np.uint8(ord("A")) < 26).view(np.uint8) << np.uint8(5)
    eights = as_strided(text.view(np.uint8), (len(data) + 1, 8), (1, 1)).view("<u8")[:, 0]
    hashes = mixed(_step(eights, starts, sizes) + sizes.astype(np.uint64) * _ODD)
    longer, at = np.flatnonzero(sizes > 8), 8
    while len(longer) and at < _LONG_WORD:
        hashes[longer] = mixed((hashes[longer] + _ODD) ^ _step(eights, starts[longer] + at, sizes[longer] - at))
        at += 8
        longer = longer[sizes[longer] > at]
    for k in longer:
        hashes[k] = xxhash.xxh64_intdigest(text[starts[k] : starts[k] + sizes[k]].tobytes())
    return hashes


def _step(eights: np.ndarray, starts: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next eight bytes of each word, zeros after its end."""
    return eights[starts] & _MASKS[np.minimum(left, 8)]


def windows(hashes: np.ndarray, row: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all runs of ``length`` words of one row, and the place of each run's first word."""
    count = max(0, len(hashes) - length + 1)
    joined = hashes[:count].copy()
    for k in range(1, length):
        joined = joined * _ODD + hashes[k : k + count]
    whole = np.flatnonzero(row[:count] == row[length - 1 : length - 1 + count])
    return mixed(joined[whole]), whole


def row_starts(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's words start among all words, and where the last ends."""
    return np.searchsorted(row, np.arange(rows + 1))
