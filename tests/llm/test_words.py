import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from dossier.llm.words import slices, windows, word_hashes, words_of

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b 😀-", max_size=30)), max_size=12)


def found(texts, size=1 << 20, lower=False):
    """Words and hashes by row, as the numpy code finds them."""
    by_row = [[] for _ in texts]
    for part in slices(pa.array(texts, pa.string()), size):
        words = words_of(part)
        hashes = word_hashes(part.data, words, lower)
        for a, b, row, h in zip(words.starts, words.ends, words.row, hashes, strict=True):
            by_row[part.first + row].append((part.data[a:b].tobytes(), int(h)))
    return by_row


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_words_are_those_of_bytes_split(texts, size):
    assert [[w for w, _ in row] for row in found(texts, size)] == [(t or "").encode().split() for t in texts]


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.sampled_from([3, 1 << 20]))
def test_equal_words_have_equal_hashes_wherever_they_stand(texts, size):
    seen = {}
    for row in found(texts, size) + found(list(reversed(texts))):
        for word, h in row:
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_lower_folds_ascii_only():
    (row,) = found(["Ab aB É é"], lower=True)
    hashes = [h for _, h in row]
    assert hashes[0] == hashes[1] and hashes[2] != hashes[3]


def test_long_words_are_hashed_whole():
    long = "x" * 5000
    (row,) = found([f"{long}a {long}b a {long}a"])
    hashes = [h for _, h in row]
    assert hashes[0] == hashes[3] and len(set(hashes)) == 3


def test_a_huge_text_stands_alone():
    texts = ["a b", "c " * 400_000, None, "d"]
    assert [len(r) for r in found(texts, 1 << 10)] == [2, 400_000, 0, 1]


def test_sliced_columns():
    column = pa.array(["a", "b c", None, "d"], pa.string())[1:]
    parts = list(slices(column))
    assert [p.rows for p in parts] == [3] and bytes(parts[0].data) == b"b cd"


def test_windows_stay_in_their_row():
    hashes = np.arange(1, 8, dtype=np.uint64)
    runs, at = windows(hashes, np.array([0, 0, 0, 1, 1, 2, 2]), 3)
    assert at.tolist() == [0] and len(runs) == 1
    assert windows(hashes[:2], np.array([0, 0]), 3)[1].tolist() == []
