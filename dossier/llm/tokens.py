"""Token counts of whole texts, exactly as the tokenizer's library gives them.

Texts are cut into pre-tokens, whose numbers of tokens add up. Two tiers answer
for them, both on the worker: a table of the corpus's frequent pre-tokens, made
once and broadcast, and a cache of the pre-tokens met beside them, each encoded
once for a worker. Pre-tokens are never shuffled; to find the frequent ones,
every task sums up its texts in a list of bounded length. Only texts that hold a
special string, or a character that no version of Unicode up to Python's has, are
encoded whole.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted each; an empty table gives no rows.
"""

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Pre-tokens in the broadcast table, in a task's list, and in a worker's cache. These
# bound memory only: a pre-token that is in none of them is encoded again.
TABLE_SIZE = 1 << 16
TASK_SIZE = 1 << 13
CACHE_SIZE = 1 << 19

# Characters of which the library's and Python's rules are known to agree: white space,
# ASCII and the Latin letters up to U+017F, none of which composes with its neighbours or
# has a lower case beyond (but for I with a dot).
_SAFE = re.compile("[\t\n\x0b\x0c\r\x20-\x7e\xa0-\u012f\u0131-\u017f]*")
_LETTERS = "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d"
    f"|[{_LETTERS}]+|[{_NUMBERS}]"
    f"|[^\t\n\x0b\x0c\r\x20\xa0{_LETTERS}{_NUMBERS}]+"
)
# Other texts are normalised by the library, and then cut by the same pattern over all of Unicode.
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_ANY_PIECES = regex.compile(_SPLIT)


class PieceCounter(dict):
    """The numbers of tokens of pre-tokens, and by them of texts."""

    def __init__(self, tokenizer: str, frequent: dict[str, int], cache_size: int = CACHE_SIZE):
        super().__init__(frequent)
        self._tokenizer = Tokenizer.from_str(tokenizer)
        self._normalizer, self._known = self._tokenizer.normalizer, set()
        self._frequent = frequent
        self._most = len(frequent) + cache_size
        described = json.loads(tokenizer)
        # Special strings are found in the text as it stands, so none may be cut into pieces.
        self._special = re.compile(
            "|".join(re.escape(x["content"]) for x in described["added_tokens"]) or "(?!)"
        )

    def __missing__(self, piece: str) -> int:
        if len(self) >= self._most:
            self.clear()
            self.update(self._frequent)
        self[piece] = number = self.encoded(piece)
        return number

    def encoded(self, text: str) -> int:
        return len(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def pieces(self, text: str) -> list[str] | None:
        """The pre-tokens of a text; None if it must be encoded as a whole."""
        if self._special.search(text):
            return None
        if _SAFE.fullmatch(text):
            return _PIECES.findall(text.lower())
        plain = self._normalizer.normalize_str(text)
        return _ANY_PIECES.findall(plain) if self._are_known(plain) else None

    def _are_known(self, text: str) -> bool:
        """Whether all characters are ones of which both agree what they are: newer ones may be letters to one alone."""
        new = set(text).difference(self._known)
        if any(unicodedata.category(x) in ("Cn", "Cs") for x in new):
            return False
        self._known |= new
        return True

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = self.pieces(text)
        return self.encoded(text) if pieces is None else sum(map(self.__getitem__, pieces))


_counters: dict[str, PieceCounter] = {}


def _counter(shared) -> PieceCounter:
    """This worker's counter of a broadcast table, kept for the tasks to come."""
    name, tokenizer, frequent = shared.value
    if name not in _counters:
        _counters.clear()
        _counters[name] = PieceCounter(tokenizer, frequent)
    return _counters[name]


def _check(tokenizer: str) -> None:
    """Refuse a tokenizer whose pre-tokens are cut in another way than ``_PIECES`` does."""
    described = json.loads(tokenizer)
    steps = [x["type"] for x in described["normalizer"]["normalizers"]]
    split = described["pre_tokenizer"]["pretokenizers"][0]
    if steps != ["NFC", "Replace", "Lowercase"] or split["pattern"] != {"Regex": _SPLIT}:
        raise ValueError("the tokenizer normalises or cuts texts in an unknown way")


def frequent_pieces(texts: DataFrame, column: str, tokenizer: str, size: int, task_size: int) -> DataFrame:
    """The most frequent pre-tokens of all texts, at most ``size``, as column ``piece``.

    A task keeps count of twice ``task_size`` pre-tokens or more, halves its list
    when it is full, and hands on ``task_size``; so some rare ones are left out,
    which costs time and changes no result.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, counts = PieceCounter(tokenizer, {}), Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(counter.pieces(text.as_py() or "") or ())
                if len(counts) > 16 * task_size:
                    counts = Counter(dict(counts.most_common(8 * task_size)))
        top = counts.most_common(task_size)
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array([x for x, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())}
        )

    counted = texts.select(column).mapInArrow(summed, "piece string, n bigint")
    merged = counted.groupBy("piece").agg(F.sum("n").alias("n"))
    return merged.orderBy(F.desc("n"), "piece").limit(size).select("piece")


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    table_size: int = TABLE_SIZE,
    task_size: int = TASK_SIZE,
) -> DataFrame:
    """``docs`` with ``n_bytes`` and ``n_tokens`` of the column ``text``.

    The tokenizer is a file of the tokenizers library that lower-cases and drops
    white space; it is read on the driver and broadcast with the table.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = file.read()
    _check(tokenizer)
    spark: SparkSession = docs.sparkSession
    top = frequent_pieces(docs.select(text), text, tokenizer, table_size, task_size)
    pieces = [row.piece for row in top.collect()]  # at most table_size short strings
    counter = PieceCounter(tokenizer, {})
    shared = spark.sparkContext.broadcast(
        (str(hash((tokenizer, tuple(pieces)))), tokenizer, {x: counter.encoded(x) for x in pieces})
    )

    @F.arrow_udf("bigint")
    def tokens(texts: pa.Array) -> pa.Array:
        counter = _counter(shared)
        return pa.array([counter.count(x.as_py()) for x in texts], pa.int64())

    return docs.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"),
            "n_tokens": tokens(F.col(text)),
        }
    )
