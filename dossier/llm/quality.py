"""Quality rules whose limits come from the corpus itself.

Each document is measured. Per language and source, every measure's values are
summed up in a quantile sketch: counts of values by logarithmic bucket, which
merge by adding, in any order, to the same result. To each group's sketch, of any
size, that of its language is added as so many documents, and to the language's
that of all documents; from the sum's quartiles follow the limits of the group.
Joined to their group's limits, documents beyond one are rejected.

Defined results: a null text has no words and all zero measures, and fails the
base rules; null languages and sources are groups like any other; repeated rows
are judged each by itself; an empty table has no limits and no rows.
"""

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dossier.llm.words import (
    LOWER,
    SPACE,
    mixed,
    per_row,
    slices,
    windows,
    word_hashes,
    words_of,
)
from dossier.operators.staging import staged

# The base rules and the symbols they count.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
REPEAT_WINDOW = 3
SYMBOLS = b"#*$%&|<>"

GROUP = ["lang", "source"]

# Measures with an upper limit, and the least distance between quartiles to assume of each:
# without it, a measure that is zero in most documents would allow no other value.
SPREADS = {
    "symbol_share": 0.02,
    "duplicate_line_share": 0.2,
    "repeated_word_share": 0.1,
    "capital_share": 0.05,
    "mean_word_length": 0.5,
}
# Of these measures, values far below the others are rejected as well.
TWO_SIDED = ("mean_word_length",)

# Values beyond a quartile by more than this many distances between quartiles are rejected.
REACH = 3.0
# So many documents of the wider group are added to each group.
PRIOR = 20.0

# The sketch: values within 1 % of each other, or within 0.001, share a bucket.
_GROWTH = math.log(1.01)
_SCALE = 1000.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_CAPITAL = LOWER != np.arange(256)
_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def _repeated_words(hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Per row, the words in windows that occur more than once in the row."""
    found, at = windows(hashes, row, REPEAT_WINDOW)
    found = mixed(found ^ mixed(row[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(found, kind="stable")
    equal = found[order[1:]] == found[order[:-1]]
    inside = np.zeros(len(hashes), bool)
    for k in range(REPEAT_WINDOW):
        inside[at[order[1:][equal]] + k] = True
        inside[at[order[:-1][equal]] + k] = True
    return np.bincount(row[inside], minlength=rows)


def _lines(part) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the lines with a word, and those of them that equal an earlier one."""
    text, offsets = part.data.tobytes(), part.offsets.tolist()
    total, repeated = np.zeros((2, part.rows), np.int64)
    for i in range(part.rows):
        lines = [x for x in text[offsets[i] : offsets[i + 1]].split(b"\n") if x.strip()]
        total[i], repeated[i] = len(lines), len(lines) - len(set(lines))
    return total, repeated


def _counts(text: pa.Array) -> pa.Array:
    columns = {name: [np.zeros(0, np.int64)] for name in _FIELDS}
    for part in slices(text):
        words = words_of(part)
        hashes = word_hashes(part.data, words)
        total, repeated = _lines(part)
        # All but the first byte of a UTF-8 character are 0x80 to 0xBF.
        first = (part.data & 0xC0) != 0x80
        columns["n_words"].append(np.bincount(words.row, minlength=part.rows))
        columns["word_chars"].append(per_row(part, first & ~SPACE[part.data]))
        columns["n_symbols"].append(per_row(part, _SYMBOL[part.data]))
        columns["n_dup_lines"].append(repeated)
        columns["n_repeat_words"].append(_repeated_words(hashes, words.row, part.rows))
        columns["n_lines"].append(total)
        columns["n_capitals"].append(per_row(part, _CAPITAL[part.data]))
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate(columns[name]), pa.int64()) for name in _FIELDS], _FIELDS
    )


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of the base rules, ``base_failed`` and the measures."""
    kind = "struct<" + ",".join(f"{name}:bigint" for name in _FIELDS) + ">"
    counted = docs.withColumn("_counts", F.arrow_udf(_counts, kind)(F.col(text)))
    counted = counted.withColumns({name: F.col(f"_counts.{name}") for name in _FIELDS})
    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    return counted.withColumns(
        {
            "symbol_share": _share("n_symbols", "word_chars"),
            "duplicate_line_share": _share("n_dup_lines", "n_lines"),
            "repeated_word_share": _share("n_repeat_words", "n_words"),
            "capital_share": _share("n_capitals", "word_chars"),
            "mean_word_length": _share("word_chars", "n_words"),
            "base_failed": (words < MIN_WORDS)
            | (100 * repeated > MAX_REPEATED_PERCENT * words),
        }
    ).drop("_counts")


def _bucket(value: Column) -> Column:
    return F.floor(F.log1p(value * _SCALE) / _GROWTH).cast("int")


def _value(bucket: Column) -> Column:
    return F.expm1((bucket + 0.5) * _GROWTH) / _SCALE


def sketch(measured: DataFrame) -> DataFrame:
    """Counts of values by language, source, measure and bucket; sketches merge by adding counts.

    Aggregated before the shuffle, to at most some two thousand rows for each
    group and measure and task, however many documents the group has.
    """
    values = F.array(
        *[F.struct(F.lit(name).alias("measure"), _bucket(F.col(name)).alias("bucket")) for name in SPREADS]
    )
    return (
        measured.where(F.col("n_words") > 0)
        .select(*GROUP, F.explode(values).alias("value"))
        .groupBy(*GROUP, "value.measure", "value.bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _quartiles(sketched: DataFrame, group: list[str]) -> DataFrame:
    """Per group and measure, the number of values and the first and third quartile."""
    merged = sketched.groupBy(*group, "measure", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*group, "measure")
    up_to = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumns({"total": F.sum("n").over(whole), "up_to": F.sum("n").over(up_to)})

    def quantile(share):
        return _value(F.min(F.when(F.col("up_to") >= share * F.col("total"), F.col("bucket"))))

    return ranked.groupBy(*group, "measure").agg(
        F.max("total").alias("total"),
        quantile(0.25).alias("low"),
        quantile(0.75).alias("high"),
    )


def _with_prior(sketched: DataFrame, group: list[str], wider: DataFrame, on: list[str], prior: float) -> DataFrame:
    """The sketch by ``group``, to which that of its wider group, by ``on``, is added as ``prior`` documents."""
    own = sketched.groupBy(*group, "measure", "bucket").agg(F.sum("n").cast("double").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(*on, "measure"))
    on = [*on, "measure"]
    shares = wider.select(*[F.col(c).alias(f"_{c}") for c in on], "bucket", (prior * F.col("n") / whole).alias("n"))
    groups = sketched.select(*group, "measure").distinct()
    match = reduce(lambda a, b: a & b, [groups[c].eqNullSafe(shares[f"_{c}"]) for c in on])
    return own.unionByName(groups.join(shares, match).select(*own.columns))


def _own_or_wider(sketched: DataFrame, min_group: int) -> DataFrame:
    """Each group's own quartiles, or if it has fewer documents than asked those of its language or of all."""
    own = _quartiles(sketched, GROUP)
    by_lang = _quartiles(sketched, GROUP[:1])
    overall = _quartiles(sketched, [])
    found = own
    for name, wider, on in (("lang", by_lang, ["lang", "measure"]), ("all", overall, ["measure"])):
        wider = wider.select(
            *[F.col(c).alias(f"_{c}") for c in on],
            *[F.col(c).alias(f"{name}_{c}") for c in ("total", "low", "high")],
        )
        match = reduce(lambda a, b: a & b, [found[c].eqNullSafe(wider[f"_{c}"]) for c in on])
        found = found.join(wider, match).drop(*[f"_{c}" for c in on])

    def chosen(column):
        return (
            F.when(F.col("total") >= min_group, F.col(column))
            .when(F.col("lang_total") >= min_group, F.col(f"lang_{column}"))
            .otherwise(F.col(f"all_{column}"))
        )

    return found.select(*GROUP, "measure", chosen("low").alias("low"), chosen("high").alias("high"))


def limits(
    sketched: DataFrame, min_group: int | None = None, reach: float = REACH, prior: float = PRIOR
) -> DataFrame:
    """Per language and source, ``<measure>_most`` and for some ``<measure>_least``.

    One row for each pair of language and source. With ``min_group``, nothing is
    added to a group, and one with fewer documents takes the limits of a wider one.
    """
    if min_group is not None:
        found = _own_or_wider(sketched, min_group)
    else:
        overall = sketched.groupBy("measure", "bucket").agg(F.sum("n").alias("n"))
        by_lang = _with_prior(sketched, GROUP[:1], overall, [], prior)
        by_lang = by_lang.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
        found = _quartiles(_with_prior(sketched, GROUP, by_lang, GROUP[:1], prior), GROUP)
    least = F.create_map(*[x for name, s in SPREADS.items() for x in (F.lit(name), F.lit(s))])
    distance = F.greatest(F.col("high") - F.col("low"), least[F.col("measure")]) * reach
    columns = []
    for name in SPREADS:
        mine = F.col("measure") == name
        columns.append(F.max(F.when(mine, F.col("high") + distance)).alias(f"{name}_most"))
        if name in TWO_SIDED:
            columns.append(F.max(F.when(mine, F.col("low") - distance)).alias(f"{name}_least"))
    return found.groupBy(*GROUP).agg(*columns)


def judge(measured: DataFrame, limited: DataFrame) -> DataFrame:
    """``measured`` with ``broken_rules``, the names of the rules a document breaks, and ``kept``."""
    limited = limited.withColumnsRenamed({c: f"_{c}" for c in limited.columns})
    match = reduce(lambda a, b: a & b, [measured[c].eqNullSafe(limited[f"_{c}"]) for c in GROUP])
    rules = [F.when(F.col("base_failed"), F.lit("base"))]
    for name in SPREADS:
        rules.append(F.when(F.col(name) > F.col(f"_{name}_most"), F.lit(f"{name}_high")))
        if name in TWO_SIDED:
            rules.append(F.when(F.col(name) < F.col(f"_{name}_least"), F.lit(f"{name}_low")))
    judged = measured.join(limited, match, "left").withColumn(
        "broken_rules", F.array_compact(F.array(*rules))
    )
    return judged.withColumn("kept", F.size("broken_rules") == 0).drop(*limited.columns)


def quality_verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document, without its text: counts, measures, ``broken_rules``, ``kept``.

    Texts are measured once; the narrow result is stored and read by the sketch
    and by the join.
    """
    measured = staged(
        measure(docs.select(key, F.col(text).alias("_text"), *GROUP), "_text").drop("_text"), "measures"
    )
    return judge(measured, _stored_limits(measured))


def _stored_limits(measured: DataFrame) -> DataFrame:
    return staged(limits(staged(sketch(measured), "sketch")), "limits")


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that break no rule, with the columns of ``docs``.

    Texts are measured twice rather than shuffled: the limits, a few numbers for
    each group, come to the documents.
    """
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_doc_{c}") for c in docs.columns])
    plain = plain.withColumns({c: F.col(f"_doc_{c}") for c in GROUP})
    measured = measure(plain, f"_doc_{text}")
    # Stored, as a filter on what is measured would have it measured once more.
    narrow = measure(docs.select(*GROUP, F.col(text).alias("_text")), "_text").drop("_text")
    judged = judge(measured, _stored_limits(staged(narrow, "measures")))
    return judged.where("kept").select(*[F.col(f"_doc_{c}").alias(c) for c in docs.columns])
