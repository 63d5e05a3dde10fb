"""Child rows as arrays of structs on their parents: one row and one array for each parent row."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from dossier.functions.checks import require
from dossier.operators.repeats import (
    MAX_REPEATS,
    SALT,
    Repeats,
    dealt_out,
    find_repeats,
    for_each_salt,
)

# A row holds at most 2 GB, and an array in the making is in memory up to four times, beside other tasks' arrays.
MAX_ARRAY_BYTES = 1 << 30
HEAP_SHARE = 8

_UNITS = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


class Children(NamedTuple):
    """Child rows, and how they are to be nested into the array ``as_col`` of ``fields``.

    ``totals`` are aggregates over all children of a parent, null without
    children. ``finish`` adds columns to single rows; it runs after the shuffle,
    which then moves only the raw columns.
    """

    rows: DataFrame
    as_col: str
    fields: list[str]
    totals: dict[str, Column] = {}
    finish: Callable[[DataFrame], DataFrame] | None = None


def _bytes(rows: DataFrame, children: Children) -> Column:
    """The size of a record in an array, about: 8 bytes a field, texts besides, and what a record costs in memory.

    What ``finish`` makes of texts counts as much as the texts.
    """
    size = F.lit(64 + 8 * len(children.fields)).cast("bigint")
    for name in children.fields:
        if name in rows.columns and isinstance(rows.schema[name].dataType, StringType):
            size += F.coalesce(F.octet_length(name), F.lit(0)) * (1 if children.finish is None else 2)
    return size


def array_limit(spark: SparkSession) -> int:
    """The most bytes that an array may have on this session's executors."""
    context = spark.sparkContext
    if context.master.startswith("local"):
        heap = context._jvm.java.lang.Runtime.getRuntime().maxMemory()
    else:
        size = context.getConf().get("spark.executor.memory", "1g").lower().removesuffix("b")
        heap = int(size[:-1]) * _UNITS[size[-1]] if size[-1] in _UNITS else int(size) << 20
    return min(MAX_ARRAY_BYTES, heap // HEAP_SHARE)


def _fitting(rows: DataFrame, children: Children, key: str, max_bytes: int) -> DataFrame:
    """``rows`` of children, shuffled by ``key``; the job fails by name on a key whose records take more than ``max_bytes``.

    The window adds up a key's records before it hands on the first of them, and keeps
    them on disk meanwhile where they are many. So no record of a key that is too
    large ever reaches the array.
    """
    size = F.sum(_bytes(rows, children)).over(Window.partitionBy(key))
    message = F.concat(
        F.lit(f"{children.as_col} of "),
        F.col(key).cast("string"),
        F.lit(" do not fit one row; build_document_parts splits them"),
    )
    return require(rows.withColumn("_size", size), F.col("_size") <= max_bytes, message).drop("_size")


def nest_children(
    children: Children, key: str, max_bytes: int | None = None, partitions: int | None = None
) -> DataFrame:
    """One row per key: the sorted array of whole records, and the totals.

    Children without a key can never be attached and are left out. A key whose
    array would be too large for a row, or for an executor, fails the job by name
    before its array is begun.

    Rows are shuffled first and grouped once, rather than on both sides of the
    shuffle, as collecting does not make them fewer.
    """
    rows = children.rows.where(F.col(key).isNotNull())
    shuffled = rows.repartition(partitions, key) if partitions else rows.repartition(key)
    if max_bytes is None:
        max_bytes = array_limit(rows.sparkSession)
    ready = _fitting(shuffled, children, key, max_bytes)
    if children.finish is not None:
        ready = children.finish(ready)
    records = F.sort_array(F.collect_list(F.struct(*children.fields)))
    return ready.groupBy(key).agg(
        records.alias(children.as_col), *[c.alias(name) for name, c in children.totals.items()]
    )


def attach_children(
    parents: DataFrame,
    key: str,
    kinds: list[Children],
    repeats: Repeats | None = None,
    max_repeats: int = MAX_REPEATS,
    max_bytes: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Every row of ``parents`` with its children, one array per kind, empty if it has none.

    Children are grouped first and joined second, so that repeated parents
    neither merge nor count children twice. All joins share one partitioning.

    Parent keys of more than ``max_repeats`` rows come from a count of the
    parents' keys, unless ``repeats`` has them from ``find_repeats``. Their rows are
    dealt out over several tasks, each of which gets a copy of the key's children;
    so are rows without a key, which match nothing. Children are not counted.

    Children are dealt to ``partitions`` tasks, where it is given: parents that are
    stored in as many buckets of ``key`` then meet them as they are.
    """
    if repeats is None:
        repeats = find_repeats(parents, key, max_repeats)
    nested = [nest_children(children, key, max_bytes, partitions) for children in kinds]
    if repeats.table is None:
        on, attached = [key], parents
    else:
        on, attached = [key, SALT], dealt_out(parents, key, repeats.table)
        nested = [for_each_salt(groups, key, repeats.table) for groups in nested]
    for children, groups in zip(kinds, nested, strict=True):
        empty = F.array().cast(groups.schema[children.as_col].dataType)
        attached = attached.join(groups, on, "left").withColumn(
            children.as_col, F.coalesce(children.as_col, empty)
        )
    totals = [name for children in kinds for name in children.totals]
    return attached.select(*parents.columns, *[children.as_col for children in kinds], *totals)
