"""Keys that repeat so often that their rows must not meet in one task."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.operators.staging import staged

MAX_REPEATS = 1_000
BUCKETS = 1 << 16

# How many tasks share the rows of a key, and which of them gets a row.
WIDTH = "_width"
SALT = "_salt"


class Repeats(NamedTuple):
    """The keys of more rows than one task is to hold, each with its ``WIDTH``; no table if there are none."""

    table: DataFrame | None = None


def find_repeats(rows: DataFrame, key: str, max_repeats: int = MAX_REPEATS) -> Repeats:
    """Keys of more than ``max_repeats`` rows, the null key included.

    Reads the key alone, and counts before the shuffle, so that a hot key costs
    no more than another. The table has at most rows/max_repeats rows.
    """
    if max_repeats < 1:
        raise ValueError(f"max_repeats must be at least 1, not {max_repeats}")
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    most = counts.agg(F.max("_rows")).first()[0]
    if most is None or most <= max_repeats:
        return Repeats()
    width = F.ceil(F.col("_rows") / F.lit(max_repeats)).cast("int").alias(WIDTH)
    return Repeats(staged(counts.where(F.col("_rows") > max_repeats).select(key, width), "repeats"))


def find_crowded(rows: DataFrame, key: str, most: int) -> Repeats:
    """``find_repeats`` for keys of very many rows, without the null key: few buckets of keys are counted first.

    Only the keys of buckets of more than ``most`` rows are counted one by one.
    """
    keys = rows.select(key).where(F.col(key).isNotNull())
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("_bucket")
    crowded = keys.groupBy(bucket).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > most)
    crowded = staged(crowded.select("_bucket"), "crowded")
    if crowded.isEmpty():
        return Repeats()
    return find_repeats(keys.select(key, bucket).join(crowded, "_bucket", "left_semi"), key, most)


def dealt_out(rows: DataFrame, key: str, repeats: DataFrame) -> DataFrame:
    """``rows`` with ``SALT``, below their key's width.

    Chosen by what a row holds, and by the task that reads it so that copies of
    one row spread too; a task that is run again chooses as before.
    """
    marks = repeats.withColumnRenamed(key, "_key")
    marked = rows.join(marks, F.col(key).eqNullSafe(F.col("_key")), "left")
    salt = F.pmod(
        F.xxhash64(*rows.columns, F.spark_partition_id()), F.coalesce(F.col(WIDTH), F.lit(1))
    )
    return marked.withColumn(SALT, salt.cast("int")).drop(WIDTH, "_key")


def for_each_salt(groups: DataFrame, key: str, repeats: DataFrame) -> DataFrame:
    """``groups``, one row for each key that is not null, repeated with every ``SALT`` of the key's rows.

    Joined by plain equality, which the groups' partitioning serves.
    """
    last = F.coalesce(F.col(WIDTH), F.lit(1)) - 1
    marked = groups.join(repeats, key, "left")
    return marked.withColumn(SALT, F.explode(F.sequence(F.lit(0), last))).drop(WIDTH)
