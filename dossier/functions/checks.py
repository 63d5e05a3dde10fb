"""Row checks that fail the job."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("strict", "lenient")


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def require(df: DataFrame, ok: Column, message: Column) -> DataFrame:
    """All rows of ``df``; the job fails on the first row that is not ``ok``.

    The check is a filter because a check inside a column disappears whenever
    that column is not read, for instance under ``count()``. It also compares
    the partition's number with itself, which Spark takes for a value that may
    change: so it neither moves the check below a join, to rows the join would
    drop, nor runs other filters first, which would hide rows from it, and what
    the check reads is computed once.
    """
    here = F.spark_partition_id()
    passed = F.when(ok & (F.col("_here") == here), F.lit(True))
    return (
        df.withColumn("_here", here)
        .where(passed.otherwise(F.raise_error(message).cast("boolean")))
        .drop("_here")
    )
