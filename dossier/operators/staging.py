"""Intermediate tables in the folder that the driver and all executors share."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Names the folder of the run that is on, if one is.
_RUN = "dossier.scratch.run"


def scratch_dir(spark: SparkSession, folder: str | None = None) -> str:
    """``folder``, else the folder named by ``spark.checkpoint.dir``, else the session's warehouse.

    The warehouse stands in only where every executor can see it: a folder on
    one machine's disk is refused unless the master is local.
    """
    folder = folder or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir", None) or ""
    shared = "://" in folder and not folder.startswith("file:")
    if not (shared or spark.sparkContext.master.startswith("local")) or not folder:
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A new path for an intermediate table, within the folder of the run that is on."""
    return f"{scratch_dir(spark, folder or spark.conf.get(_RUN, None))}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, folder: str | None = None, by: str | None = None) -> DataFrame:
    """``df`` written once and read back; in folders by the values of the column ``by``, if that is given.

    The copy survives lost executors, is not computed again by later uses, and
    has a known size, by which Spark decides whether to broadcast it.
    """
    path = scratch_path(df.sparkSession, name, folder)
    df.write.parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for the tables that are staged within the ``with`` block; they are gone after it.

    What is to outlast the block must be written elsewhere before its end.
    """
    path, before = f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}", spark.conf.get(_RUN, None)
    spark.conf.set(_RUN, path)
    try:
        yield path
    finally:
        if before is None:
            spark.conf.unset(_RUN)
        else:
            spark.conf.set(_RUN, before)
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
