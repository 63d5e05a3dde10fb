"""Stages that are there as a whole or not at all.

A stage is a folder. Its rows are written to a new folder inside, and count once a
manifest names that folder: a small file ``_manifest-N.json``, the one with the largest
N being current. So a reader never sees half a stage, neither while it is written
nor after a writer was lost, on any store that makes a whole file appear at once.
The stage before stays until the next one but one, for those who still read it.

A manifest also holds a fingerprint of what the stage was made from, counts that were
taken while it was written, its schema, and the buckets that its rows are in.
"""

import hashlib
import json
import re
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_NAME = re.compile(r"_manifest-([0-9]{8})\.json")


class Manifest(NamedTuple):
    """What there is to know of a stage."""

    data: str
    fingerprint: str | None = None
    key: str | None = None
    buckets: int | None = None
    counts: dict[str, int] = {}
    schema: str | None = None


def _store(spark: SparkSession, path: str):
    """The file system that has ``path``, and ``path`` for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all manifests of a stage, in order."""
    files, place = _store(spark, path)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(found[1]) for name in names if (found := _NAME.fullmatch(name)))


def _file(path: str, number: int) -> str:
    return f"{path}/_manifest-{number:08}.json"


def _read(spark: SparkSession, path: str, number: int) -> Manifest:
    files, place = _store(spark, _file(path, number))
    stream = files.open(place)
    try:
        return Manifest(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The current manifest of a stage; None if none was ever committed."""
    numbers = _numbers(spark, path.rstrip("/"))
    return _read(spark, path.rstrip("/"), numbers[-1]) if numbers else None


def _publish(spark: SparkSession, path: str, number: int, manifest: Manifest) -> None:
    """Make ``manifest`` current: written under another name first, as a rename cannot be half done."""
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    files, place = _store(spark, draft)
    stream = files.create(place, False)
    stream.write(bytearray(json.dumps(manifest._asdict()).encode()))
    stream.close()
    if not files.rename(place, _store(spark, _file(path, number))[1]):
        files.delete(place, False)
        raise RuntimeError(f"another run has committed {path}")


def _forget(spark: SparkSession, path: str, number: int) -> None:
    """Delete a stage that is no longer current, its manifest first."""
    data = _read(spark, path, number).data
    for name in (_file(path, number), f"{path}/{data}"):
        files, place = _store(spark, name)
        files.delete(place, True)


def commit_stage(
    df: DataFrame,
    path: str,
    fingerprint: str | None = None,
    key: str | None = None,
    buckets: int | None = None,
    counts: dict[str, Column] | None = None,
    split_by: str | None = None,
    options: dict[str, str] | None = None,
) -> Manifest:
    """Write ``df`` as the current stage at ``path``; rows go to ``buckets`` by ``key``, if there are any.

    With ``split_by``, a column of few values, rows of each value have a folder.
    ``options`` are those of Spark's Parquet writer.

    ``counts`` are aggregates, taken of the rows as they are written: ``rows`` is
    always among them. Parquet files of a bucket are sorted by ``key``.
    """
    path, spark = path.rstrip("/"), df.sparkSession
    manifest = Manifest(f"data-{uuid.uuid4().hex}", fingerprint, key if buckets else None, buckets, schema=df.schema.json())
    seen = Observation()
    given = {"rows": F.count(F.lit(1)), **(counts or {})}
    if buckets:
        df = df.repartition(buckets, key)
    # The last thing before the write: tasks of the writing stage count once, even if they run again.
    writer = df.observe(seen, *[c.alias(name) for name, c in given.items()]).write.options(**(options or {}))
    if buckets:
        table = f"stage_{uuid.uuid4().hex}"
        writer = writer.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/{manifest.data}")
        writer.format("parquet").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay: the manifest is what finds them
    else:
        (writer.partitionBy(split_by) if split_by else writer).parquet(f"{path}/{manifest.data}")
    numbers = _numbers(spark, path)
    manifest = manifest._replace(counts=seen.get)
    _publish(spark, path, numbers[-1] + 1 if numbers else 1, manifest)
    for number in numbers[:-1]:
        _forget(spark, path, number)
    return manifest


def _bucketed(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """Files as a table that is known to be in buckets. The table's name is gone again once the rows are bound."""
    table = f"stage_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    try:
        return spark.table(table).select("*")
    finally:
        spark.sql(f"DROP TABLE {table}")


def open_stage(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a committed stage, or of a folder of Parquet files that has no manifest."""
    path = path.rstrip("/")
    manifest = read_manifest(spark, path)
    if manifest is None:
        return spark.read.parquet(path)
    schema = StructType.fromJson(json.loads(manifest.schema))
    if manifest.buckets is None:
        return spark.read.schema(schema).parquet(f"{path}/{manifest.data}")
    return _bucketed(spark, f"{path}/{manifest.data}", schema, manifest.key, manifest.buckets)


def is_made_from(spark: SparkSession, path: str, fingerprint: str | None) -> bool:
    """Whether the stage at ``path`` was made from just that; never if there is no fingerprint."""
    if fingerprint is None:
        return False
    manifest = read_manifest(spark, path)
    return manifest is not None and manifest.fingerprint == fingerprint


def _files(spark: SparkSession, plan) -> str | None:
    """All files that a plan reads, with sizes and times; None if it reads anything else.

    None too if it runs code of its user, or depends on the time of its run.
    """
    kinds = spark._jvm.org.apache.spark.sql.catalyst.trees.TreePattern
    for kind in (kinds.PYTHON_UDF(), kinds.SCALA_UDF(), kinds.PLAN_EXPRESSION(), kinds.CURRENT_LIKE()):
        if plan.containsPattern(kind):
            return None
    found, leaves = [], plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            return None
        relation = leaf.relation()
        if relation.getClass().getSimpleName() != "HadoopFsRelation":
            return None
        found.append(re.sub(r"access_time=\d+", "", relation.location().allFiles().toString()))
    return "\n".join(found)


def fingerprint(inputs: list[DataFrame], *options) -> str | None:
    """A digest of the files that ``inputs`` read, of what is done to them, and of ``options``.

    None if an input is not made of files by plain expressions alone: nothing then
    says whether two of its kind are the same.
    """
    spark, digest = inputs[0].sparkSession, hashlib.sha256(json.dumps(options).encode())
    width = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(width)
    spark.conf.set(width, str((1 << 31) - 1))
    try:
        for df in inputs:
            plan = df._jdf.queryExecution().analyzed()
            files = _files(spark, plan)
            if files is None:
                return None
            digest.update(re.sub(r"#\d+L?", "", plan.toString()).encode() + files.encode())
    finally:
        spark.conf.set(width, before)
    return digest.hexdigest()


def refuse_own_input(df: DataFrame, path: str) -> None:
    """An error if ``df`` reads files below ``path``, which overwriting would delete before they are read."""
    files, place = _store(df.sparkSession, path.rstrip("/"))
    own = files.makeQualified(place).toUri().getPath()
    for name in df.inputFiles():
        given = df.sparkSession._jvm.org.apache.hadoop.fs.Path(name).toUri().getPath()
        if given.startswith(f"{own}/") or given == own:
            raise ValueError(f"{path} is read from: it cannot be overwritten")
