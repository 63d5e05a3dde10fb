"""Reading the tables of training text, and keys that may be null."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.words import WORD


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """The number of words as an expression; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def own(column: str) -> str:
    """The name of a user's column among those of a computation, none of which begins so."""
    return f"_doc_{column}"


def apart(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns renamed by ``own``, so that no column of a computation can clash with them."""
    return docs.select(*[F.col(f"`{c}`").alias(own(c)) for c in docs.columns])


def together(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` under their names again, for rows that came ``apart``."""
    return [F.col(f"`{own(c)}`").alias(c) for c in docs.columns]


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Whether all columns are equal or both null."""
    return reduce(
        lambda a, b: a & b, [left[column].eqNullSafe(right[column]) for column in columns]
    )
