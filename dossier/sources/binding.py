"""Binding a DataFrame to a declared record type by column name."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, StructType


def _faults(
    actual: DataType, wanted: DataType, fold: Callable[[str], str], at: str = ""
) -> tuple[list[str], list[str]]:
    """The paths of fields that ``actual`` lacks, and of those that it has more than once."""
    if isinstance(wanted, ArrayType) and isinstance(actual, ArrayType):
        return _faults(actual.elementType, wanted.elementType, fold, at)
    missing: list[str] = []
    ambiguous: list[str] = []
    if not (isinstance(wanted, StructType) and isinstance(actual, StructType)):
        return missing, ambiguous
    for field in wanted.fields:
        path = f"{at}.{field.name}" if at else field.name
        found = [f for f in actual.fields if fold(f.name) == fold(field.name)]
        if len(found) == 1:
            for paths, more in zip(
                (missing, ambiguous),
                _faults(found[0].dataType, field.dataType, fold, path),
                strict=True,
            ):
                paths += more
        else:
            (ambiguous if found else missing).append(path)
    return missing, ambiguous


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the fields of ``schema``, found by name, in its order.

    Names are told apart by case only if ``spark.sql.caseSensitive`` says so, at
    any depth. Other columns are dropped. A field that is missing or that two
    columns could be is an error: ``DataFrame.to`` alone would fill it with nulls.
    """
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    missing, ambiguous = _faults(df.schema, schema, str if exact else str.lower)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if ambiguous:
        raise ValueError(f"ambiguous columns: {', '.join(ambiguous)}")
    wanted = schema.simpleString()
    if df.columns != schema.names and set(schema.names) <= set(df.columns):
        df = df.select(schema.names)
    # to() would rebuild every array only to change what may be null in it.
    return df if df.schema.simpleString() == wanted else df.to(schema)
