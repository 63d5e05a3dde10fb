"""Tables of vectors: which rows are whole, and batches as matrices."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is not null and holds finite numbers only; ``vector`` becomes array<double>."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    doubles = rows.withColumn(vector, F.col(vector).cast("array<double>"))
    return doubles.where(F.col(vector).isNotNull() & finite)


def vector_length(rows: DataFrame, vector: str) -> int | None:
    """How many components all vectors have; None without rows. Vectors of different lengths are an error."""
    size = F.size(vector)
    least, most = rows.agg(F.min(size), F.max(size)).first()
    if least != most:
        raise ValueError(f"vectors must have one length, not {least} to {most} components")
    return least


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A batch of vectors as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), length)
