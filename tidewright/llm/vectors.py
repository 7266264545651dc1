"""Vector columns: which rows take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A vector column v takes part when it is neither null nor empty and all components are finite numbers.
USABLE = "coalesce(size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')), false)"


def components(df: DataFrame, embedding: str) -> str:
    """float or double: the type that holds the components of a vector column as they are."""
    kind = df.schema[embedding].dataType
    return "float" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "double"


def usable(df: DataFrame, vec_id: str, embedding: str, *more: Column) -> DataFrame:
    """(vec_id, v, more...) of rows whose id is not null and whose vector takes part."""
    v = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast(f"array<{components(df, embedding)}>").alias("v"), *more)
    return v.where("vec_id is not null").where(USABLE)


def lengths(df: DataFrame) -> list[int]:
    """The vector lengths that occur; vectors of different lengths have nothing to do with each other."""
    return sorted(r[0] for r in df.select(F.size("v")).distinct().collect())


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column, all of one length, as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
