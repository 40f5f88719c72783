"""Vectors of finite numbers, as whole numbers, for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import prepared, ship, turn
from tidemark.session import configure


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """The table ``embeddings`` of a folder; shuffles are sized by its files."""
    vectors = prepared(configure(spark)).read.parquet(f"{folder}/embeddings.parquet")
    configure(spark, vectors)
    return vectors


def finite(df: DataFrame, vector_column: str, *columns: str) -> DataFrame:
    """``columns`` and the vector as ``tm_vector``, of rows whose entries are all finite numbers."""
    own = [F.col(f"`{c}`") for c in columns]
    vector = F.col(f"`{vector_column}`")
    infinite = F.lit(float("inf"))
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return df.select(*own, vector.alias("tm_vector")).filter(vector.isNotNull() & good)


def usual_length(held: DataFrame) -> int:
    """The length most vectors have, the larger one of several; 0 without vectors."""
    sizes = held.groupBy(F.size("tm_vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return found["size"] if found else 0


def scaled(column: pa.Array, length: int, scale: int, largest: int) -> np.ndarray:
    """floor(scale * x) of a column of vectors, a row each; ``scale`` is a power of two.

    What is beyond ``largest`` is taken for it, so that products stay within 64 bits.
    """
    flat = np.asarray(column.flatten(), dtype=np.float64)
    flat = np.clip(flat, -largest / scale, largest / scale) * scale
    return np.floor(flat).astype(np.int64).reshape(-1, length)


def in_tasks(
    df: DataFrame, owner: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[list]], schema: str
) -> DataFrame:
    """``df.mapInArrow`` of a function that yields lists of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession.sparkContext.applicationId)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn(owner)
        for columns in work(b for b in batches if b.num_rows):
            made = [
                c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                for c, f in zip(columns, arrow)
            ]
            yield pa.RecordBatch.from_arrays(made, schema=arrow)

    return df.mapInArrow(run, schema)


def lists_of(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as an Arrow column of lists."""
    width = rows.shape[1]
    offsets = np.arange(0, rows.size + 1, width, dtype=np.int32) if width else None
    if offsets is None:
        return pa.array([[]] * len(rows), type=pa.list_(pa.from_numpy_dtype(rows.dtype)))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(rows).ravel()))
