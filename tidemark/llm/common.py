"""Helpers the operators share: Arrow batches of bounded size, ids, files of vocabularies."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache, lru_cache
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

import tidemark
from tidemark.session import configure

# Python works on at most this many bytes of text at a time, or on one row.
PIECE_BYTES = 8 * 1024**2
# Rows of one Arrow batch; long texts make a batch of the default 10,000 too large.
BATCH_ROWS = 1000


@cache
def _package() -> str:
    """This package as a zip file for the Python workers."""
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, True)
    root = Path(tidemark.__file__).parent
    with zipfile.ZipFile(f"{folder}/tidemark_code.zip", "w") as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    return f"{folder}/tidemark_code.zip"


@cache
def ship(application: str) -> None:
    """Let Spark send the package to the workers of the running application, once.

    Spark's file server hands the zip out, so no folder has to be shared.
    """
    SparkContext._active_spark_context.addPyFile(_package())


def prepared(spark: SparkSession) -> SparkSession:
    """``spark`` with Arrow batches of ``BATCH_ROWS`` rows and the package at its workers.

    Shuffle files of a query are removed when it ends, as what the next step
    needs of it is written to the scratch folder.
    """
    ship(spark.sparkContext.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The table ``documents`` of a folder; shuffles are sized by its files."""
    docs = prepared(spark).read.parquet(f"{folder}/documents.parquet")
    configure(spark, docs)
    return docs


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, the default of every ``path`` parameter."""
    return public_tokenizers.path(name)


def remainder(id_column: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(0)) % by


def ascii_lower(column: Column) -> Column:
    """Lower case of A to Z alone."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_caches: list[Callable] = []
_owner: list[str] = [""]


def kept(make: Callable) -> Callable:
    """``make`` with its last results kept in a Python worker until another operator runs there."""
    cached = lru_cache(maxsize=2)(make)
    _caches.append(cached.cache_clear)
    return cached


def turn(owner: str) -> None:
    """Tell the worker which operator runs; what others have kept in it is let go."""
    if owner != _owner[0]:
        _owner[0] = owner
        for clear in _caches:
            clear()
        pa.default_memory_pool().release_unused()


class Memo(dict):
    """Results by key, computed when first asked for; at most about ``2 * most`` are kept.

    When full, what is kept becomes the old half, from which a key that is
    asked for again comes back. Keys of 64 characters and more are not kept.
    """

    def __init__(self, work: Callable, most: int):
        self.work, self.most, self.old = work, most, {}

    def __missing__(self, key: str):
        if len(key) >= 64:
            return self.work(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        found = self.old.get(key)
        found = self[key] = self.work(key) if found is None else found
        return found


# Rows of a table of ids that are handed to all tasks; a larger one is shuffled.
BROADCAST_ROWS = 250_000


def restricted(df: DataFrame, some: DataFrame, on: str) -> DataFrame:
    """``df`` joined with the stored table ``some`` of its rows' keys and little else.

    Counted first: a small one is broadcast, which leaves ``df`` where it is.
    """
    return df.join(small(some), on)


def without(df: DataFrame, some: DataFrame, on: str) -> DataFrame:
    """``df`` without the rows whose key is in the stored table ``some``; null keys stay."""
    return df.join(small(some), on, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])


def small(some: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The stored table, to be broadcast if it has at most ``most`` rows."""
    return F.broadcast(some) if some.limit(most + 1).count() <= most else some


def pieces(batch: pa.RecordBatch, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``PIECE_BYTES`` in a text column, one row at least."""
    start, held = 0, 0
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    for row, size in enumerate(sizes):
        if held and held + (size or 0) > PIECE_BYTES:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def per_text(
    df: DataFrame,
    work: Callable[[list[str]], list],
    fields: list[StructField],
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[Column, ...] = (),
) -> DataFrame:
    """One row for each row of ``df``: its id, ``keep``, and the columns ``work`` makes.

    ``work`` gets a list of texts, null being empty, and gives one list or
    array for each of ``fields``. It runs inside the tasks, without a shuffle.
    """
    ship(df.sparkSession.sparkContext.applicationId)
    source = df.select(id_column, F.coalesce(text_column, F.lit("")).alias("tm_source"), *keep)
    own = [f for f in source.schema.fields if f.name != "tm_source"]
    schema = StructType([*own, *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn(f"{work.__module__}.{work.__qualname__}")
        for batch in batches:
            for piece in pieces(batch):
                made = work(piece.column(1).to_pylist())
                columns = [piece.column(0), *piece.columns[2:], *made]
                yield pa.RecordBatch.from_arrays(
                    [
                        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                        for c, f in zip(columns, arrow)
                    ],
                    schema=arrow,
                )

    return source.mapInArrow(run, schema)
