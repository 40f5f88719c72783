"""Vector code compression: a codebook for each part of the vectors, by exact rounds over trees.

Vectors are cut into equal parts; a part's codebook is improved by rounds that
assign all parts to their nearest entry and move each entry to the mean of its
parts, all in whole numbers. A task builds a metric tree (``anchor_trees``) for
each part of a block of its vectors once; the blocks are stored and every round
goes over the trees, where most parts are counted by whole balls.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import anchor_trees
from tidemark.llm.components import stored
from tidemark.llm.vectors import finite, in_tasks, scaled, usual_length

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
LARGEST = 1 << 28  # scaled components beyond it count as this
BLOCK_ROWS = 4096
BLOCK_NUMBERS = 1 << 19  # in a block of long vectors


def _parts(rows: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(rows, parts, axis=1)


def _blocks(held: DataFrame, length: int, parts: int, scale: int) -> DataFrame:
    """A row for each block of vectors: ids, labels, numbers, and the tree of each part."""
    most = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // length))

    def block(batches: list[pa.RecordBatch]) -> list:
        rows = np.concatenate([scaled(b.column(2), length, scale, LARGEST) for b in batches])
        carried = [pa.concat_arrays([b.column(i) for b in batches]) for i in (0, 1)]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), c) for c in carried]
        trees = [anchor_trees.build(p).dumps() for p in _parts(rows, parts)]
        return [*lists, [rows.astype(np.int32).tobytes()], [trees]]

    def work(batches):
        waiting, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, most - rows)
                waiting.append(taken)
                rows += taken.num_rows
                batch = batch.slice(taken.num_rows)
                if rows == most:
                    yield block(waiting)
                    waiting, rows = [], 0
        if waiting:
            yield block(waiting)

    own = [t for _, t in held.dtypes[:2]]
    schema = f"ids array<{own[0]}>, labels array<{own[1]}>, numbers binary, trees array<binary>"
    return in_tasks(held, "part_codes.blocks", work, schema)


def _opened(batch: pa.RecordBatch, row: int, at: int, length: int, parts: int):
    """(points, tree) of each part of a stored block."""
    numbers = np.frombuffer(batch.column(at)[row].as_py(), np.int32).reshape(-1, length)
    trees = batch.column(at + 1)[row].as_py()
    for points, tree in zip(_parts(numbers.astype(np.int64), parts), trees):
        yield points, anchor_trees.Tree.loads(tree)


def _improved(blocks: DataFrame, books: np.ndarray, length: int) -> np.ndarray:
    """The codebooks after one round; sums of each task, one row a number, are added up in Spark."""
    parts, entries, width = books.shape

    def work(batches):
        found = np.zeros((parts, entries, 1 + width), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for p, (points, tree) in enumerate(_opened(batch, row, 0, length, parts)):
                    found[p] += anchor_trees.totals(tree, points, books[p])
        yield np.arange(found.size, dtype=np.int32), found.ravel()

    each = in_tasks(blocks.select("numbers", "trees"), "part_codes.round", work, "place int, value bigint")
    total = F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    sums = np.zeros(parts * entries * (1 + width), object)
    for r in each.groupBy("place").agg(total).collect():
        sums[r["place"]] = int(r["value"])
    sums = sums.reshape(parts, entries, 1 + width)
    counts, moved = sums[..., :1], sums[..., 1:]
    used = (counts > 0) & np.ones(width, bool)
    return np.where(used, moved // np.where(counts > 0, counts, 1), books).astype(np.int64)


def _codes(blocks: DataFrame, books: np.ndarray, length: int) -> DataFrame:
    """Columns tm_id, tm_label, code, error of all vectors in the blocks."""
    parts, _, _ = books.shape

    def work(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = (batch.column(i).slice(row, 1).flatten() for i in (0, 1))
                codes, error = [], np.zeros(len(ids), np.int64)
                for p, (points, tree) in enumerate(_opened(batch, row, 2, length, parts)):
                    own = anchor_trees.nearest(tree, points, books[p])
                    error += ((points - books[p][own]) ** 2).sum(axis=1)
                    codes.append(own)
                digits = np.stack(codes, axis=1).astype(np.uint8)
                yield [ids, labels, [r.tobytes().hex() for r in digits], error]

    types = [t[len("array<") : -1] for _, t in blocks.dtypes[:2]]
    schema = f"tm_id {types[0]}, tm_label {types[1]}, code string, error bigint"
    return in_tasks(blocks, "part_codes.codes", work, schema)


def part_codes(
    df: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """Columns id, code, error, label_error, codebooks_sha256 of all vectors of finite numbers.

    Each component counts as ``floor(scale * x)``. A codebook starts as the
    parts of the ``entries`` (256 at most) smallest ids, null last, equal ids by
    their vectors; with fewer vectors it is shorter. Rows are left out if the
    vector is null, has a null or non-finite component, is empty, or has not the
    length most others have, which ``parts`` must divide. Repeated rows and null
    ids stay; null labels are one label. An empty table gives no rows. Other
    columns are not read. The driver gets the codebooks and their sums.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    own = [F.col(f"`{c}`") for c in (id_column, label_column)]
    named = df.select(own[0].alias("tm_id"), own[1].alias("tm_label"), F.col(f"`{vector_column}`").alias("v"))
    held = finite(named, "v", "tm_id", "tm_label")
    length = usual_length(held)
    kind = df.schema[id_column].dataType.simpleString()
    if not length:
        schema = f"`{id_column}` {kind}, code string, error bigint, label_error bigint, codebooks_sha256 string"
        return df.sparkSession.createDataFrame([], schema)
    if length % parts:
        raise ValueError(f"vectors of length {length} have no {parts} equal parts")
    held = held.filter(F.size("tm_vector") == length)
    first = held.orderBy(F.col("tm_id").asc_nulls_last(), "tm_vector").limit(entries).collect()
    start = pa.array([r["tm_vector"] for r in first], pa.list_(pa.float64()))
    books = np.stack(_parts(scaled(start, length, scale, LARGEST), parts))
    blocks = stored(_blocks(held, length, parts, scale), "blocks")
    for _ in range(rounds):
        books = _improved(blocks, books, length)
    made = stored(_codes(blocks, books, length), "codes")
    sums = made.groupBy(F.col("tm_label").alias("tm_of")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return made.join(sums, F.col("tm_label").eqNullSafe(F.col("tm_of"))).select(
        F.col("tm_id").alias(id_column),
        "code",
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )
