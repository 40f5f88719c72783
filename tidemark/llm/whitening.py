"""Whitening of embeddings along their leading singular directions.

Rows are centred and reduced to one triangular factor by blockwise QR: each task
folds its rows into a factor, and factors are folded in groups of ``FOLD`` until
one is left. Its singular values and right singular vectors (``singular``) are
those of the centred table, so the covariance is never formed; squares of
small values are not lost in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import stored
from tidemark.llm.singular import right_singular
from tidemark.llm.vectors import finite, in_tasks, lists_of, scaled, usual_length

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
LARGEST = 1 << 40  # scaled entries beyond it count as this
BLOCK_ROWS = 4096  # of one QR
FOLD = 64  # triangular factors folded by one task
# Directions whose variance is below this share of the largest are rounding errors.
LEAST = 1e-18
LONGEST = 9.2e18  # what a long holds, about


@dataclass
class Whitening:
    """Count and sums of the fitted vectors, directions as columns, variances along them."""

    length: int
    rows: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / rows``, the whole part of the mean taken off exactly."""
        whole = np.array([s // self.rows for s in self.sums], np.int64)
        rest = np.array([s % self.rows / self.rows for s in self.sums])
        return (x - whole) - rest

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums over a row of ``(rows * x - sums) ** 2``; null where a long cannot hold it."""
        whole = np.array([s // self.rows for s in self.sums], np.int64)
        rest = np.array([s % self.rows for s in self.sums], np.int64)
        near = ((self.centred(x) * self.rows) ** 2).sum(axis=1)
        fits = near < LONGEST
        own = np.where(fits[:, None], x - whole, 0)
        exact = ((own * self.rows - rest * fits[:, None]) ** 2).sum(axis=1)
        return pa.array(exact, mask=~fits)


def _folded(blocks: Iterator[np.ndarray], length: int) -> np.ndarray:
    """The triangular factor of all rows of the blocks, square."""
    factor, held, rows = np.zeros((0, length)), [], 0
    for block in blocks:
        held.append(block)
        rows += len(block)
        if rows >= max(BLOCK_ROWS, 4 * length):
            factor, held, rows = np.linalg.qr(np.concatenate([factor, *held]), mode="r"), [], 0
    factor = np.linalg.qr(np.concatenate([factor, *held]), mode="r")
    return np.concatenate([factor, np.zeros((length - len(factor), length))])


def _sums(held: DataFrame, length: int, scale: int, shift: int) -> tuple[int, list[int]]:
    """Count and exact sums by dimension; a row for each task and dimension moves."""

    def work(batches):
        rows, sums = 0, np.zeros(length, np.int64)
        for batch in batches:
            x = scaled(batch.column(0), length, scale, LARGEST) + shift
            rows, sums = rows + len(x), sums + x.sum(axis=0)
        yield np.arange(-1, length, dtype=np.int32), np.append(rows, sums)

    parts = in_tasks(held, "whitening.sums", work, "place int, value bigint")
    wide = F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    found = {r["place"]: int(r["value"]) for r in parts.groupBy("place").agg(wide).collect()}
    return found[-1], [found[i] for i in range(length)]


def _factor(held: DataFrame, model: Whitening, scale: int, shift: int) -> np.ndarray:
    """The triangular factor of the centred table, folded in Spark down to one."""
    length = model.length

    def reduced(batches):
        blocks = (model.centred(scaled(b.column(0), length, scale, LARGEST) + shift) for b in batches)
        yield [[None], [_folded(blocks, length).tobytes()]]

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks = (np.frombuffer(f).reshape(length, length) for f in pdf.sort_values("part")["factor"])
        return pd.DataFrame({"part": [pdf["part"].min() // FOLD], "factor": [_folded(blocks, length).tobytes()]})

    schema = "part bigint, factor binary"
    factors = in_tasks(held, "whitening.factor", reduced, schema)
    factors = stored(factors.withColumn("part", F.spark_partition_id().cast("bigint")), "factors")
    parts = factors.agg(F.max("part")).first()[0] + 1
    while parts > 1:
        factors = factors.groupBy((F.col("part") / FOLD).cast("bigint").alias("fold"))
        factors = stored(factors.applyInPandas(merged, schema), "factors")
        parts = -(-parts // FOLD)
    return np.frombuffer(factors.first()["factor"]).reshape(length, length)


def fit_whitening(
    df: DataFrame,
    *,
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> Whitening | None:
    """Fit on all vectors of finite numbers, each entry taken as ``floor(scale * c) + shift``.

    Null vectors, those with a null or non-finite entry and those of another
    length than most are left out; None if no vector is left. Entries beyond
    ``LARGEST`` count as that. Repeated rows count each. Directions without
    variance are not among the components, so there may be fewer. The driver
    gets the sums and one triangular factor, both of the size of the vectors.
    """
    held = finite(df, vector_column)
    length = usual_length(held)
    if not length:
        return None
    held = held.filter(F.size("tm_vector") == length)
    rows, sums = _sums(held, length, scale, shift)
    model = Whitening(length, rows, sums, np.zeros((length, 0)), np.zeros(0), 0.0)
    squares, vectors = right_singular(_factor(held, model, scale, shift))
    real = int((squares[:components] > LEAST * squares[0]).sum()) if squares[0] > 0 else 0
    vectors = vectors[:, :real]
    signs = np.sign(np.take_along_axis(vectors, abs(vectors).argmax(axis=0)[None], axis=0))
    model.directions, model.variances = vectors * signs, squares[:real] / rows
    model.total = float(squares.sum() / rows)
    return model


def whiten(
    df: DataFrame,
    model: Whitening,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """Columns id, deviation, whitened (an array by component) of the vectors that can be fitted.

    Rows without a vector of finite numbers, or of another length, are left out;
    null and repeated ids stay as they are. An empty table gives no rows, and
    other columns are not read. No shuffle.
    """
    held = finite(df, vector_column, id_column).filter(F.size("tm_vector") == model.length)
    turn = model.directions / np.sqrt(model.variances)

    def work(batches):
        for batch in batches:
            x = scaled(batch.column(1), model.length, scale, LARGEST) + shift
            yield [batch.column(0), model.deviations(x), lists_of(model.centred(x) @ turn)]

    schema = f"`{id_column}` {held.dtypes[0][1]}, deviation bigint, whitened array<double>"
    return in_tasks(held, "whitening.whiten", work, schema)


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened vectors less the identity.

    Two passes of sums over the stored vectors: the means, then centred products.
    """
    k = len(model.variances)
    if not k:
        return 0.0
    entry = [F.col("whitened")[i] for i in range(k)]
    means = whitened.agg(*[F.sum(e) for e in entry]).first()
    centred = [e - F.lit(m / model.rows) for e, m in zip(entry, means)]
    places = [(i, j) for i in range(k) for j in range(i, k)]
    sums = whitened.agg(*[F.sum(centred[i] * centred[j]) for i, j in places]).first()
    return max(abs(s / model.rows - (i == j)) for s, (i, j) in zip(sums, places))


def whitened_components(
    df: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", **options
) -> DataFrame:
    """Columns id, component, n, deviation, whitened, explained, identity_error.

    A row for each vector of finite numbers and component, by falling variance
    from 1. Rows left out are those of ``fit_whitening``; without vectors, or if
    all are equal, there are no rows. The whitened vectors are written to the
    scratch folder, where their covariance is measured.
    """
    model = fit_whitening(df, vector_column=vector_column, **options)
    own = df.schema[id_column].dataType.simpleString()
    if model is None or not len(model.variances):
        schema = f"`{id_column}` {own}, component int, n bigint, deviation bigint, whitened double, "
        return df.sparkSession.createDataFrame([], schema + "explained double, identity_error double")
    settings = {k: v for k, v in options.items() if k in ("scale", "shift")}
    made = whiten(df, model, id_column=id_column, vector_column=vector_column, **settings)
    made = stored(made, "whitened")
    shares = F.array(*[F.lit(float(v / model.total)) for v in model.variances])
    error = identity_error(made, model)
    each = made.select(id_column, "deviation", F.posexplode("whitened").alias("tm_place", "tm_entry"))
    return each.select(
        id_column,
        (F.col("tm_place") + 1).cast("int").alias("component"),
        F.lit(model.rows).cast("long").alias("n"),
        "deviation",
        F.col("tm_entry").alias("whitened"),
        shares[F.col("tm_place")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
