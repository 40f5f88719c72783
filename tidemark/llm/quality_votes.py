"""Quality scores by votes of labelled neighbours among latent-semantic vectors.

A text becomes counts of hashed features: byte n-grams of the text and of its
shape (letters, capitals, digits, spaces and signs), and how often its words
repeat. They are damped, weighted by rarity and projected on the leading
singular vectors of the labelled sample. The labelled vectors are broadcast;
every document is multiplied with all of them in blocks, exactly, and the
nearest vote for their label, weighted by a power of the cosine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField

from tidemark.llm.common import per_text
from tidemark.llm.grams import class_sample, gram_buckets

BITS = 10  # buckets of each kind of feature, as a power of two
LABELLED = 2000  # vectors of each label
LATENT = 48  # dimensions
NEIGHBOURS = 25
POWER = 4.0
THRESHOLD = 0.3
ROWS = 256  # of a matrix product
# Vectors are whole numbers of this unit, so that sums of their products are exact in any order.
UNIT = 2.0**-11

# Kind of each byte: other sign, space, digit, capital, small letter, beyond ASCII.
KINDS = np.zeros(256, np.uint8)
KINDS[[9, 10, 13, 32]] = 1
KINDS[48:58] = 2
KINDS[65:91] = 3
KINDS[97:123] = 4
KINDS[128:] = 5
SHAPES = 6**4
WIDTH = 2 * (1 << BITS) + SHAPES + 64


def features(text: str) -> np.ndarray:
    """Damped shares of the features of one text."""
    data = np.frombuffer(text.encode(), np.uint8)
    out = np.zeros(WIDTH, np.float32)
    if not len(data):
        return out
    size, at = 1 << BITS, 0
    for order in (1, 3):
        out[at : at + size] = np.bincount(gram_buckets(data, order, BITS), minlength=size)
        at += size
    kinds = KINDS[data].astype(np.int32)
    if len(kinds) >= 4:
        shape = ((kinds[:-3] * 6 + kinds[1:-2]) * 6 + kinds[2:-1]) * 6 + kinds[3:]
        out[at : at + SHAPES] = np.bincount(shape, minlength=SHAPES)
    at += SHAPES
    words = text.split()
    again = int(63 * (1 - len(set(words)) / len(words))) if words else 0
    scale = 1000.0 / len(data)  # shares of the text, so length does not matter
    out[:at] = np.log1p(out[:at] * scale)
    out[at + again] = 4.0
    return out


@dataclass
class QualityModel:
    """Projection, labelled vectors and their labels; the share of good ones if alone."""

    prior: float
    weight: np.ndarray | None = None
    projection: np.ndarray | None = None
    vectors: np.ndarray | None = None
    labels: np.ndarray | None = None

    def latent(self, rows: np.ndarray) -> np.ndarray:
        """Unit vectors in multiples of ``UNIT``; products are always of ``ROWS`` rows.

        So a row's vector does not depend on the rows beside it.
        """
        found = []
        for first in range(0, len(rows), ROWS):
            block = np.zeros((ROWS, rows.shape[1]), np.float32)
            held = rows[first : first + ROWS]
            block[: len(held)] = held
            vectors = ((block * self.weight) @ self.projection)[: len(held)]
            norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
            found.append(np.rint(vectors / np.maximum(norms, 1e-9) / UNIT).astype(np.float32))
        return np.concatenate(found) if found else np.zeros((0, self.projection.shape[1]), np.float32)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """The weighted votes of the nearest, of equally near ones those first in order."""
        near = (self.latent(rows) @ self.vectors.T).astype(np.int64)
        k, labelled = min(NEIGHBOURS, near.shape[1]), near.shape[1]
        rank = near * labelled + np.arange(labelled)[::-1]
        top = np.sort(np.argpartition(rank, -k, axis=1)[:, -k:], axis=1)
        cosine = np.take_along_axis(near, top, axis=1) * UNIT**2
        weight = np.maximum(cosine, 1e-6) ** POWER
        votes, total = np.zeros(len(rows)), np.zeros(len(rows))
        for j in range(k):  # in one order, whatever the number of rows
            votes += weight[:, j] * self.labels[top[:, j]]
            total += weight[:, j]
        return np.clip(votes / total, 0, 1)


def leading(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """About the leading right singular vectors, by subspace iteration from a fixed start."""
    start = np.random.default_rng(0).standard_normal((rows.shape[1], dimensions + 16))
    basis = start.astype(np.float32)
    for _ in range(8):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    values, turn = np.linalg.eigh((rows @ basis).T @ (rows @ basis))
    return np.ascontiguousarray((basis @ turn[:, ::-1])[:, :dimensions])


def fit_quality(
    df: DataFrame,
    labels: DataFrame,
    where: Column | None = None,
    *,
    label: str = "quality",
    labelled: int = LABELLED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> QualityModel:
    """Learn from at most ``labelled`` documents of each label (1, or anything else).

    The ids of the sample, a number bounded by ``labelled``, are broadcast to
    find their texts. Null labels, and ids ``where`` does not hold for, are left
    out. The driver gets one feature row of fixed width for each sampled text.
    """
    held = labels if where is None else labels.filter(where)
    held = held.select(
        F.col(id_column).alias("tm_id"), (F.col(label) == 1).cast("int").alias("tm_label")
    )
    held = held.filter(F.col("tm_label").isNotNull() & F.col("tm_id").isNotNull())
    chosen = class_sample(held, "tm_label", F.col("tm_id"), labelled)
    chosen = chosen.groupBy("tm_id").agg(F.max("tm_label").alias("tm_label"))
    texts = df.select(F.col(id_column).alias("tm_id"), F.col(text_column).alias("text"))
    sample = texts.join(F.broadcast(chosen), "tm_id").dropDuplicates(["tm_id", "text"])
    found = per_text(
        sample,
        lambda texts: [[features(t).astype(np.float16).tobytes() for t in texts]],
        [StructField("row", BinaryType())],
        "tm_id",
        keep=(F.col("tm_label"), F.xxhash64("text").alias("tie")),
    ).collect()
    found.sort(key=lambda r: (str(r["tm_id"]), r["tie"]))
    if not found:
        return QualityModel(0.5)
    rows = np.stack([np.frombuffer(r["row"], np.float16) for r in found]).astype(np.float32)
    own = np.array([r["tm_label"] for r in found], np.float64)
    seen = (rows > 0).sum(axis=0)
    weight = (np.log((1 + len(rows)) / (1 + seen)) + 0.2).astype(np.float32)
    model = QualityModel(float(own.mean()), weight)
    weighted = rows * weight
    model.projection = leading(weighted, LATENT)
    model.vectors, model.labels = model.latent(rows), own
    return model


def score_quality(
    df: DataFrame,
    model: QualityModel,
    *,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[Column, ...] = (),
) -> DataFrame:
    """Columns id, ``keep``, score (0 to 1, higher is better), predicted of each text.

    Null and empty texts are like any other, a text without features; with
    nothing learned every score is 0.5. Whole texts count, of any length;
    repeated rows get equal rows. Other columns are not read. No shuffle.
    """

    def work(texts: list[str]) -> list[list]:
        if model.vectors is None:
            found = np.full(len(texts), model.prior)
        else:
            found = np.concatenate(
                [
                    model.scores(np.stack([features(t) for t in texts[i : i + ROWS]]))
                    for i in range(0, len(texts), ROWS)
                ]
            )
        return [found.astype(np.float64).tolist(), (found >= threshold).astype(int).tolist()]

    fields = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    return per_text(df, work, fields, id_column, text_column, keep)
