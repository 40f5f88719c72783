"""Language identification with a string kernel, Nystroem landmarks and ridge regression.

Kernel: the blended-spectrum presence kernel, the number of byte n-grams of
orders 1 to 4 that occur in both lower-cased texts, over the root of the
product of what occurs in each. Landmarks are labelled texts; the kernel of a
text with all landmarks, times the inverse root of their own kernel matrix, is
its feature vector, and one ridge regression for each language (one against
the rest) scores it. A batch is scored by two matrix products.

n-grams are hashed to 2**18 buckets.

The regressions of any text have one sum, so the best of them cannot tell that
a text is in no language learned. That is told by its spelling: the share of
its distinct runs of four letters (or spaces) that occur in a landmark of the
language predicted, against what is usual for held-out rows of that language.
Neither depends on the number of languages.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StringType, StructField

from tidemark.llm.common import per_text
from tidemark.llm.grams import Distinct, class_sample, gram_buckets

BITS = 18
ORDERS = (1, 2, 3, 4)
LANDMARKS = 40  # of each language
LEARNED = 400  # rows of each language the regression is fitted on, landmarks included
RIDGE = 1e-2
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")
ROWS = 128  # of a matrix product
SPELLED = 4  # bytes of a run of letters
KNOWN = 0.5  # of the usual share of known runs, what a text of a language has at least
ASSUMED = 4  # runs more that count as known, so that a word or two are not judged by chance
# Letters and space; bytes above 127 are parts of other characters, nearly all of them letters.
LETTERS = np.array([c > 127 or chr(c).isalpha() or c == 32 for c in range(256)])


class Presence:
    """The distinct n-grams of texts, as buckets."""

    def __init__(self):
        self.distinct = Distinct(BITS)

    def of(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.lower().encode(), np.uint8)
        return self.distinct.of(np.concatenate([gram_buckets(data, n, BITS) for n in ORDERS]))

    def spelling(self, text: str) -> np.ndarray:
        """The distinct runs of ``SPELLED`` letters, as buckets."""
        data = np.frombuffer(text.lower().encode(), np.uint8)
        if len(data) < SPELLED:
            return np.empty(0, np.uint32)
        inside = np.lib.stride_tricks.sliding_window_view(LETTERS[data], SPELLED).all(axis=1)
        return self.distinct.of(gram_buckets(data, SPELLED, BITS)[inside])


_presence: list[Presence] = []


def presence() -> Presence:
    if not _presence:
        _presence.append(Presence())
    return _presence[0]


@dataclass
class LanguageModel:
    """Landmarks, as sets of buckets, and what the regressions learned."""

    labels: list[str]
    landmarks: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None
    column: np.ndarray | None = None
    dense: np.ndarray | None = None
    spelled: list[np.ndarray] = field(default_factory=list)  # runs in landmarks, of each language
    usual: list[float] = field(default_factory=list)
    known: np.ndarray | None = None

    def learn_spelling(self, runs: list[np.ndarray], landmark: list[bool]) -> None:
        """Add a language from the runs of its rows; a landmark is held out of the others."""
        held = np.zeros(1 << BITS, np.int32)
        for own, among in zip(runs, landmark):
            held[own] += among
        self.spelled.append(np.flatnonzero(held).astype(np.int32))
        shares = [(held[own] > among).mean() for own, among in zip(runs, landmark) if len(own)]
        self.usual.append(float(np.median(shares)) if shares else 0.0)

    def fits(self, runs: np.ndarray, language: int) -> bool:
        """Whether enough of a text's runs are known in a language."""
        if self.known is None:
            self.known = np.zeros((len(self.labels), 1 << BITS), bool)
            for row, own in zip(self.known, self.spelled):
                row[own] = True
        common = int(self.known[language][runs].sum()) + ASSUMED
        return common >= KNOWN * self.usual[language] * (len(runs) + ASSUMED)

    def prepare(self) -> None:
        """Columns for the buckets that occur in a landmark, and the landmarks as a matrix."""
        known = np.unique(np.concatenate(self.landmarks))
        self.column = np.full(1 << BITS, -1, np.int32)
        self.column[known] = np.arange(len(known), dtype=np.int32)
        self.dense = np.zeros((len(known), len(self.landmarks)), np.float32)
        for j, buckets in enumerate(self.landmarks):
            self.dense[self.column[buckets], j] = 1
        self.norms = np.sqrt([len(b) for b in self.landmarks]).astype(np.float32)

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """The kernel of each set with each landmark."""
        if self.dense is None:
            self.prepare()
        rows = np.zeros((len(sets), self.dense.shape[0]), np.float32)
        for i, buckets in enumerate(sets):
            columns = self.column[buckets]
            rows[i, columns[columns >= 0]] = 1
        norms = np.sqrt([max(1, len(b)) for b in sets]).astype(np.float32)
        return rows @ self.dense / norms[:, None] / self.norms

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        """The regressions for at most ``ROWS`` sets.

        The kernel is a product of zeros and ones, so exact; what it is weighted
        with is added in one order, as the block always has the same shape. So
        a set's scores do not depend on the others.
        """
        near = np.zeros((ROWS, len(self.weights)))
        near[: len(sets), :-1] = self.kernel(sets)
        near[:, -1] = 1
        return np.add.reduce(near[:, :, None] * self.weights[None], axis=1)[: len(sets)]

    def fit(self, sets: list[np.ndarray], targets: np.ndarray) -> None:
        own = self.kernel(self.landmarks).astype(np.float64)
        values, vectors = np.linalg.eigh((own + own.T) / 2)
        keep = values > 1e-6 * values.max()
        root = vectors[:, keep] / np.sqrt(values[keep])
        features = self.kernel(sets).astype(np.float64) @ root
        features = np.hstack([features, np.ones((len(sets), 1))])
        gram = features.T @ features / len(sets)
        ridge = RIDGE * np.eye(len(gram)) / len(gram)
        ridge[-1, -1] = 0
        solved = np.linalg.solve(gram + ridge, features.T @ targets / len(sets))
        self.weights = np.vstack([root @ solved[:-1], solved[-1:]])


def fit_languages(
    df: DataFrame,
    where: Column | None = None,
    *,
    label: str = "lang",
    landmarks: int = LANDMARKS,
    learned: int = LEARNED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> LanguageModel:
    """Learn from at most ``learned`` rows of each language, ``landmarks`` of them as landmarks.

    Rows without label or without a letter are not learned from, nor those
    ``where`` does not hold. The driver gets the n-gram buckets of the sample,
    at most 2**19 for a text of any length. Equal tables give equal models,
    whatever the order of rows.
    """
    rows = df.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).alias("text"),
        F.col(label).cast("string").alias("lang"),
        (F.lit(True) if where is None else where).alias("own"),
    ).filter("own and lang is not null and text rlike '\\\\p{L}'")
    sample = class_sample(rows, "lang", F.col("doc_id"), learned)
    found = per_text(
        sample,
        lambda texts: [
            [presence().of(t).astype(np.int32).tobytes() for t in texts],
            [presence().spelling(t).astype(np.int32).tobytes() for t in texts],
        ],
        [StructField("grams", BinaryType()), StructField("runs", BinaryType())],
        keep=(F.col("lang"), F.xxhash64("text").alias("tie")),
    ).collect()
    found.sort(key=lambda r: (r["lang"], str(r["doc_id"]), r["tie"]))
    labels = sorted({r["lang"] for r in found})
    model = LanguageModel(labels)
    if not labels:
        return model
    sets = [np.frombuffer(r["grams"], np.int32) for r in found]
    for value in labels:
        own = [s for s, r in zip(sets, found) if r["lang"] == value]
        runs = [np.frombuffer(r["runs"], np.int32) for r in found if r["lang"] == value]
        taken = set(range(len(own))[:: max(1, len(own) // landmarks)][:landmarks])
        model.landmarks.extend(own[i] for i in sorted(taken))
        model.learn_spelling(runs, [i in taken for i in range(len(own))])
    targets = np.array([[1.0 if r["lang"] == v else -1.0 for v in labels] for r in found])
    model.fit(sets, targets)
    model.column = model.dense = None  # workers make them again from the landmarks
    return model


def predict_languages(
    df: DataFrame,
    model: LanguageModel,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[Column, ...] = (),
    outside: bool = False,
) -> DataFrame:
    """Columns id, ``keep``, lang_pred, score of each text.

    ``lang_pred`` is the language of the highest regression, the first in order
    among equals, and ``score`` that value moved from -1..1 to 0..1. A text that
    is null, empty or without a letter, and any text if nothing was learned, is
    ``und`` with score 0; with ``outside`` also one that is not spelled like the
    rows of its language, unless it is a few letters long. Whole texts count, whatever their length; repeated
    rows get equal rows. Other columns are not read. No shuffle.
    """

    def work(texts: list[str]) -> list[list]:
        names, values = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        at = [i for i, t in enumerate(texts) if LETTER.search(t)] if model.labels else []
        for first in range(0, len(at), ROWS):
            block = at[first : first + ROWS]
            scores = model.scores([presence().of(texts[i]) for i in block])
            best = scores.argmax(axis=1)
            for i, b, row in zip(block, best, scores):
                if outside and not model.fits(presence().spelling(texts[i]), b):
                    continue
                names[i] = model.labels[b]
                values[i] = float(min(1.0, max(0.0, (row[b] + 1) / 2)))
        return [names, values]

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return per_text(df, work, fields, id_column, text_column, keep)
