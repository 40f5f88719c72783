"""Benchmark decontamination with a distributed positional inverted index.

Documents are indexed in segments, the rows of one Arrow batch: for each term
the sorted word positions at which it occurs, all documents of the segment laid
out one after the other with a gap between. Segments are stored as rows
(segment, term, positions), and a row with the documents. A phrase is looked
up in each segment from its rarest term: its positions, less its offset in the
phrase, are intersected with those of the next rarest, and so on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidemark.llm.common import pieces, ship, turn

WINDOW = 10
# Bytes of benchmark texts that are handed to all tasks at a time.
BLOCK_BYTES = 16 * 1024**2
# Bytes, A to Z lower-cased: digits, letters and all beyond ASCII are parts of words.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


class _Numbers(dict):
    """A number for each new term."""

    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


def build_index(
    df: DataFrame,
    target: str,
    *,
    terms: set[bytes] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> str:
    """Write the index of ``df`` to the folder ``target``, which is returned.

    ``terms`` limits it to words that can be asked for; all words still count
    as positions. Null and empty texts have no words; a very long text is a
    segment of its own; repeated rows are documents of their own. Other columns
    are not read. No shuffle.
    """
    ship(df.sparkSession.sparkContext.applicationId)
    source = df.select(id_column, F.col(text_column).cast("binary").alias("text"))
    schema = StructType(
        [
            StructField("segment", StringType()),
            StructField("term", BinaryType()),
            StructField("positions", ArrayType(IntegerType())),
            StructField("ids", ArrayType(source.schema[id_column].dataType)),
            StructField("starts", ArrayType(IntegerType())),
        ]
    )
    arrow = to_arrow_schema(schema)
    fixed = None if terms is None else {t: i for i, t in enumerate(sorted(terms))}

    def segment(name: str, piece: pa.RecordBatch) -> pa.RecordBatch:
        known = _Numbers() if fixed is None else fixed
        found, starts, at = [], [0], 0
        for text in piece.column(1).to_pylist():
            words = words_of(text)
            if fixed is None:
                own = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
            else:
                own = np.fromiter(map(known.get, words, repeat(-1)), np.int32, len(words))
            found += [own, np.array([-1], np.int32)]
            at += len(words) + 1
            starts.append(at)
        numbers = np.concatenate(found)
        places = np.flatnonzero(numbers >= 0)
        places = places[np.argsort(numbers[places], kind="stable")].astype(np.int32)
        counts = np.bincount(numbers[numbers >= 0], minlength=len(known))
        held = np.flatnonzero(counts)
        names = list(known)
        ends = np.concatenate([[0, 0], np.cumsum(counts[held])]).astype(np.int32)
        empty = [None] * len(held)
        columns = [
            pa.array([name] * (len(held) + 1), arrow.field("segment").type),
            pa.array([b"", *(names[i] for i in held)], arrow.field("term").type),
            pa.ListArray.from_arrays(
                pa.array(ends), pa.array(places), type=arrow.field("positions").type
            ),
            pa.array([piece.column(0).to_pylist(), *empty], arrow.field("ids").type),
            pa.array([starts, *empty], arrow.field("starts").type),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn(__name__)
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in pieces(batch):
                yield segment(f"{part}-{number}", piece)
                number += 1

    source.mapInArrow(run, schema).write.parquet(target)
    return target


class Segment:
    """Postings of one segment, to be searched."""

    def __init__(self, name: str = ""):
        self.name = name
        self.postings: dict[bytes, np.ndarray] = {}
        self.ids: list = []
        self.starts = np.zeros(1, np.int64)

    NONE = np.empty(0, np.int32)

    def of(self, terms: list[bytes]) -> list[np.ndarray]:
        return [self.postings.get(t, self.NONE) for t in terms]

    def phrase(self, terms: list[bytes]) -> np.ndarray:
        """First positions of the exact phrase: offset-adjusted intersection, rarest first."""
        return self._phrase(self.of(terms))

    @staticmethod
    def _phrase(lists: list[np.ndarray]) -> np.ndarray:
        order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
        first = lists[order[0]] - order[0]
        for i in order[1:]:
            if not len(first):
                break
            wanted = first + i
            at = np.searchsorted(lists[i], wanted)
            at[at == len(lists[i])] = 0
            first = first[lists[i][at] == wanted]
        return first

    def windows(self, terms: list[bytes], size: int) -> list[np.ndarray]:
        """Positions of each window of ``size`` terms; of the whole item if it is shorter."""
        lists = self.of(terms)
        size = min(size, len(terms))
        missing = [i for i, x in enumerate(lists) if not len(x)]
        found, i = [], 0
        while i + size <= len(terms):
            while missing and missing[0] < i:
                missing.pop(0)
            if missing and missing[0] < i + size:
                i = missing[0] + 1  # no window with a term that does not occur
                continue
            found.append(self._phrase(lists[i : i + size]))
            i += 1
        return found

    def near(self, terms: list[bytes], slack: int) -> np.ndarray:
        """Where the spans of at most ``slack`` + 1 words start that have all terms, in one document.

        Of spans that end at one word the shortest counts.
        """
        lists = sorted(self.of(terms), key=len)
        if not len(lists[0]):
            return self.NONE
        start = np.unique(np.concatenate(lists))
        end = start
        for own in lists:  # the rarest first leaves the fewest starts
            at = np.searchsorted(own, start)
            inside = at < len(own)
            start, end, at = start[inside], end[inside], at[inside]
            end = np.maximum(end, own[at])
            close = end - start <= slack
            start, end = start[close], end[close]
        same = np.searchsorted(self.starts, start, "right") == np.searchsorted(self.starts, end, "right")
        start, end = start[same], end[same]
        return start[np.append(end[1:] != end[:-1], True)] if len(start) else self.NONE


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[Segment]:
    """Segments from rows that are sorted by segment and term."""
    name, own = None, Segment()
    for batch in batches:
        lists = batch.column(2)
        flat = lists.flatten().to_numpy()
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy())
        begin = 0
        documents = batch.column(3).is_valid().to_pylist()
        for i, (segment, term, end) in enumerate(
            zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), ends)
        ):
            if segment != name:
                if name is not None:
                    yield own
                name, own = segment, Segment(segment)
            if documents[i]:
                own.ids = batch.column(3)[i].as_py()
                own.starts = np.array(batch.column(4)[i].as_py(), np.int64)
            else:
                own.postings[term] = flat[begin:end].copy()
            begin = end
    if name is not None:
        yield own


def _by_segment(index: DataFrame) -> DataFrame:
    return index.repartition("segment").sortWithinPartitions("segment", "term")


def find_windows(
    index: DataFrame, items: list[tuple[str | None, list[bytes]]], *, size: int = WINDOW
) -> DataFrame:
    """Columns id, n_words, hits (word numbers), items (ids as text) for each indexed document.

    ``items`` are (id, words), handed to all tasks; an item shorter than ``size``
    is one window, one without words none. A hit by an item without id is a hit.
    """
    ship(index.sparkSession.sparkContext.applicationId)
    kind = index.schema["ids"].dataType.elementType
    schema = StructType(
        [
            StructField("place", StringType()),
            StructField("id", kind),
            StructField("n_words", LongType()),
            StructField("hits", ArrayType(IntegerType())),
            StructField("items", ArrayType(StringType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def search(segment: Segment) -> pa.RecordBatch:
        starts = segment.starts
        change = np.zeros(starts[-1] + 1, np.int32)
        held: list[set[str]] = [set() for _ in segment.ids]
        for name, words in items:
            if not words:
                continue
            length = min(size, len(words))
            for first in segment.windows(words, size):
                if not len(first):
                    continue
                np.add.at(change, first, 1)
                np.add.at(change, first + length, -1)
                if name is not None:
                    for d in np.unique(np.searchsorted(starts, first, "right") - 1):
                        held[d].add(name)
        hit = np.flatnonzero(np.cumsum(change) > 0)
        cuts = np.searchsorted(hit, starts)
        base = np.repeat(starts[:-1], np.diff(cuts))
        columns = [
            pa.array([f"{segment.name}-{d}" for d in range(len(held))]),
            pa.array(segment.ids, arrow.field("id").type),
            pa.array(np.diff(starts) - 1),
            pa.ListArray.from_arrays(
                pa.array(cuts.astype(np.int32)),
                pa.array((hit - base).astype(np.int32)),
                type=arrow.field("hits").type,
            ),
            pa.array([sorted(x) for x in held], arrow.field("items").type),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in _segments(batches):
            yield search(segment)

    return _by_segment(index).mapInArrow(run, schema)


def find_near(
    index: DataFrame, items: list[tuple[str | None, list[bytes]]], *, slack: int
) -> DataFrame:
    """Columns item, id, n_places: documents in which all words of an item lie close together.

    A place is a span that has every word of the item and whose first and last
    word are at most ``slack`` words apart; of those with one end the shortest.
    """
    ship(index.sparkSession.sparkContext.applicationId)
    schema = StructType(
        [
            StructField("item", StringType()),
            StructField("id", index.schema["ids"].dataType.elementType),
            StructField("n_places", LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in _segments(batches):
            rows = []
            for name, words in items:
                if not words:
                    continue
                at = segment.near(sorted(set(words)), slack)
                places = np.searchsorted(segment.starts, at, "right") - 1
                for d, n in zip(*np.unique(places, return_counts=True)):
                    rows.append((name, segment.ids[d], int(n)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow
            )

    return _by_segment(index).mapInArrow(run, schema)


def item_blocks(
    benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text"
) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items as (id, words), in blocks of about ``BLOCK_BYTES``."""
    items = benchmark.select(
        F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("binary").alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("id", "text"), F.lit(max(1, blocks)))
    for number in range(blocks):
        rows = items.filter(block == number).collect()
        yield [(r["id"], words_of(r["text"])) for r in rows]


def contamination(
    df: DataFrame,
    benchmark: DataFrame,
    target: str,
    *,
    size: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Columns id, n_words, n_hit, n_items, items of each document.

    A word is hit if it lies in an occurrence of ``size`` consecutive words of an
    item (of the whole item, if shorter); ``items`` are the ids, sorted as text.
    The index is written to ``target``. A benchmark of any size is looked up in
    blocks of ``BLOCK_BYTES``, each handed to all tasks. Null and empty texts
    have no words on either side; without items nothing is hit; repeated rows
    each give a row; items of one text each count. Columns other than id and
    text are not read.
    """
    spark: SparkSession = df.sparkSession
    blocks = item_blocks(benchmark)
    first, second = next(blocks, []), next(blocks, None)
    terms = None if second is not None else {w for _, words in first for w in words}
    build_index(df, target, terms=terms, id_column=id_column, text_column=text_column)
    index = spark.read.parquet(target)
    found = find_windows(index, first, size=size)
    if second is not None:
        for block in [second, *blocks]:
            found = found.union(find_windows(index, block, size=size))
        found = found.groupBy("place").agg(
            F.any_value("id").alias("id"),
            F.any_value("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    return found.select(
        F.col("id").alias(id_column),
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
    )
