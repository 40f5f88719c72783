"""Token ids of documents as Parquet files that can be read in part.

The files hold one row for each document in ascending id order. Token ids are
a list column with dictionary pages, ids and offsets are delta encoded; row
groups are small, pages are cut by rows and carry page indexes. A reader of a
range of ids, or of counts alone, touches only those pages and columns.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer

from tidemark.llm.common import Memo, kept, pieces, ship, turn, vocabulary
from tidemark.llm.token_count import byte_symbols

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
# Words kept with their ids in a Python worker, so that memory stays bounded.
CACHED = 400_000
# No token goes over a space or a line end, nor from a letter to one of these signs.
# The letters are those that normalisation keeps as one letter.
WORD = re.compile(
    r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+(?=[.,;:!?%&*#$|])|[^ \n]+"
)
# Lower case is part of the vocabulary's normalisation. Up to this character Python's
# is the same, unless it would make a special token, which begins with this sign.
LAST_SAME = 0x24F
SPECIAL = "<|"

FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.block.size": str(16 * 1024**2),
    "parquet.page.size": str(256 * 1024),
    "parquet.page.row.count.limit": "1000",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
}


# Lower-case letters alone: nothing to normalise or to split.
PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u024f]+")


def _last_character(text: str) -> int:
    """The highest code unit of a text that is not empty."""
    return int(np.frombuffer(text.encode("utf-16-le"), np.uint16).max())


class Encoder:
    """Ids of whole texts, each word encoded once by the library and remembered.

    A word of lower-case letters goes to the library's model at once, as the
    characters of its bytes; any other through normalisation and splitting.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        symbols = byte_symbols()
        self.bytes_of = {
            n: "".join(symbols[b] for b in chr(n).encode()) for n in range(0x80, 0x250)
        }
        self.of_part = Memo(self._part, CACHED // 4)
        self.of_word = Memo(self._word, CACHED)

    def _word(self, word: str) -> bytes:
        parts = WORD.findall(word)
        if len(parts) == 1:
            return self._part(word)
        return b"".join(map(self.of_part.__getitem__, parts))

    def _part(self, word: str) -> bytes:
        if PLAIN.fullmatch(word) and word == word.lower():
            shown = word if word.isascii() else word.translate(self.bytes_of)
            ids = [token.id for token in self.model.tokenize(shown)]
        else:
            ids = self.library.encode(word, add_special_tokens=False).ids
        return np.array(ids, "<i4").tobytes()

    def encode(self, text: str) -> bytes:
        if SPECIAL not in text and (text.isascii() or _last_character(text) <= LAST_SAME):
            text = text.lower()
        return b"".join(map(self.of_word.__getitem__, text.replace("\n", " ").split(" ")))


@kept
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_token_files(
    df: DataFrame,
    target: str,
    *,
    path: str | None = None,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> str:
    """Encode ``df`` and write its token files to the folder ``target``, which is returned.

    Columns: the id, ``part`` (number of the file, ascending with the ids),
    ``start_in_part`` (ids before the document in its file), ``n_tokens`` and
    ``ids`` with ``end_id`` last. A null or empty text has the end id alone.
    Null ids come first; rows of one id are ordered by a hash of their text, and
    repeated rows stay. Other columns are not read. One shuffle, by ranges of
    ids, in which adaptive execution merges small ranges.
    """
    path = path or vocabulary(VOCABULARY)
    text = F.coalesce(text_column, F.lit(""))
    order = [F.col(id_column).asc_nulls_first(), F.xxhash64("text").asc()]
    ship(df.sparkSession.sparkContext.applicationId)
    source = df.select(id_column, text.alias("text"))
    schema = StructType(
        [
            source.schema[id_column],
            StructField("part", IntegerType()),
            StructField("start_in_part", LongType()),
            StructField("n_tokens", IntegerType()),
            StructField("ids", ArrayType(IntegerType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn(__name__)
        own, end = encoder(path), np.array([end_id], "<i4").tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in pieces(batch):
                found = [own.encode(t) + end for t in piece.column(1).to_pylist()]
                counts = np.fromiter((len(x) // 4 for x in found), np.int64, len(found))
                offsets = np.concatenate([[0], np.cumsum(counts)])
                ids = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()),
                    pa.array(np.frombuffer(b"".join(found), "<i4")),
                    type=arrow.field("ids").type,
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array(np.full(len(found), part, np.int32)),
                        pa.array(before + offsets[:-1]),
                        pa.array(counts.astype(np.int32)),
                        ids,
                    ],
                    schema=arrow,
                )
                before += int(offsets[-1])

    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(run, schema).write.options(**FILE_OPTIONS).parquet(target)
    return target


def read_token_files(spark: SparkSession, target: str) -> DataFrame:
    """The token files; filters on the id and the columns chosen reach the scan."""
    return spark.read.parquet(target)


def token_offsets(stored: DataFrame) -> DataFrame:
    """Columns part, base: ids in all files before each file. One row a file, from counts alone."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    return totals.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))


def token_digests(stored: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Columns id, start, n_tokens, ids_crc32 of token files that were read.

    ``start`` counts the ids of all documents before this one; the other two
    are taken from the stored ids, as unsigned 32-bit little-endian integers.
    """
    ship(stored.sparkSession.sparkContext.applicationId)
    source = stored.select(id_column, "part", "start_in_part", "ids")
    schema = StructType(
        [
            *source.schema.fields[:3],
            StructField("n_tokens", LongType()),
            StructField("ids_crc32", LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().to_numpy().astype("<u4", copy=False)
            ends = np.cumsum(counts)
            crc = [zlib.crc32(values[e - n : e]) for e, n in zip(ends, counts)]
            columns = [*batch.columns[:3], pa.array(counts), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return (
        source.mapInArrow(run, schema)
        .join(token_offsets(stored), "part")
        .select(
            id_column,
            (F.col("base") + F.col("start_in_part")).alias("start"),
            "n_tokens",
            "ids_crc32",
        )
    )
