"""The cleaning pipeline: five stages over ``documents``, each one of the operators.

``STAGES`` lists them in order; a stage takes (spark, docs, sf_dir) and gives a
frame that is written as Parquet and read again as the docs of the next one.
All but the last return the columns of their docs, which may have others than
those of ``documents``, of any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_kernel, line_dedup, phrase_index, sentence_pieces, tensor_minhash
from tidemark.llm.common import documents, prepared, without
from tidemark.llm.components import stored
from tidemark.session import configure, new_scratch_path

# SQL has no kernel regression and no sentence pieces; tests compare with brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those that no language learned from docs fits.

    A text fits if it is spelled like the rows of the language predicted; a few
    letters are not enough to tell, and stay. So null and empty texts go, and all rows if nothing could be learned. Each
    row is judged by its text alone; ids may be null or repeated. No shuffle.
    """
    prepared(configure(spark))
    model = language_kernel.fit_languages(docs)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("tm_row")
    found = language_kernel.predict_languages(docs, model, keep=(row,), outside=True)
    return found.filter(F.col("lang_pred") != language_kernel.UNDETERMINED).select("tm_row.*")


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out lines of which an earlier line of any document has the same or similar words.

    A document without a word left goes, as do null and empty texts; a column
    ``n_chars`` is that of what is left. Rows of one id lose the same lines.
    """
    prepared(configure(spark))
    left = line_dedup.without_lines(docs).filter(r"text rlike '[^\\x20\\x09-\\x0D]'")
    if "n_chars" not in docs.columns:
        return left
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", size)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group: five words, similarity 0.8.

    Rows without id stay; rows of one id stay or go together.
    """
    prepared(configure(spark))
    found = tensor_minhash.near_duplicates(docs, shingle=5, percent=80)
    gone = found.filter("not kept").select("doc_id").distinct()
    return without(docs, stored(gone, "gone"), "doc_id")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with ten consecutive words of a benchmark item, or a whole shorter item.

    Each row is judged by its text alone; null and empty texts stay.
    """
    prepared(configure(spark))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = docs.select(F.xxhash64("text").alias("tm_text"), "text")
    target = new_scratch_path(spark, "postings")
    found = phrase_index.contamination(own, benchmark, target, id_column="tm_text")
    gone = stored(found.filter("n_hit > 0").select("tm_text").distinct(), "gone")
    return without(docs.withColumn("tm_text", F.xxhash64("text")), gone, "tm_text").drop("tm_text")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentence pieces of each document, counted and digested, and what they decode to.

    A null text is empty. Columns doc_id, n_tokens, ids_sha256, decoded_sha256.
    """
    prepared(configure(spark))
    return sentence_pieces.piece_digests(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("lines", deduplicate_lines),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_contaminated),
    ("pieces", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole of ``documents``."""
    docs = documents(configure(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
