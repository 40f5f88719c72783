"""One query for each operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    hilbert_shards,
    language_kernel,
    line_dedup,
    part_codes,
    phrase_index,
    quality_votes,
    rare_digest,
    sentence_pieces,
    sql,
    tensor_minhash,
    token_count,
    token_files,
    url_templates,
    whitening,
)
from tidemark.llm.common import documents, prepared, remainder
from tidemark.llm.vectors import embeddings
from tidemark.session import configure, new_scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of each document, and whether it is over 512 tokens."""
    return token_count.count_tokens(documents(configure(spark), folder))


def op2_language_kernel(spark: SparkSession, folder: str) -> DataFrame:
    """The language of each document, learned where crc32 of the id modulo 3 is not 1."""
    docs = documents(configure(spark), folder)
    model = language_kernel.fit_languages(docs, remainder("doc_id", 3) != 1)
    held_out = (remainder("doc_id", 3) == 1).alias("held_out")
    return language_kernel.predict_languages(docs, model, keep=(held_out,))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents written as files in id order; digests of what was read back."""
    target = new_scratch_path(configure(spark), "tokens")
    token_files.write_token_files(documents(spark, folder), target)
    return token_files.token_digests(token_files.read_token_files(spark, target))


def op4_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Count and digests of the ids of each document and of the text they decode to."""
    return sentence_pieces.piece_digests(documents(configure(spark), folder))


def op5_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of each document, learned where crc32 of the id modulo 5 is not 0."""
    docs = documents(configure(spark), folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_votes.fit_quality(docs, labels, remainder("doc_id", 5) != 0)
    held_out = (remainder("doc_id", 5) == 0).alias("held_out")
    return quality_votes.score_quality(docs, model, keep=(held_out,))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of each document, and which of them repeat an earlier line of any document."""
    counted = line_dedup.line_counts(documents(configure(spark), folder))
    return counted.withColumn("removed", F.array_join("removed", ","))


def op7_phrase_index(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that lie in a passage of ten words of the benchmark."""
    docs = documents(configure(spark), folder)
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    target = new_scratch_path(spark, "postings")
    return phrase_index.contamination(docs, benchmark, target).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_rare_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness."""
    return rare_digest.rare_digests(documents(configure(spark), folder))


def op9_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 8 shards of equal count along a curve through four columns."""
    text = F.coalesce("text", F.lit(""))
    dimensions = {
        "source": F.col("source"),
        "lang": F.col("lang"),
        "size": F.octet_length("text").cast("bigint"),
        "doc_id": F.col("doc_id"),
    }
    placed = hilbert_shards.hilbert_shards(
        documents(configure(spark), folder),
        dimensions=dimensions,
        carry=(
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        ),
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_tensor_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes of all documents: 3-word shingles, Jaccard 0.85 and more."""
    docs = documents(configure(spark), folder)
    return tensor_minhash.near_duplicates(docs, shingle=3, percent=85)


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings along their eight leading singular directions, with unit covariance."""
    return whitening.whitened_components(embeddings(spark, folder))


# The rules of the contract.
URL_RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}


def op12_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all urls, by rule or by the template of their path."""
    pages = prepared(configure(spark)).read.parquet(f"{folder}/pages.parquet")
    configure(spark, pages)
    return url_templates.judge_urls(pages, URL_RULES)


def op13_part_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as 16 codes of codebooks of 64 entries after two exact rounds."""
    return part_codes.part_codes(embeddings(spark, folder))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_language_kernel,
        op3_token_files,
        op4_sentence_pieces,
        op5_quality_votes,
        op6_line_dedup,
        op7_phrase_index,
        op8_rare_digest,
        op9_hilbert_shards,
        op10_tensor_minhash,
        op11_whitening,
        op12_url_templates,
        op13_part_codes,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op6_line_dedup": sql.LINES,
    "op7_phrase_index": sql.PHRASES,
    "op10_tensor_minhash": sql.NEAR_DUPLICATES,
    "op13_part_codes": sql.PART_CODES,
}
