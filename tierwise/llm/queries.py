"""The opN_ queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.decontam import benchmark_matches
from tierwise.llm.fim import fill_in_middle, restored
from tierwise.llm.html_extract import extract_text, train_extractor
from tierwise.llm.licenses import license_finds, train_licenses
from tierwise.llm.ngram_join import ngram_jaccard_join
from tierwise.llm.oracle import ORACLE
from tierwise.llm.packing import pack_documents
from tierwise.llm.pii import pii_report, train_pii
from tierwise.llm.quality import quality_rules, trusted_ids
from tierwise.llm.scratch import Scratch, workers_find_package
from tierwise.llm.substring_dedup import substring_dedup
from tierwise.llm.suffix_dedup import suffix_dedup
from tierwise.llm.vector_dedup import near_vectors
from tierwise.llm.warc import page_summary, read_warc, write_warc
from tierwise.llm.whitening import fit_whitening, whiten

#: Least Jaccard similarity of linked documents, in percent, and words of a shingle.
NEAR_PERCENT = 80
NEAR_WORDS = 5
#: The vocabulary of byte_bpe_50k.json as ranks; both give the same ids.
RANKS_PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    docs = _table(spark, sf, "documents")
    return ngram_jaccard_join(spark, docs, words=NEAR_WORDS, percent=NEAR_PERCENT).documents


_REMOVED = "aggregate(removed, 0L, (n, r) -> n + r.e - r.s)"


def op2_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Byte counts and the digest of what remains of every document."""
    return suffix_dedup(spark, _table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", F.expr(_REMOVED).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Word counts and the digest of what remains of every document."""
    return substring_dedup(spark, _table(spark, sf, "documents")).select(
        "doc_id", "n_words", F.expr(_REMOVED).alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op4_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf, "pages")
    found = extract_text(spark, pages, train_extractor(spark, pages))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each benchmark item found in a document."""
    return benchmark_matches(spark, _table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each piece of each document in its sequence."""
    return pack_documents(_table(spark, sf, "documents"), RANKS_PATH)


def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    scratch = Scratch(spark, "warc")
    path = scratch.path("archive")
    write_warc(spark, _table(spark, sf, "pages"), path, scratch)
    return page_summary(read_warc(spark, path, with_payload=False))


def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Base features, base verdict and verdict of every document."""
    return quality_rules(_table(spark, sf, "documents"), trusted_ids(_table(spark, sf, "labels")))


def op9_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and spans of the personal data of every document."""
    docs = _table(spark, sf, "documents")
    return pii_report(docs, train_pii(docs))


def op10_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each licence paragraph of each document."""
    docs = _table(spark, sf, "documents")
    return license_finds(spark, docs, train_licenses(docs))


def op11_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Four whitened components of every usable vector."""
    vectors = _table(spark, sf, "embeddings")
    return whiten(vectors, fit_whitening(spark, vectors, components=4, scale=256))


def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    """Cuts, form and digests of every document's fill-in-middle output."""
    found = fill_in_middle(_table(spark, sf, "documents"), seed=42, percent=50, spm_percent=80)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(restored(), 256).alias("restored_sha256"))


def op13_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Number of links and component of every vector."""
    return near_vectors(spark, _table(spark, sf, "embeddings"), threshold=0.9).vectors


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_suffix_array_dedup": op2_suffix_array_dedup,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_html_extraction": op4_html_extraction,
        "op5_benchmark_decontamination": op5_benchmark_decontamination,
        "op6_packing": op6_packing,
        "op7_warc": op7_warc,
        "op8_quality_rules": op8_quality_rules,
        "op9_pii": op9_pii,
        "op10_license_scan": op10_license_scan,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_embedding_near_dedup": op13_embedding_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express; the tests hold the others against brute force."""
    return dict(ORACLE)
