"""Training-data pipeline over ``documents``: one operator a stage.

Every stage takes what its predecessor kept and its decisions take effect: low
quality goes, one document of each group of near duplicates stays, documents
with benchmark items go, personal data is replaced, and what is left is packed
into sequences. All but the last return the columns of ``documents``.

Defined results of every stage: an empty table gives no rows; other columns,
whatever their names, are handed on by all but the last. Null and empty texts
fail the quality rules; given to a later stage they hold no item and no personal
data, have no near duplicates and are packed as their end id. Rows with a null id
are judged by their text like any other and never removed as near duplicates.
Repeated rows are judged alike; the second stage leaves one of them. Texts of
any length are taken whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tierwise.llm.decontam import drop_contaminated
from tierwise.llm.ngram_join import keep_one_of_each
from tierwise.llm.packing import pack_documents
from tierwise.llm.pii import redact, train_pii
from tierwise.llm.quality import keep_good, trusted_ids
from tierwise.llm.queries import NEAR_PERCENT, NEAR_WORDS, RANKS_PATH
from tierwise.llm.scratch import Scratch, workers_find_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio threshold."""
    return keep_good(docs, trusted_ids(_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    return keep_one_of_each(spark, docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(spark, docs, _table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return redact(docs, train_pii(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences."""
    workers_find_package(spark)
    return pack_documents(docs, RANKS_PATH)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("pii", personal_data),
    ("packing", packing),
]

#: SQL can't express the hashed scores, trained trees or token ids of the stages,
#: so the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    return reduce(lambda got, stage: scratch.save(stage[1](spark, got, sf_dir), stage[0]),
                  STAGES, docs)
