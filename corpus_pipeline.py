"""A training corpus from the table ``documents``: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet
and read back as the next one's docs. All but the last return the columns of docs.

Rows: a null or empty text is a text without words in all stages; further columns, whatever their names, go
through unread; rows are judged one by one, so that repeated rows and ids are no error; an empty table gives
an empty one. Each stage's docstring says what becomes of null ids and ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.exact_dedup import drop_exact_copies
from tripflow.llm.jaccard_join import Similarity, drop_near_copies
from tripflow.llm.mixing import mix_documents
from tripflow.llm.packing import pack_documents
from tripflow.llm.quality import SCORE, fit_quality
from tripflow.llm.queries import KEEP_SCORE, MIX_SEED, document_levels, table, vocabulary
from tripflow.llm.shared import Tables

# Documents are long rows: Arrow batches of thousands of them would take a task's memory several times over.
BATCH_ROWS = 1000
MIX_SHARE = 0.9  # of all tokens, each document at most once


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores ``KEEP_SCORE`` or more; it learns from the table ``labels``.

    Empty and very long texts get a score as any other, null ids too; they only lack a label to learn from. A score
    of exactly ``KEEP_SCORE`` stays. Without any label all documents have one score."""
    _small_batches(spark)
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).filter(F.col(SCORE) >= KEEP_SCORE).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id. Null and empty texts are equal; a null id is
    smaller than any other; of rows that repeat an id one stays."""
    return drop_exact_copies(docs, keep="max")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 the one with the smallest id. Texts without words and
    null ids link with nothing and stay; rows of one id stay or go together."""
    _small_batches(spark)
    return drop_near_copies(docs, Similarity(words=5, percent=80))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Domains, languages and sources in their target weights, each document at most once. Null languages and
    sources are values of their own; ties in the seeded order go by id."""
    return mix_documents(docs, document_levels(), share=MIX_SHARE, max_epochs=1, seed=MIX_SEED).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 token ids, one row per piece of a document. A text without tokens is one
    piece, its end id; a null id stays null; every row is packed once."""
    _small_batches(spark)
    return pack_documents(docs, vocabulary("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing to target weights", mixture),
    ("packing", packing),
]

# Scores of a trained network and token ids have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the stages make of ``documents``."""
    docs, tables, before = table(spark, sf_dir, "documents"), Tables(spark), None
    for name, stage in STAGES[:-1]:
        docs = tables.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:  # no later stage reads it
            tables.drop(before)
        before = name.replace(" ", "-")
    return STAGES[-1][1](spark, docs, sf_dir)
