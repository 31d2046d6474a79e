"""Corpus pipeline: each stage reads what the one before it wrote.

All stages take a null text as an empty one and hand it on as null, keep columns of any other name as they are, give an
empty table for an empty table, and read whole texts of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import sentencepiece
from millrace.llm.common import table
from millrace.llm.exact import drop_exact
from millrace.llm.quality import drop_rejected
from millrace.llm.simhash import drop_near
from millrace.llm.winnow import drop_contaminated
from millrace.session import materialize
from millrace.workload.registry import prepare


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on all labels of ``docs``, calls good.

    Equal texts have equal scores, so rows that repeat stay or go together; a score of exactly 0.5 stays. Rows without
    an id are scored but never learned from. With labels of one class or of none, every text gets the share of good ones.
    """
    prepare(spark)
    return drop_rejected(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text: the one with the largest doc_id.

    Null and empty texts are one group. Rows without an id rank last; of rows that repeat an id and a text, one stays.
    """
    prepare(spark)
    return drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id.

    Texts without words are one group. Rows that repeat an id stay or go together; a row without an id stays.
    """
    prepare(spark)
    return drop_near(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by an item of ``benchmark``.

    A text without words is clean, and so is every text if there are no items. Rows that repeat go together.
    """
    prepare(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids instead of the text, with their number and whether decoding them gives the text.

    An empty text has no ids; repeated rows are encoded each.
    """
    prepare(spark)
    return sentencepiece.encode(docs, sentencepiece.load())


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("benchmark decontamination", clean), ("SentencePiece encoding", encode)]

#: SQL has no XXH64, zstandard or tokenizer, so the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of all but the last are written and reread."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{i}")
    return docs
