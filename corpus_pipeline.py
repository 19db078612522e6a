"""The corpus pipeline: quality, repeated lines, near duplicates, then packing into sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last return the
columns of documents, further ones and names that operators use themselves included. In every stage a null text counts
as empty, texts of any length count whole, repeated rows share their fate, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tilewright.llm import common, line_dedup, ngram_join, packing, quality


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that importance resampling draws; the labels teach it. Columns as in docs.

    Null, empty and blank texts go; rows that tie with the last one drawn stay; a null doc_id is drawn like any other.
    """
    return quality.keep_drawn(docs, common.read_table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that match an earlier one; a document left without words goes. Columns as in docs.

    Documents that lose no line stay as they are, null and empty texts among them. Of equal lines the first by doc_id
    and place stays, rows without an id come last, and rows of one doc_id lose the same lines.
    """
    return line_dedup.without_repeats(docs, least=1)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each class of near duplicates (five words, similarity 0.8). Columns as in docs.

    Null, empty and blank texts are near to nothing and stay, as do rows without an id; rows repeated with the smallest
    doc_id all stay.
    """
    return ngram_join.keep_classes(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of all that is left into sequences of 4096: a row for each piece and its place.

    Null and empty texts are one end token; only longer documents than a sequence are cut; repeated rows are packed each.
    """
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("best-fit packing", packing_stage),
]

#: Tokenizing, MinHash signatures and hashed models are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written as Parquet and read again."""
    docs, last = common.read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = common.save(stage(spark, docs, sf_dir))
        if last is not None:
            common.discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
