"""A corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.  All stages but the
last return the columns of ``documents``; each works on every row that the one
before it kept.  Null ids, null texts and further columns pass through as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import table, written
from tessera.llm.mixing import mixed_documents
from tessera.llm.ngram_join import one_of_each
from tessera.llm.packing import pack_documents
from tessera.llm.quality_zstd import keep_good
from tessera.llm.recompression import without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts."""
    return keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by the n-gram join: five words, 0.8 or more."""
    return one_of_each(docs, n=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under repeated 13-word windows are cut; the first document keeps them."""
    return without_repeats(docs, window=13)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return pack_documents(docs, max_tokens=1024, max_segments=64)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: Two of the stages are trained or packed by heuristics, which SQL cannot
#: state; tests/llm/test_pipeline.py checks each stage on what the last one kept.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
