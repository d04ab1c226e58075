"""From raw documents to packed token sequences: language, lines, near copies, benchmark passages, packing.

Every stage takes all rows that the one before kept and is written out as Parquet.  All but the last return the columns of
``documents``, with whatever further columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from velotrail.llm.decontaminate import clean_documents
from velotrail.llm.language import accepted_documents
from velotrail.llm.line_dedup import without_repeated_lines
from velotrail.llm.near_dedup import without_near_copies
from velotrail.llm.packing import pack
from velotrail.plans.scratch import write_out

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; null texts, texts without letters and strange ones go."""
    return accepted_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that later documents repeat; n_chars is counted anew."""
    return without_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group linked by five-word shingles with a similarity of at least 0.8."""
    return without_near_copies(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("lines", lines), ("near_copies", near_copies), ("decontamination", decontamination), ("packing", packing),
]
#: Character models, minhashes and token ids are beyond SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_out(stage(spark, docs, sf_dir), name)
    return docs
