"""A corpus pipeline over ``documents``: each stage's result is stored and read again by the next.

Every stage works on all rows that its predecessor kept, and its decision takes effect: language identification
drops texts that are null or have no letter, exact deduplication all copies but one, the n-gram Jaccard join all but
the smallest id of a class of near copies, decontamination every document with a benchmark phrase. The last stage
encodes what is left.

Decisions go by row: the first stage numbers the stored rows once (``pipeline_row``), every operator carries the
number through, and a stage keeps rows by it. Ids may be null or repeated: each row has its own decision, and of a
group of copies one row stays. Empty tables pass through every stage; columns beyond those of documents and the
number are not carried on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmill.llm.decontaminate import contamination
from spendmill.llm.exact_dedup import exact_dedup
from spendmill.llm.language_id import identify_languages
from spendmill.llm.ngram_join import near_duplicates
from spendmill.llm.pieces import piece_digests
from spendmill.llm.queries import tokenizer
from spendmill.llm.storage import stored

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
ROW = "pipeline_row"
COLUMNS = (*DOCUMENT, ROW)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` stored with a number of its own for each row."""
    return stored(docs.select(*DOCUMENT, F.monotonically_increasing_id().alias(ROW)), "rows")


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose number is among those of ``kept``."""
    return docs.select(*COLUMNS).join(kept.select(ROW), ROW, "left_semi").select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null or have no letter; where no row has a label to learn from, the others stay all the same."""
    docs = numbered(docs)
    return only(docs, identify_languages(docs, row_col=ROW).where("not rejected"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return only(docs, exact_dedup(docs, row_col=ROW).where("kept"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of texts that share at least 0.8 of their five-word shingles: the smallest id's."""
    return only(docs, near_duplicates(docs, row_col=ROW).where("kept"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    by_row = docs.select(F.col(ROW).alias("doc_id"), "text")
    return only(docs, contamination(by_row, items).where("not contaminated").withColumnRenamed("doc_id", ROW))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digests(docs, tokenizer("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("exact_dedup", dedup_stage),
    ("ngram_jaccard_join", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece", encoding_stage),
]
#: SQL has no SentencePiece: tests/llm/test_pipeline.py holds the result against a plain rebuild.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
