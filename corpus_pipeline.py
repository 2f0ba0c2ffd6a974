"""Corpus pipeline: quality rules, line dedup, near-dedup, benchmark decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
What one stage returns is written and read again as the next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.llm.base import free, materialize
from chronicell.llm.byte_bpe import RANKS, encode_and_decode
from chronicell.llm.decontaminate import drop_contaminated
from chronicell.llm.line_dedup import drop_repeated_lines
from chronicell.llm.near_dedup import keep_one_of_each
from chronicell.llm.quality_rules import clean_documents

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    """The columns of documents with another text; n_chars follows it."""
    new = docs.withColumn("text", F.col(text)).withColumn("n_chars", F.length("text").cast("long"))
    return new.select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their failing lines."""
    return _with_text(clean_documents(docs.select(*COLUMNS)).filter("kept"), "clean_text")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are in three documents or more stay only in the one with the largest id; every document stays."""
    return _with_text(drop_repeated_lines(docs.select(*COLUMNS)), "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document with the smallest id stays."""
    return keep_one_of_each(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens, ids, ids_sha256, decoded_sha256: the ids, and what they decode to."""
    path = public_tokenizers.path(RANKS)
    decoded = encode_and_decode(docs.select(*COLUMNS), path)
    return decoded.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("byte bpe", byte_bpe),
]
#: Near-dedup and the tokens have no SQL; tests/llm compares the whole run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}", narrow=False)
        free(*before)  # what the stage read has served, now that its result is written
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
