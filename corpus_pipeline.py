"""Corpus pipeline: five stages over ``documents``, each on all that its predecessor kept.

toxicity drops documents that score 0.7 or more; line dedup deletes later copies
of line runs (and documents of which nothing is left); the near-duplicate stage
deletes later copies of single long lines, and its n-gram Jaccard join keeps the first document of each group of near duplicates (five words, 0.8);
benchmark decontamination drops documents with a benchmark window; the last
stage encodes what is left.  Every stage is written and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import bpe, decontam, jaccard, lines
from cohortlens.llm import toxicity as compression
from cohortlens.llm.common import stored, table
from cohortlens.llm.queries import TOKENIZERS

#: A single line of so many words counts as a repeated passage by itself.
LONG_LINE_WORDS = 25


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance calls toxic go; null and empty texts stay."""
    return compression.drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of two lines or more are deleted from the texts.

    A document all of whose lines were later copies goes; texts that were null
    or empty before stay as they are.  ``n_chars`` follows the text.
    """
    return without_copies(docs, min_lines=2)


def without_copies(docs: DataFrame, **how) -> DataFrame:
    left = lines.dedup(docs, **how)
    left = left.filter((F.col("_n_deleted") == 0) | (F.col("_n_deleted") < F.col("_n_lines"))).drop("_n_lines")
    if "n_chars" in docs.columns:
        new = F.when(F.col("_n_deleted") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", new)
    return left.drop("_n_deleted")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of long single lines go, then all but the document of smallest id in each group of near duplicates.

    A passage that is one line between other neighbours is no run of lines, and
    too small a part of its document for the Jaccard join.
    """
    docs = stored(without_copies(docs, min_lines=1, least_words=LONG_LINE_WORDS), "without_long_lines")
    return jaccard.first_of_group(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten words of a benchmark item go."""
    return decontam.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the text they decode to, in one worker a task: two maps need twice the memory."""
    return bpe.round_trip(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Learned scores and token ids have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
