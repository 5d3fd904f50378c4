"""Registered queries of the text operators, and the SQL of those that SQL can express.

Every query applies its operator, with production parameters, to a whole table.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import alignment, bpe, decontam, jaccard, lines, packing, phrases, secrets, substrings, token_counts, topk, toxicity, warc
from cohortlens.llm.common import hexdigest, table
from cohortlens.llm.sql import SQL

#: Folder of the public vocabulary files (a parameter; the files are not part of this repository).
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.round_trip(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")
    return out.select("doc_id", "n_tokens", hexdigest(F.col("ids")).alias("ids_sha256"), hexdigest(F.col("decoded")).alias("decoded_sha256"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), "doc_id", "text")
    said = F.concat_ws(",", F.transform("findings", lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])))
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), hexdigest(said).alias("base_sha256"), said.alias("spans"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return topk.search(docs, docs.filter("doc_id % 50 = 0"), k=10)


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    left = lines.dedup(docs, min_lines=2)
    return left.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_deleted").alias("n_deleted"), hexdigest(F.col("text")).alias("kept_sha256"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.dedup(table(spark, sf_dir, "documents"), window=20)
    return left.select("doc_id", "n_words", "n_removed", hexdigest(F.col("text")).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels.filter(~toxicity.held_out())))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return judged.select("doc_id", "n_words", "n_hit", "n_items", hexdigest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json", length=2048)


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), words=4, percent=85)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), top=2000, support=10, longest=3, covered=50)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
    digest = F.when(F.col("n_a") > 0, hexdigest(F.col("groups"))).otherwise("")
    out = alignment.link_statistics(aligned.withColumn("groups_sha256", digest).drop("groups"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.deduplicated(table(spark, sf_dir, "pages"), least_bytes=0)
    return found.select(
        F.col("source_id").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_secrets": op2_secrets,
    "op3_topk": op3_topk,
    "op4_lines": op4_lines,
    "op5_substrings": op5_substrings,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_packing": op8_packing,
    "op9_jaccard": op9_jaccard,
    "op10_token_counts": op10_token_counts,
    "op11_phrases": op11_phrases,
    "op12_alignment": op12_alignment,
    "op13_warc": op13_warc,
}

__all__ = ["QUERIES", "SQL", "TOKENIZERS"]
