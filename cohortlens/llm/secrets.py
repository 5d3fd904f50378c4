"""Secret scans over every version of every file, through an incremental blob ledger.

A version's content is addressed by its SHA-256 (a blob).  The ledger, a
Parquet table, has a row for each blob and rule version that was scanned, with
all findings, also when there are none.  A run scans only (blob, rule version)
pairs that the ledger lacks, each distinct blob once however many paths and
versions hold it, appends them, and joins the findings back to all paths.

Defined results: null content reads as empty and has no findings; every row of
the versions comes back, repeated rows repeatedly; an empty table gives an
empty result; other columns of the versions are kept out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import slices, text_rows
from cohortlens.session import scratch_path

#: Fixed rules: kind, pattern, group whose length counts, least length.
RULES_VERSION = "base-1"
RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
FINDING = "struct<kind:string,start:bigint,end:bigint>"
LEDGER = f"blob string, rules string, findings array<{FINDING}>"


def matchers() -> list[tuple]:
    # short runs of hex digits fill ordinary prose: the bound goes into the
    # pattern, which leaves the same matches because a run ends where it ends
    return [
        (kind, re.compile(r"[0-9a-f]{24,}" if kind == "hex" else pattern, re.ASCII | (re.IGNORECASE if kind == "assign" else 0)), group, least)
        for kind, pattern, group, least in RULES
    ]


def spans(text: str, rules: list[tuple]) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then in the order of the rules."""
    found = [
        (m.start(), at, kind, m.end())
        for at, (kind, pattern, group, least) in enumerate(rules)
        for m in pattern.finditer(text)
        if m.end(group) - m.start(group) >= least
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def ledger_of(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], LEDGER)


def scan(versions: DataFrame, path: str = "path", content: str = "content", ledger: str | None = None, rules_version: str = RULES_VERSION) -> DataFrame:
    """One row per version: its path, blob address and findings.  ``ledger`` is extended."""
    spark = versions.sparkSession
    ledger = ledger or scratch_path(spark, "ledger")
    body = F.coalesce(F.col(content).cast("string"), F.lit(""))
    blobs = versions.select(F.col(path).alias("path"), body.alias("content")).withColumn("blob", F.sha2(F.encode("content", "UTF-8"), 256))
    known = ledger_of(spark, ledger).filter(F.col("rules") == rules_version).select("blob")
    # copies fall together within each task before anything moves
    unseen = blobs.select("blob", "content").dropDuplicates(["blob"]).join(known, "blob", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = matchers()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches, 1):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(text, rules)] for _, text in text_rows(batch, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([rules_version] * batch.num_rows), pa.array(found, kind)], ["blob", "rules", "findings"])

    unseen.mapInArrow(run, LEDGER).write.mode("append").parquet(ledger)
    findings = spark.read.schema(LEDGER).parquet(ledger).filter(F.col("rules") == rules_version).select("blob", "findings")
    findings = findings.dropDuplicates(["blob"])  # two runs at once may both append a blob; its findings are the same
    return blobs.select("path", "blob").join(findings, "blob", "left").select(F.col("path").alias(path), "blob", "findings")
