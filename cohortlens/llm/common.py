"""Helpers shared by the text operators: reading, hashing, ordering, scratch tables."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import scratch_path

#: Text bytes handled at once inside a Python worker.
SLICE_BYTES = 4_000_000

#: Fixed multipliers of the window fingerprints (odd 64-bit constants).
BASE_A = 0x9E3779B97F4A7C15
BASE_B = 0xC2B2AE3D27D4EB4F


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the plan starts anew there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_bytes: int) -> bool:
    """True if a table of the library's own making fits ``max_bytes`` on disk (read once)."""
    spark = df.sparkSession
    total = 0
    for f in df.inputFiles():
        p = spark._jvm.org.apache.hadoop.fs.Path(f)
        total += p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen()
        if total > max_bytes:
            return False
    return True


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, z, d, t, text): ``z, d, t`` is a total order of distinct rows without nulls.

    Null ids come last; rows that share an id are ordered by a hash of their
    text, and rows that share both are one document.
    """
    c = docs[doc_id]
    kind = docs.schema[doc_id].dataType
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    return docs.select(
        c.alias("id"),
        F.when(c.isNull(), 1).otherwise(0).alias("z"),
        F.coalesce(c, F.lit(0).cast(kind)).alias("d"),
        F.xxhash64(body).alias("t"),
        body.alias("text"),
    )


def without(docs: DataFrame, gone: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` whose (z, d, t) of ``keyed`` is not in ``gone``, so never by a null or shared id alone."""
    gone = gone.select(F.col("z").alias("_z"), F.col("d").alias("_d"), F.col("t").alias("_t")).distinct()
    c = docs[doc_id]
    zero = F.lit(0).cast(docs.schema[doc_id].dataType)
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    same = (F.when(c.isNull(), 1).otherwise(0) == gone["_z"]) & (F.coalesce(c, zero) == gone["_d"]) & (F.xxhash64(body) == gone["_t"])
    return docs.join(gone, same, "left_anti")


def text_rows(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, str]]:
    """(row, text) of one column, one Python string at a time; null reads as empty."""
    for i, v in enumerate(batch.column(column)):
        yield i, v.as_py() or ""


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text (one row at least)."""
    import pyarrow.compute as pc

    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolled(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Fingerprint of every run of ``k`` consecutive values, by doubling."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    mask = (1 << 64) - 1
    out, have, block, size = None, 0, h, 1
    while True:
        if k & size:
            piece = block[have : have + n]
            out = piece.copy() if out is None else out * np.uint64(pow(base, size, 1 << 64)) + piece
            have += size
        if have == k:
            return out
        block = block[:-size] * np.uint64(pow(base, size, 1 << 64) & mask) + block[size:]
        size *= 2


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective finaliser: every input bit reaches every output bit."""
    x = x ^ np.uint64((seed * BASE_A + BASE_B * (seed > 0)) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker does."""
    home = sys.modules.setdefault("_cohortlens_worker", types.ModuleType("_cohortlens_worker"))
    return home.__dict__.setdefault(name, {})


def forget() -> None:
    """Drop what other operators remember in this worker, before work that needs the memory."""
    home = sys.modules.get("_cohortlens_worker")
    if home is not None:
        for name in [k for k, v in home.__dict__.items() if isinstance(v, dict)]:
            home.__dict__[name].clear()


def hexdigest(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
