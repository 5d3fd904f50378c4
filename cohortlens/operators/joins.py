"""Broadcast behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import scratch_path, stored_bytes

MAX_BROADCAST_BYTES = 64 << 20  # of compressed Parquet


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its stored size is at most ``max_bytes``, else ``df``.

    The (already aggregated) table is written to the shared folder, so it is
    computed once, its size is known in bytes and no cache stays behind.  Above
    the bound the join remains a shuffle join and AQE decides.
    """
    path = scratch_path(df.sparkSession, "side")
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return F.broadcast(back) if stored_bytes(df.sparkSession, path) <= max_bytes else back


def align_rows(rows: DataFrame, *others: DataFrame, key: str = "row_id") -> DataFrame:
    """Inner equi-joins by ``key`` of tables that each hold about a row for each row of ``rows``.

    Merge joins whatever the estimated sizes: a table of rows, however narrow, does not go through the driver.
    """
    for other in others:
        rows = rows.join(other.hint("merge"), key, "inner")
    return rows
