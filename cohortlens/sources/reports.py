"""JSON report sink: one JSON document per row, built with ``to_json``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_report(df: DataFrame, fields: list[str | Column], name: str = "report") -> DataFrame:
    """Turn each row of ``df`` into ``to_json(struct(fields))``."""
    cols = [F.col(f) if isinstance(f, str) else f for f in fields]
    return df.select(F.to_json(F.struct(*cols)).alias(name))


def write_json_report(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.mode("overwrite").json(path)
    return path
