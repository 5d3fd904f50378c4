"""Tables with a row for each training row do not pass through the driver."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import validate as V
from cohortlens.operators.joins import align_rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_completeness_is_checked_without_a_broadcast(spark, monkeypatch):
    seen = []
    real = type(spark.range(1)).isEmpty
    monkeypatch.setattr(type(spark.range(1)), "isEmpty", lambda df: (seen.append(plan(df)), real(df))[1])
    train = spark.range(1000).withColumnRenamed("id", "row_id")
    preds = train.withColumn("strategy", F.explode(F.array(F.lit("a"), F.lit("b"))))
    V.assert_complete(train, preds, "row_id", ["a", "b"])
    assert len(seen) == 1 and "Broadcast" not in seen[0]
    with pytest.raises(RuntimeError):
        V.assert_complete(train, preds.where("not (strategy = 'b' and row_id = 7)"), "row_id", ["a", "b"])
    with pytest.raises(RuntimeError):  # a null key matches nothing
        V.assert_complete(train.unionByName(spark.sql("select cast(null as bigint) row_id")), preds.unionByName(spark.sql("select cast(null as bigint) row_id, 'a' strategy")))


def test_rows_are_aligned_without_a_broadcast(spark):
    a = spark.range(50).withColumnRenamed("id", "row_id")
    out = align_rows(a, a.withColumn("b", F.col("row_id") * 2).where("row_id > 3"), a.withColumn("c", F.col("row_id") + 1))
    assert "Broadcast" not in plan(out)
    assert sorted((r.row_id, r.b, r.c) for r in out.collect()) == [(i, 2 * i, i + 1) for i in range(4, 50)]
