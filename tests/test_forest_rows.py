"""Forests score many rows tree by tree, and lines are reduced by order and flag, with the results of the plain forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import estimators as E
from cohortlens.sources import proxies as P


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.random() < 0.5 + 0.3 * np.sign(v[0])), v.round(1).tolist()) for i, v in enumerate(rng.normal(size=(900, 4)))]
    return spark.createDataFrame(rows, "row_id bigint, y int, x array<double>").repartition(3)


@pytest.mark.parametrize("at_once", [7, 4096])
def test_classes_equal_those_of_spark(points, at_once, monkeypatch):
    model = E.forest("y", "x", trees=6, depth=7).fit(points.limit(400))
    trees = E.flat_trees(points.sparkSession, model.stages[-1])
    assert len(trees) == 6 and sum(len(t[3]) for t in trees) == 2 * model.stages[-1].totalNumNodes
    monkeypatch.setattr(E, "ROWS_AT_ONCE", at_once)
    rows = model.transform(points).select("x", "prediction").collect()
    assert E.forest_classes(trees, np.array([r["x"] for r in rows])).tolist() == [r["prediction"] for r in rows]
    got = E.predicted(model, points)
    assert {(r["row_id"], r["prediction"]) for r in got.collect()} == {(r["row_id"], r["prediction"]) for r in model.transform(points).collect()}
    # Spark's own transform walks all trees row by row
    assert "ArrowEvalPython" in got._jdf.queryExecution().toString()


def test_other_models_and_large_forests_keep_their_transform(points, monkeypatch):
    linear = E.logistic("y", "x").fit(points)
    assert E.predicted(linear, points).select("row_id", "prediction").exceptAll(linear.transform(points).select("row_id", "prediction")).count() == 0
    model = E.forest("y", "x", trees=2, depth=2).fit(points)
    monkeypatch.setattr(E, "FLAT_NODES", 1)
    assert "probability" in E.predicted(model, points).columns


def test_order_lines_equal_one_aggregate(spark, tmp_path):
    rows = [(1, "A", 1.0), (1, "R", 2.0), (1, "R", None), (1, None, 4.0), (2, "N", 3.0), (2, "A", 5.0), (3, None, 1.0), (3, None, None), (4, "R", None), (5, "N", None), (None, "A", 2.0)]
    spark.createDataFrame(rows * 2, "l_orderkey bigint, l_returnflag string, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = P.order_lines(spark, str(tmp_path))
    q, is_r = F.col("l_quantity"), F.col("l_returnflag") == "R"
    want = P.table(spark, str(tmp_path), "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.when(is_r, q).otherwise(F.lit(0.0))), F.sum(F.when(is_r, F.lit(0.0)).otherwise(q)), F.sum(q), F.mode("l_returnflag", deterministic=True))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
    assert "ObjectHashAggregate" not in got._jdf.queryExecution().toString()
