"""SMOTE inside an estimator on raw rows: fitted, saved, loaded; and tables that are rewritten or absent."""

import random

import pytest
from pyspark.ml import Estimator
from pyspark.sql import functions as F

from cohortlens.operators import prepare as PR
from cohortlens.operators import resample as RS
from cohortlens.operators.estimators import CentroidClassifier
from cohortlens.operators.smote_model import RawSmoteEstimator
from cohortlens.session import scratch_path
from cohortlens.sources import tables as TB
from cohortlens.sources.models_io import load_model, save_model


@pytest.fixture(scope="module")
def raw(spark):
    rng = random.Random(5)
    rows = []
    for i in range(240):
        s = rng.choice(["a", "b", None])
        y = int(rng.random() < (0.15 if s == "b" else 0.5))
        rows.append((i, y, s, rng.gauss(2 * y, 1), None if i % 9 == 0 else rng.gauss(-y, 2), i % 7))
    return spark.createDataFrame(rows, "row_id long, y int, segment string, p double, q double, week int").repartition(4)


def estimator(value="b", **more):
    prep = PR.TablePreprocessor(numericCols=["p", "q"], keepCols=["row_id", "y", "segment"], arrayCol="x")
    return RawSmoteEstimator(prep, CentroidClassifier(inputCol="x", labelCol="y"), value, targetCol="y", cohortCol="segment", redundantCols=["week", "absent"], **more)


def scores(model, df):
    return {r["row_id"]: r["prediction"] for r in model.transform(df).collect()}


def test_fit_equals_the_steps_one_by_one(raw):
    est = estimator()
    got = est.fit(raw)
    prep = est.preparer.fit(raw.drop("week"))
    rows, stats = RS.smote_cohort(prep.transform(raw), "y", F.col("segment") == "b", "x", 5, 42)
    want = CentroidClassifier(inputCol="x", labelCol="y").fit(rows)
    assert est.last_stats == stats and stats["cohort_synthetic_n"] > 0
    assert got.stages[-1].getOrDefault("positiveMean") == pytest.approx(want.getOrDefault("positiveMean"))
    plain = CentroidClassifier(inputCol="x", labelCol="y").fit(prep.transform(raw))
    assert got.stages[-1].getOrDefault("positiveMean") != pytest.approx(plain.getOrDefault("positiveMean"))


def test_estimator_and_model_are_saved(spark, raw):
    est = estimator()
    path = scratch_path(spark, "raw-estimator")
    est.write().overwrite().save(path)
    again = RawSmoteEstimator.load(path)
    assert again.getOrDefault("cohortValue") == '"b"' and isinstance(again.inner, CentroidClassifier)
    model = est.fit(raw)
    want = scores(model, raw)
    assert scores(again.fit(raw), raw) == want
    back = load_model(save_model(model, scratch_path(spark, "raw-model")))
    unlabelled = raw.drop("y", "week")
    assert scores(back, unlabelled) == want


def test_cohort_of_nulls_and_whole_table(raw):
    nulls = estimator(value=None)
    nulls.fit(raw)
    assert nulls.last_stats["cohort_original_n"] == raw.where("segment is null").count()
    whole = estimator()
    whole._set(cohortCol="")
    whole.fit(raw)
    assert whole.last_stats["original_n"] == raw.count()


def test_what_cannot_be_fitted_or_saved(spark, raw):
    class Unsavable(Estimator):
        def _fit(self, df):
            return None

    with pytest.raises(ValueError, match="cannot be saved"):
        RawSmoteEstimator(PR.TablePreprocessor(numericCols=["p"]), Unsavable()).write().save(scratch_path(spark, "never"))
    with pytest.raises(ValueError):
        estimator().fit(raw.drop("segment"))
    with pytest.raises(ValueError):
        estimator().fit(raw.withColumn("y", F.lit(None).cast("int")))


def test_rewritten_and_optional_tables(spark, raw):
    base = scratch_path(spark, "versions")
    first = TB.rewrite_versioned(raw, base, 1)
    second = TB.rewrite_versioned(TB.load_table(spark, first).drop("week"), base, 2)  # reads one version, writes the next
    assert TB.load_table(spark, first).columns == raw.columns
    assert "week" not in TB.load_table(spark, second).columns and TB.load_table(spark, second).count() == raw.count()
    assert TB.optional_table(spark, None) is None and TB.optional_table(spark, base + "/absent") is None
    assert TB.optional_table(spark, second).count() == raw.count()
    empty = TB.rewrite_versioned(raw.limit(0), base, 3)
    assert TB.optional_table(spark, empty).count() == 0
    with pytest.raises(TB.EmptyTableError):
        TB.load_table(spark, empty)
