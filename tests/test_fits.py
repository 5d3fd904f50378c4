"""Fit tables, model store, baseline selection with a refit, and the protocols that use its parameters."""

import json

import pytest
from pyspark.sql import functions as F

from cohortlens.operators.estimators import BoundedFit, forest, logistic
from cohortlens.plans import catalog as C
from cohortlens.plans import fits
from cohortlens.plans import scoring as SC
from cohortlens.plans import selection as SEL
from cohortlens.session import scratch_path
from cohortlens.sources import tables as TB


def learner(estimator):
    return C.CV.Learner(BoundedFit(estimator, 150), C._prep_featurizer, "x", needs_vectors=True)


CANDIDATES = {
    "logistic_regression": (lambda p: learner(logistic("y_learn", "x", p["C"], p["balanced"], 20)), [{"C": 0.1, "balanced": False}, {"C": 1.0, "balanced": True}]),
    "random_forest": (lambda p: learner(forest("y_learn", "x", 3, p["depth"])), [{"depth": 2}, {"depth": 4}]),
}


@pytest.fixture(scope="module")
def inputs(spark, smoke_dir):
    df, extra = C.rf_inputs(spark, smoke_dir)
    return fits.materialize(df, "inputs"), extra


@pytest.fixture(scope="module")
def selected(spark, inputs):
    return SEL.select_baseline(inputs[0], CANDIDATES, C.RF_SPEC, C._preparer(), fits.ModelStore(spark))


def test_fit_table_is_stored_once_in_few_partitions(spark, monkeypatch):
    df = spark.range(1000).withColumnRenamed("id", "row_id").repartition(16)
    estimator, table = fits.fit_table(BoundedFit("inner", 100), df)
    assert estimator == "inner" and table.rdd.getNumPartitions() == 1 and 50 < table.count() < 150
    monkeypatch.setattr(fits, "ROWS_PER_TASK", 300)
    estimator, table = fits.fit_table("plain", df)
    assert estimator == "plain" and table.count() == 1000 and 1 < table.rdd.getNumPartitions() <= 4


def test_best_model_is_refitted_saved_and_reloaded(spark, inputs, selected):
    df, _ = inputs
    rows = {r.model: r for r in selected.comparison.collect()}
    best = [r for r in rows.values() if r.is_best]
    assert len(rows) == 2 and len(best) == 1 and best[0].model == selected.name and json.loads(best[0].best_params) == selected.params
    assert best[0].mean_cv_f1 == max(r.mean_cv_f1 for r in rows.values())
    again = SC.fit_final_model(df.drop("fold"), None, "baseline", selected.learner.estimator, C._preparer(), C.RF_SPEC)
    score = lambda m: {r.row_id: (r.prediction, round(r.probability, 9)) for r in SC.score(m, df).collect()}
    assert score(selected.load()) == score(selected.path) == score(again)


def test_means_are_taken_over_unrounded_scores(spark, inputs):
    best, scores = SEL.grid_search(inputs[0], {"random_forest": CANDIDATES["random_forest"]}, C.RF_SPEC)
    per = {}
    for r in scores.collect():
        f1 = 2 * r.tp / (2 * r.tp + r.fp + r.fn) if r.tp else 0.0
        assert abs(r.f1 - f1) < 1e-15
        per.setdefault(r.params, []).append(f1)
    row = best.first()
    assert row.mean_cv_f1 == round(max(sum(v) / len(v) for v in per.values()), 6)


def test_models_in_a_store(spark, selected, tmp_path):
    store = fits.ModelStore(spark, f"file://{tmp_path}/models/")
    assert "a" not in store
    with pytest.raises(KeyError):
        store.load("a")
    store.save("a", selected.load())
    assert "a" in store and store.load("a").stages


def test_augmentation_with_the_selected_parameters(spark, inputs, selected):
    """One preparation fitted on train; extra rows alone are the cohort of real_data."""
    df, extra = inputs
    fitted = []

    def prepare(train):
        fitted.append(train.count())
        return C._prep_featurizer(train)

    how = C.CV.Learner(selected.learner.estimator, prepare, "x", needs_vectors=True)
    got = {r.strategy: r for r in C.CV.augmentation_comparison(df.drop("fold"), extra, how, C.RF_SPEC).collect()}
    assert fitted == [df.count()]
    assert got["baseline"].global_n == df.count() and got["real_data"].global_n == df.count() + extra.count() and got["real_data"].cohort_n == extra.count()
    assert got["smote"].global_n >= df.count() and got["smote"].cohort_n == got["baseline"].cohort_n


def test_final_predictions_and_metadata(spark, inputs, smoke_dir):
    df, extra = inputs
    _, test = C.split_tables(spark, smoke_dir)
    model = SC.fit_final_model(df.drop("fold"), extra, "real_data", BoundedFit(forest("y_learn", "x", 3, 3), 150), C._preparer(), C.RF_SPEC)
    preds = fits.scored([SC.final_predictions(model, test, C.RF_SPEC, "real_data")])
    rows = preds.collect()
    assert len(rows) == test.count() and all(r.is_error == (r.y_true != r.y_pred) and 0 <= r.probability <= 1 for r in rows)
    said = json.loads(SC.final_metadata(preds, df, extra, C.RF_SPEC, "real_data").first().metadata)
    assert said["train_n"] == df.count() and said["extra_n"] == extra.count() and said["test_n"] == len(rows)
    assert said["test_errors"] == sum(r.is_error for r in rows) and said["strategy"] == "real_data" and said["test_used_once"]
    assert json.loads(SC.final_metadata(preds, df, extra, C.RF_SPEC, "smote").first().metadata)["extra_n"] == 0


def test_rewrite_goes_to_a_new_version(spark):
    """A table is cleaned and written beside its source, which stays readable."""
    base = scratch_path(spark, "rewrite")
    df = spark.range(20).select("id", (F.col("id") * 2).alias("twice"), F.lit(1).alias("drop_me"))
    first = TB.rewrite_versioned(df, base, 1)
    second = TB.rewrite_versioned(TB.load_table(spark, first).drop("drop_me").where("id > 4"), base, 2)
    back = TB.load_table(spark, second)
    assert first != second and back.columns == ["id", "twice"] and back.count() == 15
    assert TB.load_table(spark, first).count() == 20 and "drop_me" in TB.load_table(spark, first).columns


def test_optional_source(spark):
    path = scratch_path(spark, "extra")
    assert TB.optional_table(spark, path) is None
    spark.range(3).write.parquet(path)
    assert TB.optional_table(spark, path).count() == 3
