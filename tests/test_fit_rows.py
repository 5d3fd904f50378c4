"""Learning curves are fitted on whole subsets; train scores cover the rows that were fitted."""

import pytest
from pyspark.ml import Estimator
from pyspark.sql import functions as F

from cohortlens.operators.estimators import BoundedFit
from cohortlens.plans import catalog as C
from cohortlens.plans import fits


class Counting(Estimator):
    """Records the sizes of the tables it is fitted on."""

    def __init__(self, inner, sizes):
        super().__init__()
        self.inner, self.sizes = inner, sizes

    def _fit(self, df):
        self.sizes.append(df.count())
        return self.inner.fit(df)


def test_curve_fits_grow(spark, smoke_dir, monkeypatch):
    """Were the curve bounded to FIT_ROWS, all its points would be fitted on about as many rows."""
    monkeypatch.setattr(C, "FIT_ROWS", 60)
    sizes = []
    real = C.forest

    def small(*args, **kw):
        return Counting(real("y_learn", "x", 2, 3), sizes)

    monkeypatch.setattr(C, "forest", small)
    got = C.q_learning_curve(spark, smoke_dir).collect()
    df, _ = C.rf_inputs(spark, smoke_dir)
    n, folds = df.count(), C.RF_FOLDS
    assert len(got) == 10 and len(sizes) == 10 * folds
    by_size = sorted(sizes)
    means = [sum(by_size[k * folds : (k + 1) * folds]) / folds for k in range(10)]
    assert all(a < b for a, b in zip(means, means[1:]))
    assert abs(means[-1] - n * (folds - 1) / folds) <= 2


def test_train_scores_cover_fitted_rows(spark, smoke_dir):
    df, extra = C.rf_inputs(spark, smoke_dir)
    learner = C.rf_learner(trees=2, depth=3)
    learner.estimator = BoundedFit(learner.estimator.estimator, 100)
    preds, stats = C.CV.strategy_cv(df, extra, learner, C.RF_SPEC, ["baseline", "smote_cohort"])
    preds = preds.cache()
    per = {(r.strategy, r.fold): r.n for r in preds.where("split = 'train'").groupBy("strategy", "fold").agg(F.count("*").alias("n")).collect()}
    assert len(per) == 2 * C.RF_FOLDS and all(50 <= n <= 150 for n in per.values())
    assert preds.where("split = 'val' AND strategy = 'baseline'").count() == df.count()
    rows = stats.collect()
    whole = {i: df.where(F.col("fold") != i).count() for i in range(1, C.RF_FOLDS + 1)}
    assert {r.fold: r.train_fold_n for r in rows} == whole
    assert all(r.fold_total_n_after_smote >= r.train_fold_n for r in rows)


@pytest.mark.parametrize("make", [lambda: C.rf_learner(trees=1, depth=1), lambda: C.lr_learner(), lambda: C.curve_learner(trees=1, depth=1)])
def test_models_are_fitted_on_every_row(spark, make):
    df = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 3 == 0).cast("int").alias("y_learn"), F.array(F.col("id") % 7.0).alias("x"))
    estimator, table = fits.fit_table(make().estimator, df)
    assert table.count() == 5000 and not fits.is_bounded(estimator)


def test_every_fold_row_gets_a_train_score(spark, smoke_dir, monkeypatch):
    """Train scores are those of the fitted rows: all rows of the other folds, extra and synthetic ones included."""
    df, extra = C.rf_inputs(spark, smoke_dir)
    df = C.CV.materialize(df.withColumn("row_id", F.explode(F.array(F.col("row_id"), F.col("row_id") + 10**10, F.col("row_id") + 2 * 10**10))), "three-times")
    preds, _ = C.CV.strategy_cv(df, extra, C.rf_learner(trees=1, depth=2), C.RF_SPEC, ["baseline", "real_data"])
    got = {(r.strategy, r.fold): r.n for r in preds.where("split = 'train'").groupBy("strategy", "fold").agg(F.count("*").alias("n")).collect()}
    more = {"baseline": 0, "real_data": extra.count()}
    assert df.count() > 3000
    assert got == {(s, i): df.where(F.col("fold") != i).count() + more[s] for s in more for i in range(1, C.RF_FOLDS + 1)}
