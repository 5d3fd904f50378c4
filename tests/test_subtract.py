"""Protocols by subtraction against the ones that copy rows."""

import random

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import split as SP
from cohortlens.operators.estimators import GroupRateClassifier
from cohortlens.plans import crossval as CV
from cohortlens.plans import subtract as SUB

COLS = ["strategy", "fold", "split", "row_id", "syn_j", "y_true", "y_pred", "segment", "origin"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def learner():
    feat = lambda train: (lambda df: df.withColumn("x", F.array(F.lit(0.0))))
    return CV.Learner(GroupRateClassifier(groupCols=["segment", "grade"], labelCol="y"), feat, "x", needs_vectors=False, stateless_features=True)


SPEC = CV.Spec(target="y", cohort_column="segment", cohort_value="b", k=4, seed=7, carry=["grade"])


@pytest.fixture(scope="module")
def tables(spark):
    """A third of the rows in one group, null groups, a group that only extra rows have, a cohort of few rows of label 1."""
    rng = random.Random(3)
    seg = lambda: rng.choice(["a", "a", "b", "c", None])
    rows = []
    for i in range(400):
        s = "a" if i % 3 == 0 else seg()
        rows.append((i, int(rng.random() < (0.04 if s == "b" else 0.35)), s, rng.choice(["x", "y"])))
    extra = [(1000 + i, i % 2, rng.choice(["b", "new"]), "x") for i in range(40)]
    schema = "row_id long, y int, segment string, grade string"
    df = spark.createDataFrame(rows, schema).repartition(5)
    return SP.add_folds(df, "y", 4, 7), spark.createDataFrame(extra, schema)


def copying(monkeypatch):
    monkeypatch.setattr(CV.Learner, "countable", property(lambda self: False))


@pytest.mark.parametrize("with_extra", [True, False])
def test_strategy_cv_equals_the_copying_protocol(tables, monkeypatch, with_extra):
    df, extra = tables
    extra = extra if with_extra else None
    p, s = CV.strategy_cv(df, extra, learner(), SPEC)
    copying(monkeypatch)
    q, t = CV.strategy_cv(df, extra, learner(), SPEC)
    assert rows_of(p.select(*COLS)) == rows_of(q.select(*COLS))
    assert rows_of(s.select(*sorted(s.columns))) == rows_of(t.select(*sorted(t.columns)))
    assert p.where("syn_j > 0 and strategy = 'smote'").count() > 0


def test_learning_curve_and_augmentation_equal_the_copying_protocol(tables, monkeypatch):
    df, extra = tables
    curve, aug = rows_of(CV.learning_curve(df, learner(), SPEC)), rows_of(CV.augmentation_comparison(df.drop("fold"), extra, learner(), SPEC))
    copying(monkeypatch)
    assert curve == rows_of(CV.learning_curve(df, learner(), SPEC))
    assert aug == rows_of(CV.augmentation_comparison(df.drop("fold"), extra, learner(), SPEC))


def test_ranks_with_a_fold_left_out(tables):
    df, _ = tables
    cond = F.col("segment") == "a"
    got = {r["row_id"]: r["r"] for r in SP.fold_out_ranks(df, 4, {"r": cond}, ["y"], 7, "row_id", "fold", salt="smote").collect()}
    for i in range(1, 5):
        want = {r["row_id"]: r["p"] for r in SP.hashed_rank(df.where(cond & (F.col("fold") != i)), ["y"], 7, "row_id", "p", salt="smote").collect()}
        assert {key: r[i - 1] for key, r in got.items() if r[i - 1] is not None} == want


def test_subset_counts_are_nested_cuts(tables):
    df, _ = tables
    cells, sizes = SUB.subset_cells(df, ["y"], 4, SP.FRACTIONS, 50, 7, "row_id")
    got = {(r["eval_fold"], r["position"], r["y"]): r["c"] for r in SUB.subset_counts(cells, ["y"], 10).collect()}
    long = SP.fold_membership(df, 4).where("split = 'train'")
    want = {}
    for r in SP.learning_subsets(long, ["eval_fold"], SP.FRACTIONS, 50, 7).groupBy("eval_fold", "fraction", "subset_n", "y").count().collect():
        at = SP.FRACTIONS.index(r["fraction"])
        want[(r["eval_fold"], at, r["y"])] = r["count"]
        assert sizes[r["eval_fold"] - 1][at] == r["subset_n"]
    assert got == want


def test_written_bytes_stay_below_three_inputs(spark, smoke_dir, monkeypatch):
    from cohortlens.plans import catalog as C
    from cohortlens.plans import fits
    from cohortlens.session import scratch_path, stored_bytes

    df, extra = C.rate_inputs(spark, smoke_dir)
    path, written = scratch_path(spark, "size"), []
    df.unionByName(extra, allowMissingColumns=True).coalesce(1).write.parquet(path)

    def spy(df, name, partition_by=None):
        at = scratch_path(spark, name)
        df.coalesce(1).write.parquet(at)  # one file: bytes of rows, not of file footers
        written.append(stored_bytes(spark, at))
        return spark.read.parquet(at)

    monkeypatch.setattr(SUB, "materialize", spy)
    preds, _ = CV.strategy_cv(df, extra, C.rate_learner(), C.RATE_SPEC)
    assert preds.count() > 15 * df.count()
    assert len(written) == 3 and sum(written) <= 3 * stored_bytes(spark, path)
    assert fits.materialize is not spy
