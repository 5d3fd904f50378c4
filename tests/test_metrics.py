"""Metric arithmetic: golden replay of the published counts and edge cases."""

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.ratios import metric_columns
from cohortlens.operators import metrics as M
from cohortlens.plans import report as RP


def counts_frame(spark, tn, fp, fn, tp, extra=None):
    rows = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame(rows, "y_true int, y_pred int")


def test_global_validation_counts_replay(spark):
    # published OOF confusion: tn/fp/fn/tp = 4332/478/855/1975
    r = M.binary_metrics(counts_frame(spark, 4332, 478, 855, 1975)).first()
    assert r["n"] == 7640
    assert round(r["accuracy"], 4) == 0.8255
    assert round(r["precision"], 4) == 0.8051
    assert round(r["recall"], 4) == 0.6979
    assert round(r["f1"], 4) == 0.7477


def test_cohort_counts_replay(spark):
    # published cohort row: tn/fp/fn/tp = 664/8/120/12 -> precision .6, recall .0909
    r = M.binary_metrics(counts_frame(spark, 664, 8, 120, 12)).first()
    assert r["n"] == 804
    assert r["precision"] == pytest.approx(0.6)
    assert round(r["recall"], 4) == 0.0909
    assert round(r["f1"], 4) == 0.1579


def test_no_positive_prediction_gives_zero(spark):
    r = M.binary_metrics(counts_frame(spark, 5, 0, 3, 0)).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)
    assert r["accuracy"] == pytest.approx(5 / 8)


def test_null_cohort_value_is_left_out(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (0, 0, "a"), (1, 0, None), (0, 1, "b")], "y_true int, y_pred int, c string"
    )
    t = M.cohort_metrics(df, ["c"]).collect()
    assert sorted(r["cohort_value"] for r in t) == ["a", "b"]
    rest = df.where(~F.col("c").eqNullSafe("a"))  # complement keeps the null row
    assert rest.count() == 2


def test_small_cohort_not_ranked(spark):
    rows = [(1, 0, "small")] * 29 + [(1, 0, "big")] * 30
    t = M.cohort_metrics(spark.createDataFrame(rows, "y_true int, y_pred int, c string"), ["c"])
    assert [r["cohort_value"] for r in M.worst_cohorts(t).collect()] == ["big"]


def test_strategy_tie_prefers_cohort_f1(spark):
    comp = spark.createDataFrame(
        [("baseline", 0.7, 0.1), ("smote", 0.75, 0.2), ("real_data", 0.75, 0.3)],
        "strategy string, global_f1 double, cohort_f1 double",
    )
    assert RP.selected_strategy(comp).first()["strategy"] == "real_data"
    assert RP.selected_strategy(None, spark=spark).first()["strategy"] == "smote"


def test_golden_strategy_ranking(spark):
    # published CV comparison: real_data wins on global F1 (.7483 vs .7478)
    comp = spark.createDataFrame(
        [("real_data", 0.7483, 0.1911), ("smote", 0.7478, 0.1569), ("baseline", 0.7454, 0.1342), ("smote_cohort", 0.7415, 0.4030)],
        "strategy string, global_f1 double, cohort_f1 double",
    )
    order = [r["strategy"] for r in RP.rank_strategies(comp).orderBy("rank").collect()]
    assert order == ["real_data", "smote", "baseline", "smote_cohort"]


def test_counts_add_up(spark, smoke_dir):
    from cohortlens.plans.catalog import q_cohort_metrics

    for r in q_cohort_metrics(spark, smoke_dir).collect():
        assert r["tn"] + r["fp"] + r["fn"] + r["tp"] == r["n"]


def test_metric_columns_names():
    assert [c._jc.toString().split(" AS ")[-1].strip("`") for c in metric_columns("g_")][-1].endswith("g_f1")


def test_ranks_follow_unrounded_scores(spark):
    """Two F1 that round to the same six places: the counts decide, not the name."""
    cols = "strategy string, " + ", ".join(f"{s}_{c} {t}" for s in ("global", "cohort") for c, t in [("f1", "double"), ("tp", "long"), ("fp", "long"), ("fn", "long")])
    same = (0.5, 1, 1, 1)
    comp = spark.createDataFrame([("a", 0.666667, 2_000_000, 1_000_001, 1_000_000, *same), ("b", 0.666667, 2_000_000, 1_000_000, 1_000_000, *same)], cols)
    assert [r["strategy"] for r in RP.rank_strategies(comp).orderBy("rank").collect()] == ["b", "a"]
