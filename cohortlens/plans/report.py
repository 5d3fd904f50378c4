"""Report tables behind the reference's charts (drawing is not built).

Inputs are the comparison, fold-metric and fold-stat tables of
``plans.crossval``; all are small (one row per strategy or fold), and every
function is a DataFrame expression over them.  Whole-table references to a
baseline row use a window over the small table instead of a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.ratios import safe_ratio
from cohortlens.operators.validate import require_strategy_column

ORDER = ["baseline", "real_data", "smote", "smote_cohort"]  # fixed display order
METRICS = ["accuracy", "precision", "recall", "f1"]


def _f1(comparison: DataFrame, scope: str) -> Column:
    """F1 as the counts give it, unrounded; a table without counts is taken at its F1."""
    tp, fp, fn = (F.col(f"{scope}_{c}") for c in ("tp", "fp", "fn"))
    if not {f"{scope}_{c}" for c in ("tp", "fp", "fn")} <= set(comparison.columns):
        return F.col(f"{scope}_f1")
    return safe_ratio(2 * tp, 2 * tp + fp + fn, None)


def rank_strategies(comparison: DataFrame) -> DataFrame:
    """global F1 desc, then cohort F1 desc (then name), both unrounded; rank 1 = recommended."""
    w = Window.partitionBy(F.lit(0)).orderBy(_f1(comparison, "global").desc(), _f1(comparison, "cohort").desc(), "strategy")
    return comparison.withColumn("rank", F.row_number().over(w).cast("int"))


def selected_strategy(comparison: DataFrame | None, default: str = "smote", spark=None) -> DataFrame:
    """The top-ranked strategy, or ``default`` when no comparison exists."""
    if comparison is None:
        return spark.createDataFrame([(default, "default")], "strategy string, source string")
    require_strategy_column(comparison)
    top = rank_strategies(comparison).where("rank = 1")
    return top.select("strategy", F.lit("comparison").alias("source"))


def strategy_deltas(comparison: DataFrame, metrics=("global_accuracy", "global_precision", "global_recall", "global_f1")) -> DataFrame:
    """Each non-baseline strategy minus the baseline, strongest global F1 first."""
    w = Window.partitionBy(F.lit(0))
    cols = []
    for m in metrics:
        base = F.max(F.when(F.col("strategy") == "baseline", F.col(m))).over(w)
        cols.append(F.round(F.col(m) - base, 6).alias(f"delta_{m}"))
    out = comparison.select("strategy", "global_f1", *cols)
    return out.where(F.col("strategy") != "baseline").orderBy(F.col("global_f1").desc(), "strategy")


def strategy_long(comparison: DataFrame, order=ORDER) -> DataFrame:
    """(position, strategy, scope, metric, value) in the fixed strategy order."""
    pos = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("strategy")).cast("int")
    present = comparison.withColumn("position", pos).where(F.col("position") > 0)
    cols = [f"{scope}_{m}" for scope in ("global", "cohort") for m in [*METRICS, "tn", "fp", "fn", "tp"]]
    casted = present.select("position", "strategy", *[F.col(c).cast("double").alias(c) for c in cols])
    long = casted.unpivot(["position", "strategy"], cols, "name", "value")
    return long.select(
        "position", "strategy",
        F.split("name", "_", 2)[0].alias("scope"),
        F.split("name", "_", 2)[1].alias("metric"),
        "value",
    )


def display_3dp(c) -> "F.Column":
    """A ratio as display text with 3 decimals (via decimal, half up)."""
    return F.round(F.col(c).cast("decimal(20,10)"), 3).cast("decimal(14,3)").cast("string")


def strategy_table(comparison: DataFrame, sizes: DataFrame, order=ORDER) -> DataFrame:
    """Per strategy in the fixed order: fit sizes (per fit, mean over folds)
    and the headline scores as 3-decimal display text."""
    pos = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("strategy")).cast("int")
    present = comparison.withColumn("position", pos).where(F.col("position") > 0)
    out = present.join(sizes, "strategy", "inner")  # both one row per strategy
    return out.select(
        "position", "strategy", "fit_n_mean", "cohort_original_n_mean", "added_n_mean", "cohort_total_n_mean",
        display_3dp("global_f1").alias("global_f1"), display_3dp("cohort_recall").alias("cohort_rec"),
        display_3dp("cohort_f1").alias("cohort_f1"),
    ).orderBy("position")


def train_val_by_strategy(fold_metrics: DataFrame) -> DataFrame:
    """Mean and sample std over folds of the 8 train/val ratios."""
    cols = [f"{s}_{m}" for s in ("train", "val") for m in METRICS]
    aggs = []
    for c in cols:
        aggs += [F.round(F.avg(c), 6).alias(f"{c}_mean"), F.round(F.stddev_samp(c), 6).alias(f"{c}_std")]
    return fold_metrics.groupBy("strategy").agg(F.count(F.lit(1)).alias("n_folds"), *aggs)


def smote_summary(fold_stats: DataFrame) -> DataFrame:
    """Synthetic rows per fold (mean / min / max, total over folds) and the mean sizes they came from."""
    s = F.col("cohort_synthetic_n")
    sizes = ["train_fold_n", "cohort_fold_n", "cohort_original_n", "cohort_resampled_n"]
    return fold_stats.groupBy("strategy").agg(
        F.count(F.lit(1)).alias("n_folds"),
        F.round(F.avg(s), 6).alias("synthetic_mean"),
        F.min(s).alias("synthetic_min"),
        F.max(s).alias("synthetic_max"),
        F.sum(s).alias("synthetic_total"),
        F.round(F.avg("fold_total_n_after_smote"), 6).alias("fold_total_mean"),
        *[F.round(F.avg(c), 6).alias(f"{c.removesuffix('_n')}_mean") for c in sizes],
    )


def strategy_sizes(predictions: DataFrame, in_cohort) -> DataFrame:
    """Per strategy, mean over folds of one fit's rows: total, cohort rows
    before augmentation, rows added (extra or synthetic) and cohort total.

    Reported per fit, not summed over folds.
    """
    fit = predictions.where(F.col("split") == "train")
    real = F.col("origin") == "train"
    added = F.col("origin").isin("extra", "synthetic")
    per = fit.groupBy("strategy", "fold").agg(
        F.count(F.lit(1)).alias("fit_n"),
        F.count_if(real & in_cohort).alias("cohort_original_n"),
        F.count_if(added).alias("added_n"),
        F.count_if(in_cohort).alias("cohort_total_n"),
    )
    return per.groupBy("strategy").agg(
        *[F.round(F.avg(c), 6).alias(f"{c}_mean") for c in ["fit_n", "cohort_original_n", "added_n", "cohort_total_n"]]
    )


def cohort_breakdown(train: DataFrame, extra: DataFrame, target: str, in_cohort) -> DataFrame:
    """Cohort composition by source with a combined total (ROLLUP)."""
    t = train.where(in_cohort).select(F.lit("train").alias("source"), target)
    e = extra.where(in_cohort).select(F.lit("extra").alias("source"), target)
    u = t.unionByName(e)
    r = u.rollup("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(target) == 1).alias("positives"))
    return r.select(
        F.coalesce("source", F.lit("combined")).alias("source"),
        "n",
        "positives",
        (F.col("n") - F.col("positives")).alias("negatives"),
        safe_ratio(F.col("positives"), F.col("n")).alias("positive_rate"),
    )


def cohort_summary(cohort_table: DataFrame) -> DataFrame:
    """Per feature, cohorts by recall asc then n desc, with their position."""
    w = Window.partitionBy("cohort_feature").orderBy(F.col("recall").asc(), F.col("n").desc(), "cohort_value")
    return cohort_table.select(
        "cohort_feature", "cohort_value", "n", "positive_rate", "recall", "tn", "fp", "fn", "tp"
    ).withColumn("position", F.row_number().over(w).cast("int"))


def best_strategy_tvt(fold_metrics: DataFrame, test_metrics: DataFrame, strategy: DataFrame) -> DataFrame:
    """For the selected strategy: fold-mean train, fold-mean val and test, per metric."""
    fm = fold_metrics.join(strategy.select("strategy"), "strategy", "left_semi")
    means = fm.agg(*[F.avg(f"{s}_{m}").alias(f"{s}_{m}") for s in ("train", "val") for m in METRICS])
    tm = test_metrics.select(*[F.col(m).alias(f"test_{m}") for m in METRICS])
    parts = []
    for m in METRICS:
        parts.append(F.struct(F.lit(m).alias("metric"), F.round(F.col(f"train_{m}"), 6).alias("train"), F.round(F.col(f"val_{m}"), 6).alias("val")))
    long = means.select(F.inline(F.array(*parts)))
    tl = tm.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.round(F.col(f"test_{m}"), 6).alias("test")) for m in METRICS])))
    return long.join(tl, "metric", "inner")


def final_vs_cohort(row: DataFrame) -> DataFrame:
    """A global-vs-cohort row unpivoted to (metric, global, cohort)."""
    parts = [
        F.struct(F.lit(m).alias("metric"), F.col(f"global_{m}").alias("global_value"), F.col(f"cohort_{m}").alias("cohort_value"))
        for m in METRICS
    ]
    return row.select(F.inline(F.array(*parts)))
