"""Confusion-matrix metrics: global, per cohort, per fold, cohort beside global."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.ratios import DIGITS, confusion_aggs, metric_columns, safe_ratio

METRICS = ["accuracy", "precision", "recall", "f1"]
COUNTS = ["tn", "fp", "fn", "tp"]


def error_flags(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    return df.withColumn("is_error", F.col(y_true) != F.col(y_pred))


def false_positives(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    return df.where((F.col(y_pred) == 1) & (F.col(y_true) == 0))


def false_negatives(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    return df.where((F.col(y_pred) == 0) & (F.col(y_true) == 1))


def binary_metrics(
    df: DataFrame,
    by: list[str] | None = None,
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    digits: int | None = DIGITS,
    weight: str | None = None,
) -> DataFrame:
    """n, accuracy, precision, recall, f1, tn, fp, fn, tp (per group of ``by``).

    One hash aggregate; partial counts are combined map-side, so a hot group
    costs no more shuffle than a cold one.
    """
    by = by or []
    agg = df.groupBy(*by).agg(*confusion_aggs(y_true, y_pred, weight=weight))
    return agg.select(*by, "n", *metric_columns("", digits), *COUNTS)


def cohort_long(df: DataFrame, cohorts: list[str]) -> DataFrame:
    """Unpivot the cohort columns to (cohort_feature, cohort_value); nulls dropped."""
    keep = [c for c in df.columns if c not in cohorts]
    casted = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in cohorts])
    long = casted.unpivot(keep, cohorts, "cohort_feature", "cohort_value")
    return long.where(F.col("cohort_value").isNotNull())


def cohort_metrics(
    df: DataFrame,
    cohorts: list[str],
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    digits: int | None = DIGITS,
) -> DataFrame:
    """Metrics for every (cohort column, non-null value) in a single pass."""
    long = cohort_long(df.select(y_true, y_pred, *cohorts), cohorts)
    order = F.array_position(F.array(*[F.lit(c) for c in cohorts]), F.col("cohort_feature"))
    agg = long.groupBy("cohort_feature", "cohort_value").agg(
        *confusion_aggs(y_true, y_pred), F.count_if(F.col(y_true) == 1).alias("_pos")
    )
    return agg.select(
        "cohort_feature",
        "cohort_value",
        "n",
        safe_ratio(F.col("_pos"), F.col("n"), digits).alias("positive_rate"),
        *metric_columns("", digits),
        *COUNTS,
        order.alias("_feature_order"),
    ).orderBy("_feature_order", "cohort_value").drop("_feature_order")


def worst_cohorts(cohort_table: DataFrame, min_n: int = 30, top: int = 15) -> DataFrame:
    """Cohorts with support >= min_n, lowest F1 first (ties: larger n, then key)."""
    return (
        cohort_table.where(F.col("n") >= min_n)
        .orderBy(F.col("f1").asc(), F.col("n").desc(), "cohort_feature", "cohort_value")
        .limit(top)
    )


def global_vs_cohort(
    df: DataFrame,
    cohort_column: str,
    cohort_value,
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    by: list[str] | None = None,
    digits: int | None = DIGITS,
) -> DataFrame:
    """Global metrics and one named cohort's metrics as one row (one aggregate)."""
    by = by or []
    in_cohort = F.col(cohort_column).eqNullSafe(F.lit(cohort_value))
    agg = df.groupBy(*by).agg(
        *confusion_aggs(y_true, y_pred, prefix="global_"),
        *confusion_aggs(y_true, y_pred, where=in_cohort, prefix="cohort_"),
    )
    return agg.select(
        *by,
        "global_n",
        *metric_columns("global_", digits),
        *[f"global_{c}" for c in COUNTS],
        F.lit(cohort_column).alias("cohort_column"),
        F.lit(str(cohort_value)).alias("cohort_value"),
        "cohort_n",
        *metric_columns("cohort_", digits),
        *[f"cohort_{c}" for c in COUNTS],
    )


def metrics_row(
    df: DataFrame,
    prefix: str,
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    digits: int = 4,
    where: Column | None = None,
) -> list:
    """Reduced, rounded, prefixed metrics (no tn): accuracy..f1, fp, fn, tp, n.

    Returns (aggregate expressions, select expressions) so several prefixed
    rows can share one aggregate pass.
    """
    aggs = confusion_aggs(y_true, y_pred, where=where, prefix=prefix)
    sel = [*metric_columns(prefix, digits), *[F.col(f"{prefix}{c}") for c in ["fp", "fn", "tp", "n"]]]
    return [aggs, sel]


def metrics_rows(df: DataFrame, specs: list, by: list[str] | None = None) -> DataFrame:
    """One aggregate for several ``metrics_row`` specs side by side."""
    by = by or []
    aggs = [a for s in specs for a in s[0]]
    sels = [c for s in specs for c in s[1]]
    return df.groupBy(*by).agg(*aggs).select(*by, *sels)


def class_balance(df: DataFrame, target: str, by: list[str] | None = None) -> DataFrame:
    """Class counts per group: distinct classes, minority and majority size."""
    by = by or []
    counts = df.groupBy(*by, target).agg(F.count(F.lit(1)).alias("_c"))
    return counts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.min("_c").alias("minority_n"),
        F.max("_c").alias("majority_n"),
        F.sum("_c").alias("n"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
