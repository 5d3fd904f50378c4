"""Confusion counts and the ratios derived from them.

Ratios follow ``zero_division=0``: an empty denominator gives 0, never an
error (ANSI mode is on) and never NaN.  Ratios are rounded to ``digits`` so
that results are stable across engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 6


def safe_ratio(num: Column, den: Column, digits: int | None = DIGITS) -> Column:
    r = F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
    return F.round(r, digits) if digits is not None else r


def confusion_aggs(
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    where: Column | None = None,
    prefix: str = "",
    weight: str | None = None,
) -> list[Column]:
    """n, tn, fp, fn, tp as aggregate expressions (labels fixed to 0/1).

    ``weight`` names a column that says how many rows a row stands for.
    """
    t, p = F.col(y_true), F.col(y_pred)
    cond = (lambda c: c & where) if where is not None else (lambda c: c)
    count = F.count_if if weight is None else (lambda c: F.coalesce(F.sum(F.when(c, F.col(weight))), F.lit(0)).cast("long"))
    return [
        count(cond(F.lit(True))).alias(f"{prefix}n"),
        count(cond((t == 0) & (p == 0))).alias(f"{prefix}tn"),
        count(cond((t == 0) & (p == 1))).alias(f"{prefix}fp"),
        count(cond((t == 1) & (p == 0))).alias(f"{prefix}fn"),
        count(cond((t == 1) & (p == 1))).alias(f"{prefix}tp"),
    ]


def metric_columns(prefix: str = "", digits: int | None = DIGITS) -> list[Column]:
    """accuracy, precision, recall, f1 from the count columns of ``confusion_aggs``."""
    c = lambda name: F.col(f"{prefix}{name}")
    tp, tn, fp, fn, n = c("tp"), c("tn"), c("fp"), c("fn"), c("n")
    return [
        safe_ratio(tp + tn, n, digits).alias(f"{prefix}accuracy"),
        safe_ratio(tp, tp + fp, digits).alias(f"{prefix}precision"),
        safe_ratio(tp, tp + fn, digits).alias(f"{prefix}recall"),
        safe_ratio(2 * tp, 2 * tp + fp + fn, digits).alias(f"{prefix}f1"),
    ]
