"""Validation of labelled tables (required columns, target domain, parity)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SHOWN_VALUES = 20  # in an error message, which gives the full count


class ValidationError(ValueError):
    pass


def require_columns(df: DataFrame, required) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValidationError(f"The table lacks columns that are needed: {missing}")


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """One aggregate: rows, null targets, targets outside {0, 1}."""
    t = F.col(target)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(t.isNull()).alias("n_null"),
        F.count_if(t.isNotNull() & ~t.isin(0, 1)).alias("n_invalid"),
        F.count_if(t == 1).alias("n_positive"),
    ).withColumn("valid", (F.col("n_null") == 0) & (F.col("n_invalid") == 0))


def validate(df: DataFrame, target: str, cohorts=()) -> DataFrame:
    """Raise on a missing column, a null target or a non-binary target.

    Returns ``df`` unchanged so the call can sit inside a chain.  The check
    costs one small aggregate job (a single result row reaches the driver).
    """
    require_columns(df, {target, *cohorts})
    s = target_summary(df, target).first()
    if s["n_null"]:
        raise ValidationError(f"{s['n_null']} rows have no value in target column {target}")
    if s["n_invalid"]:
        bad = df.where(~F.col(target).isin(0, 1)).groupBy(target).count()
        kinds = bad.count()
        shown = [r[0] for r in bad.orderBy(target).limit(SHOWN_VALUES).collect()]
        more = f" (the first {SHOWN_VALUES} are shown)" if kinds > SHOWN_VALUES else ""
        raise ValidationError(f"{s['n_invalid']} rows of target column {target} are neither 0 nor 1; {kinds} other values{more}: {shown}")
    return df


def require_strategy_column(df: DataFrame, column: str = "strategy") -> None:
    if column not in df.columns:
        raise ValidationError(f"The strategy comparison has no column {column}")


def row_parity(left: DataFrame, right: DataFrame, key: str = "row_id") -> DataFrame:
    """Full outer join on the key: counts of matched and unmatched rows."""
    lk = left.select(F.col(key).alias("_k")).withColumn("_l", F.lit(1))
    rk = right.select(F.col(key).alias("_k")).withColumn("_r", F.lit(1))
    j = lk.join(rk, "_k", "full_outer")
    return j.agg(
        F.count_if(F.col("_l").isNotNull()).alias("n_left"),
        F.count_if(F.col("_r").isNotNull()).alias("n_right"),
        F.count_if(F.col("_r").isNull()).alias("only_left"),
        F.count_if(F.col("_l").isNull()).alias("only_right"),
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("n_both"),
    ).withColumn("parity", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def assert_parity(left: DataFrame, right: DataFrame, key: str = "row_id") -> None:
    r = row_parity(left, right, key).first()
    if not r["parity"]:
        raise ValidationError(
            f"Row mismatch: {r['only_left']} rows only left, {r['only_right']} only right."
        )


def assert_complete(train: DataFrame, predictions: DataFrame, key: str = "row_id", strategies=None) -> None:
    """Every training row has a prediction, one of each of ``strategies`` if they are given.

    One aggregate by key: keys meet on the executors and never reach the driver, as they would if a join
    took one side for small enough to broadcast.  A null key matches no prediction.
    """
    names = list(strategies) if strategies is not None else None
    if names is not None and not names:
        return
    bit = F.lit(1) if names is None else sum((F.when(F.col("strategy") == s, 1 << i).otherwise(0) for i, s in enumerate(names)), F.lit(0))
    every = 1 if names is None else (1 << len(names)) - 1
    both = train.select(F.col(key).alias("_k"), F.lit(True).alias("_row"), F.lit(0).alias("_bits")).unionByName(
        predictions.select(F.col(key).alias("_k"), F.lit(False).alias("_row"), F.coalesce(bit, F.lit(0)).alias("_bits"))
    )
    per = both.groupBy("_k").agg(F.bool_or("_row").alias("_row"), F.bit_or("_bits").alias("_bits"))
    if not per.where(F.col("_row") & (F.col("_k").isNull() | (F.col("_bits") != every))).isEmpty():
        raise RuntimeError("There are training rows that no fold model has scored")
