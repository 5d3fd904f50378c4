"""Stratified ranks, splits, folds and nested learning subsets.

All randomness is ``md5(seed:row_id)``, so results do not depend on row
order or partitioning.  A plain ``row_number()`` over ``partitionBy(class)``
would put each class into one task; ``hashed_rank`` instead buckets rows by
the leading hex digits of the same hash (order preserving), numbers rows
inside each (group, bucket) and adds the size of all earlier buckets.  The
per-bucket count table is bounded by groups x 16^digits rows, which is what
gets broadcast.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.hashing import hash_hex
from cohortlens.operators.joins import broadcast_if_small
from cohortlens.operators.validate import validate


BUCKET_ROWS = 20_000


def hashed_rank(
    df: DataFrame,
    partition_cols: list[str],
    seed: int = 42,
    key: str = "row_id",
    rank_col: str = "rank",
    digits: int | None = None,
    salt: str | None = None,
) -> DataFrame:
    """Exact ``row_number() over (partition by P order by md5(seed:key), key)``.

    Buckets follow the row count (about ``BUCKET_ROWS`` rows each), so a group
    of any size is numbered by many tasks.  Null group values are a group.
    """
    if digits is None:
        digits = max(1, math.ceil(math.log(max(1, df.count() / BUCKET_ROWS), 16)))
    parts = [F.col(key)] if salt is None else [F.lit(salt), F.col(key)]
    h = hash_hex(seed, *parts)
    tagged = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, digits))
    counts = tagged.groupBy(*partition_cols, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w_off = Window.partitionBy(*partition_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*partition_cols, "_b", F.coalesce(F.sum("_c").over(w_off), F.lit(0)).alias("_off"))
    # (#groups) x 16^digits rows
    offsets = broadcast_if_small(offsets.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(partition_cols)], F.col("_b").alias("_ob"), "_off"))
    same = F.col("_b") == F.col("_ob")
    for i, c in enumerate(partition_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    joined = tagged.join(offsets, same, "inner").drop("_ob", *[f"_g{i}" for i in range(len(partition_cols))])
    w = Window.partitionBy(*partition_cols, "_b").orderBy("_h", key)
    return joined.withColumn(rank_col, (F.col("_off") + F.row_number().over(w)).cast("long")).drop("_h", "_b", "_off")


def fold_out_ranks(
    df: DataFrame,
    k: int,
    counted: dict,
    partition_cols: list[str],
    seed: int = 42,
    key: str = "row_id",
    fold_col: str = "fold",
    salt: str | None = None,
) -> DataFrame:
    """Ranks by hash with one fold left out, for all folds in one pass and without copies of rows.

    ``counted`` maps a new column to a condition.  The column is an array over folds: entry
    i - 1 is ``hashed_rank`` among the rows of the group that hold the condition and
    are not of fold i; null where the row itself is not counted.
    """
    digits = max(1, math.ceil(math.log(max(1, df.count() / BUCKET_ROWS), 16)))
    h = hash_hex(seed, *([F.col(key)] if salt is None else [F.lit(salt), F.col(key)]))
    tagged = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, digits))
    held = {(c, i): F.coalesce(cond, F.lit(False)) & (F.col(fold_col) != i) for c, cond in counted.items() for i in range(1, k + 1)}
    names = {x: f"_c{j}" for j, x in enumerate(held)}
    counts = tagged.groupBy(*partition_cols, "_b").agg(*[F.count_if(cond).alias(names[x]) for x, cond in held.items()])
    before = Window.partitionBy(*(partition_cols or [F.lit(0)])).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(partition_cols)], F.col("_b").alias("_ob"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in names.values()],
    )
    offsets = broadcast_if_small(offsets)  # (#groups) x 16^digits rows
    same = F.col("_b") == F.col("_ob")
    for i, c in enumerate(partition_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    joined = tagged.join(offsets, same, "inner")
    w = Window.partitionBy(*partition_cols, "_b").orderBy("_h", key).rowsBetween(Window.unboundedPreceding, 0)
    rank = {x: F.when(cond, F.col(names[x]) + F.sum(F.when(cond, 1).otherwise(0)).over(w)) for x, cond in held.items()}
    return joined.select(*df.columns, *[F.array(*[rank[(c, i)] for i in range(1, k + 1)]).alias(c) for c in counted])


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n_class"))


def split_quotas(df: DataFrame, target: str, test_size: float) -> DataFrame:
    """Test rows per class: n_test = ceil(n * test_size), largest remainder.

    Computed on the class-count table (one row per class).
    """
    cc = class_counts(df, target)
    w_all = Window.partitionBy(F.lit(0))
    ts = F.lit(Decimal(str(test_size)))
    q = cc.withColumn("_n", F.sum("n_class").over(w_all))
    q = q.withColumn("_ntest", F.ceil(F.col("_n") * ts).cast("long"))
    q = q.withColumn("_floor", F.expr("(_ntest * n_class) div _n").cast("long"))
    q = q.withColumn("_rem", (F.col("_ntest") * F.col("n_class")) % F.col("_n"))
    q = q.withColumn("_left", F.col("_ntest") - F.sum("_floor").over(w_all))
    w_rem = Window.partitionBy(F.lit(0)).orderBy(F.col("_rem").desc(), F.col(target))
    q = q.withColumn("_r", F.row_number().over(w_rem))
    q = q.withColumn("test_quota", F.col("_floor") + F.when(F.col("_r") <= F.col("_left"), 1).otherwise(0))
    return q.select(target, "n_class", "test_quota")


def stratified_split(
    df: DataFrame, target: str, test_size: float = 0.2, seed: int = 42, key: str = "row_id"
) -> DataFrame:
    """Adds ``split`` in {'train', 'test'}: exact class quotas, hash order."""
    validate(df, target)
    ranked = hashed_rank(df, [target], seed, key, "_rank")
    quotas = split_quotas(df, target, test_size).select(target, "test_quota")
    out = ranked.join(F.broadcast(quotas), target, "inner")
    return out.withColumn(
        "split", F.when(F.col("_rank") <= F.col("test_quota"), "test").otherwise("train")
    ).drop("_rank", "test_quota")


def add_folds(df: DataFrame, target: str, k: int = 5, seed: int = 42, key: str = "row_id", fold_col: str = "fold") -> DataFrame:
    """Stratified, shuffled k folds numbered 1..k.

    Rows of each class are dealt round-robin in hash order; each class starts
    where the previous one stopped, so fold sizes and per-class counts are
    within one of each other.
    """
    validate(df, target)
    ranked = hashed_rank(df, [target], seed, key, "_rank", salt="fold")
    cc = class_counts(df, target)
    w = Window.partitionBy(F.lit(0)).orderBy(target).rowsBetween(Window.unboundedPreceding, -1)
    offs = cc.select(target, F.coalesce(F.sum("n_class").over(w), F.lit(0)).alias("_coff"))
    out = ranked.join(F.broadcast(offs), target, "inner")
    return out.withColumn(fold_col, ((F.col("_coff") + F.col("_rank") - 1) % k + 1).cast("int")).drop("_rank", "_coff")


def fold_membership(df: DataFrame, k: int, fold_col: str = "fold") -> DataFrame:
    """Long (eval_fold, split, row...) table: each row is 'val' once, 'train' k-1 times."""
    out = df.withColumn("eval_fold", F.explode(F.sequence(F.lit(1), F.lit(k))))
    return out.withColumn("split", F.when(F.col(fold_col) == F.col("eval_fold"), "val").otherwise("train"))


FRACTIONS = [Decimal(i) / 10 for i in range(1, 11)]


def learning_subsets(
    fold_train: DataFrame,
    group_cols: list[str],
    fractions=FRACTIONS,
    min_rows: int = 50,
    seed: int = 42,
    key: str = "row_id",
) -> DataFrame:
    """Nested subsets per group: size min(n, max(int(n*f), min_rows)), not stratified.

    Returns (group..., fraction, row...) for every fraction; rows are ranked
    once by hash, so subsets nest and the same seed gives the same rows.
    """
    ranked = hashed_rank(fold_train, group_cols, seed, key, "_lrank", salt="subset")
    sizes = fold_train.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    frs = F.array(*[F.lit(Decimal(str(f))).cast("decimal(4,2)") for f in fractions])
    sizes = sizes.withColumn("fraction", F.explode(frs))
    sizes = sizes.withColumn(
        "subset_n",
        F.least(F.col("_n"), F.greatest(F.floor(F.col("_n") * F.col("fraction")).cast("long"), F.lit(min_rows))),
    )
    sizes = broadcast_if_small(sizes.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)], "_n", "fraction", "subset_n"))
    same = F.lit(True)
    for i, c in enumerate(group_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    # groups x fractions rows
    out = ranked.join(sizes, same, "inner").drop(*[f"_g{i}" for i in range(len(group_cols))])
    return out.where(F.col("_lrank") <= F.col("subset_n")).drop("_lrank", "_n")
