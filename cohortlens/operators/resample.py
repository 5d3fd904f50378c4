"""SMOTE oversampling over a whole table or inside one cohort.

Chawla et al. (2002): the minority class is grown to the majority size; a
synthetic row is ``x = b + u * (q - b)`` for a minority base ``b``, one of
its k nearest minority neighbours ``q`` and a gap ``u`` in [0, 1).

Spark plan: class counts (one small aggregate); exact kNN among minority
rows (``operators.knn``); every minority row gets ``n_syn div m`` synthetic
children, plus one for the first ``n_syn mod m`` rows in hash order, so the
work is spread over all bases (an ``explode``, no driver loop); the
neighbour choice and gap come from ``md5(seed:tag:key:j)``; two equi-joins
fetch the neighbour and its vector.  Synthetic rows keep the base key with
``syn_j >= 1``; originals have ``syn_j = 0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.hashing import hash_unit, portable_hash
from cohortlens.operators.joins import broadcast_if_small
from cohortlens.operators.knn import knn
from cohortlens.operators.split import hashed_rank
from cohortlens.operators.validate import validate


def _class_sizes(df: DataFrame, target: str):
    validate(df, target)  # binary, no nulls
    rows = df.groupBy(target).agg(F.count(F.lit(1)).alias("c")).collect()  # one row per class
    return sorted(((r[target], r["c"]) for r in rows), key=lambda t: (t[1], t[0]))


def smote(
    df: DataFrame,
    target: str,
    vec: str = "x",
    k: int = 5,
    seed: int = 42,
    key: str = "row_id",
    carry: list[str] | None = None,
    vectors: bool = True,
) -> tuple[DataFrame, dict]:
    """Oversample the minority class of ``df`` to parity.

    ``vectors=False`` produces the synthetic rows (base key, label, carried
    columns) without interpolated vectors, for learners that do not read
    them; the kNN step is then skipped.

    Returns (rows, stats): rows are originals plus synthetic rows with
    ``syn_j``, ``is_synthetic`` and ``neighbour_id``; ``carry`` columns of
    the base row are copied onto its synthetic rows.  No-op with fewer than
    two classes or a minority below two rows; ``k`` becomes ``min(k, m-1)``.
    """
    carry = [c for c in (carry or []) if c not in (key, target, vec)]
    sizes = _class_sizes(df, target)
    base = df.select(key, target, vec, *carry).withColumn("syn_j", F.lit(0)).withColumn(
        "is_synthetic", F.lit(False)
    ).withColumn("neighbour_id", F.lit(None).cast(df.schema[key].dataType))
    stats = {
        "original_n": sum(c for _, c in sizes),
        "minority_n": sizes[0][1] if sizes else 0,
        "majority_n": sizes[-1][1] if sizes else 0,
    }
    if len(sizes) < 2 or sizes[0][1] < 2 or sizes[0][1] == sizes[-1][1]:
        stats.update(resampled_n=stats["original_n"], synthetic_n=0)
        return base, stats
    minority_label, m = sizes[0]
    big = sizes[-1][1]
    n_syn = big - m
    k_eff = min(k, m - 1)
    minority = df.where(F.col(target) == F.lit(minority_label)).select(key, vec, *carry)
    pos = hashed_rank(minority.select(key), [], seed, key, "_pos", salt="smote")
    per, extra = n_syn // m, n_syn % m
    reps = pos.withColumn("_r", F.lit(per) + F.when(F.col("_pos") <= extra, 1).otherwise(0)).where("_r > 0")
    syn = reps.select(key, F.explode(F.sequence(F.lit(1), F.col("_r"))).alias("syn_j"))
    stats.update(resampled_n=stats["original_n"] + n_syn, synthetic_n=n_syn)
    if not vectors:
        synthetic = syn.join(minority, key, "inner").select(
            key,
            F.lit(minority_label).cast(df.schema[target].dataType).alias(target),
            F.lit(None).cast(df.schema[vec].dataType).alias(vec),
            *carry,
            F.col("syn_j").cast("int").alias("syn_j"),
            F.lit(True).alias("is_synthetic"),
            F.lit(None).cast(df.schema[key].dataType).alias("neighbour_id"),
        )
        return base.unionByName(synthetic), stats
    nn = knn(minority.select(key, vec), k_eff, key=key, vec=vec)
    syn = syn.withColumn("nn_rank", (portable_hash(seed, F.lit("nn"), F.col(key), F.col("syn_j")) % k_eff + 1).cast("int"))
    syn = syn.withColumn("_gap", hash_unit(seed, F.lit("gap"), F.col(key), F.col("syn_j")))
    syn = syn.join(nn.select(key, "nn_rank", "neighbour_id"), [key, "nn_rank"], "inner")
    syn = syn.join(minority, key, "inner")
    syn = syn.join(minority.select(F.col(key).alias("neighbour_id"), F.col(vec).alias("_q")), "neighbour_id", "inner")
    new_vec: Column = F.zip_with(vec, "_q", lambda b, q: b + F.col("_gap") * (q - b))
    synthetic = syn.select(
        key,
        F.lit(minority_label).cast(df.schema[target].dataType).alias(target),
        new_vec.alias(vec),
        *carry,
        F.col("syn_j").cast("int").alias("syn_j"),
        F.lit(True).alias("is_synthetic"),
        "neighbour_id",
    )
    return base.unionByName(synthetic), stats


def smote_cohort(
    df: DataFrame,
    target: str,
    in_cohort: Column,
    vec: str = "x",
    k: int = 5,
    seed: int = 42,
    key: str = "row_id",
    carry: list[str] | None = None,
    vectors: bool = True,
) -> tuple[DataFrame, dict]:
    """SMOTE inside the cohort only; the rest of the table is untouched."""
    tagged = df.withColumn("_in", F.coalesce(in_cohort, F.lit(False)))
    cohort = tagged.where("_in").drop("_in")
    rest = tagged.where(~F.col("_in")).drop("_in")
    res, st = smote(cohort, target, vec, k, seed, key, carry, vectors)
    cols = res.columns
    rest_rows = rest.select(key, target, vec, *[c for c in (carry or []) if c not in (key, target, vec)]).withColumn(
        "syn_j", F.lit(0)
    ).withColumn("is_synthetic", F.lit(False)).withColumn("neighbour_id", F.lit(None).cast(df.schema[key].dataType))
    out = rest_rows.select(*cols).unionByName(res)
    stats = {
        "cohort_original_n": st["original_n"],
        "cohort_original_minority_n": st["minority_n"],
        "cohort_original_majority_n": st["majority_n"],
        "cohort_resampled_n": st["resampled_n"],
        "cohort_synthetic_n": st["synthetic_n"],
    }
    return out, stats


def smote_grouped(
    df: DataFrame,
    target: str,
    by: list[str],
    vec: str = "x",
    k: int = 5,
    seed: int = 42,
    key: str = "row_id",
    carry: list[str] | None = None,
    vectors: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """SMOTE run independently inside every group of ``by`` (e.g. per fold), in one plan.

    Class sizes, the minority label and the no-op rule are decided per group
    inside the plan (no driver round trip per group); per group the result
    equals ``smote`` on that group alone.  Returns (rows, stats per group).
    """
    from pyspark.sql import Window

    validate(df, target)
    carry = [c for c in (carry or []) if c not in (key, target, vec, *by)]
    cc = df.groupBy(*by, target).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by)
    w_min = Window.partitionBy(*by).orderBy("_c", target)
    info = (
        cc.withColumn("_ncls", F.count(F.lit(1)).over(w))
        .withColumn("_m", F.min("_c").over(w))
        .withColumn("_big", F.max("_c").over(w))
        .withColumn("_tot", F.sum("_c").over(w))
        .withColumn("_rk", F.row_number().over(w_min))
        .where("_rk = 1")
    )
    stats = info.select(
        *by,
        F.col("_tot").alias("original_n"),
        F.col("_m").alias("minority_n"),
        F.col("_big").alias("majority_n"),
        F.when((F.col("_ncls") == 2) & (F.col("_m") >= 2), F.col("_tot") + F.col("_big") - F.col("_m")).otherwise(F.col("_tot")).alias("resampled_n"),
        F.when((F.col("_ncls") == 2) & (F.col("_m") >= 2), F.col("_big") - F.col("_m")).otherwise(F.lit(0)).cast("long").alias("synthetic_n"),
    )
    active = info.where((F.col("_ncls") == 2) & (F.col("_m") >= 2) & (F.col("_m") < F.col("_big"))).select(
        *by, F.col(target).alias("_ym"), F.col("_m"), (F.col("_big") - F.col("_m")).alias("_nsyn"),
        F.least(F.lit(k), F.col("_m") - 1).alias("_k"),
    )
    base = df.select(*by, key, target, vec, *carry).withColumn("syn_j", F.lit(0)).withColumn("is_synthetic", F.lit(False)).withColumn(
        "neighbour_id", F.lit(None).cast(df.schema[key].dataType)
    )
    # one row per group; joined on a low-cardinality key (e.g. the fold), so it is
    # broadcast after a size check instead of shuffling whole groups into single tasks
    active = broadcast_if_small(active)
    minority = df.join(active, by, "inner").where(F.col(target) == F.col("_ym")).select(*by, key, target, vec, *carry, "_m", "_nsyn", "_k")
    pos = hashed_rank(minority, by, seed, key, "_pos", salt="smote")
    reps = pos.withColumn(
        "_r", F.expr("_nsyn div _m") + F.when(F.col("_pos") <= F.col("_nsyn") % F.col("_m"), 1).otherwise(0)
    ).where("_r > 0")
    syn = reps.withColumn("syn_j", F.explode(F.sequence(F.lit(1), F.col("_r").cast("int"))))
    if not vectors:
        synthetic = syn.select(
            *by, key, target, F.lit(None).cast(df.schema[vec].dataType).alias(vec), *carry, "syn_j",
            F.lit(True).alias("is_synthetic"), F.lit(None).cast(df.schema[key].dataType).alias("neighbour_id"),
        )
        return base.unionByName(synthetic), stats
    nn = knn(minority.select(*by, key, vec), k, key=key, vec=vec, by=by)
    syn = syn.withColumn("nn_rank", (portable_hash(seed, F.lit("nn"), F.col(key), F.col("syn_j")) % F.col("_k") + 1).cast("int"))
    syn = syn.withColumn("_gap", hash_unit(seed, F.lit("gap"), F.col(key), F.col("syn_j")))
    syn = syn.join(nn.select(*by, key, "nn_rank", "neighbour_id"), [*by, key, "nn_rank"], "inner")
    syn = syn.join(minority.select(*by, F.col(key).alias("neighbour_id"), F.col(vec).alias("_q")), [*by, "neighbour_id"], "inner")
    synthetic = syn.select(
        *by, key, target, F.zip_with(vec, "_q", lambda b, q: b + F.col("_gap") * (q - b)).alias(vec), *carry, "syn_j",
        F.lit(True).alias("is_synthetic"), "neighbour_id",
    )
    return base.unionByName(synthetic), stats
