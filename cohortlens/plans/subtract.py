"""Protocols for estimators that are fitted from counts, without copies of rows.

The fit table of a fold is the whole table less that fold.  An estimator whose fit
reads nothing but additive counts (``fit_counts``) therefore needs one pass over the
rows: counts per fold, and the counts of a fold's fit are the total minus its own.

* Oversampled rows are copies of a base row that differ in no column such an
  estimator reads, so a row carries how many copies each fold's fit has of it.
* Learning subsets are cuts of one rank: a row carries, for every fold, the first
  subset that holds it; counts of a subset are prefix sums over the cuts.
* Each row is scored once and carries an array of predictions, one for each fold.
  The long table (a row for each fit that holds it) is a view made while reading.

What is stored is the rows once with their copies and once scored.  Tables of counts
hold a row for each group and fit; scalars read by the driver are class sizes of folds.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import split as SP
from cohortlens.operators.joins import broadcast_if_small
from cohortlens.operators.validate import assert_complete, validate
from cohortlens.plans.fits import materialize


def fold_counts(df: DataFrame, by: list[str], label: str, k: int, fold_col: str = "fold") -> DataFrame:
    """(by..., eval_fold, n, positives) of the rows outside of each fold: total minus fold, one aggregate."""
    y, fold = F.col(label) == 1, F.col(fold_col)
    per = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(y).alias("_p"),
        F.array(*[F.count_if(fold == i) for i in range(1, k + 1)]).alias("_nf"),
        F.array(*[F.count_if((fold == i) & y) for i in range(1, k + 1)]).alias("_pf"),
    )
    fits = F.inline(F.array(*[
        F.struct(F.lit(i).alias("eval_fold"), (F.col("_n") - F.col("_nf")[i - 1]).alias("n"), (F.col("_p") - F.col("_pf")[i - 1]).alias("positives"))
        for i in range(1, k + 1)
    ]))
    return per.select(*by, fits).where("n > 0")


def fold_sizes(df: DataFrame, label: str, k: int, where: Column | None = None, fold_col: str = "fold") -> list[dict]:
    """Rows of each label outside of each fold, ``where`` a condition holds; two scalars for each fold."""
    rows = fold_counts(df.where(where) if where is not None else df, [], label, k, fold_col).collect()
    found = {r["eval_fold"]: {0: r["n"] - r["positives"], 1: r["positives"]} for r in rows}
    return [found.get(i, {0: 0, 1: 0}) for i in range(1, k + 1)]


def copies(sizes: list[dict], label: str, fold_col: str, ranks: Column) -> Column:
    """Array over folds: how many synthetic copies of a row the fold's fit holds.

    The rule of ``resample.smote``: the smaller class (label 0 on a tie) grows to the size of the
    other, every row ``n div m`` times and the first ``n mod m`` rows once more; a class
    of fewer than two rows stays as it is.
    """
    out = []
    for i, size in enumerate(sizes, 1):
        minority = 0 if size[0] <= size[1] else 1
        m, wanted = size[minority], size[1 - minority] - size[minority]
        if m < 2 or wanted == 0:
            out.append(F.lit(0))
            continue
        more = F.when(ranks[i - 1] <= wanted % m, 1).otherwise(0)
        out.append(F.when((F.col(label) == minority) & (F.col(fold_col) != i) & ranks[i - 1].isNotNull(), F.lit(wanted // m) + more).otherwise(0))
    return F.array(*[c.cast("int") for c in out])


def strategy_cv(df: DataFrame, extra: DataFrame | None, learner, spec, strategies, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """``crossval.strategy_cv`` for an estimator fitted from counts; same rows, same statistics."""
    estimator, k, y = learner.estimator, spec.k, spec.target
    by = estimator.getOrDefault("groupCols")
    present = [s for s in strategies if s != "real_data" or extra is not None]
    cols = list(dict.fromkeys([spec.key, y, spec.cohort_column, *by]))
    rows = materialize(df.select(*cols, F.col(fold_col).cast("int").alias("fold")), "cv-input")
    grown = {"smote": F.lit(True), "smote_cohort": F.coalesce(spec.in_cohort(), F.lit(False))}
    grown = {s: c for s, c in grown.items() if s in present}
    sizes = {}
    if grown:
        validate(rows, y)
        ranked = SP.fold_out_ranks(rows, k, {f"_r_{s}": c for s, c in grown.items()}, [y], spec.seed, spec.key, "fold", salt="smote")
        sizes = {s: fold_sizes(rows, y, k, c) for s, c in grown.items()}
        made = [copies(sizes[s], y, "fold", F.col(f"_r_{s}")).alias(f"copies_{s}") for s in grown]
        rows = materialize(ranked.select(*cols, "fold", *made), "cv-copies")

    # counts of every fit: the total less a fold, more what a strategy adds
    positive = F.when(F.col(y) == 1, 1).otherwise(0)
    fits = []
    base = fold_counts(rows, by, y, k)
    for s in present:
        fits.append(base.select(F.lit(s).alias("strategy"), "eval_fold", *by, "n", "positives"))
    for s in grown:
        added = [F.col(f"copies_{s}")[i] for i in range(k)]
        per = rows.groupBy(*by).agg(*[F.sum(c).alias(f"_n{i}") for i, c in enumerate(added)], *[F.sum(c * positive).alias(f"_p{i}") for i, c in enumerate(added)])
        each = F.inline(F.array(*[F.struct(F.lit(i + 1).alias("eval_fold"), F.col(f"_n{i}").alias("n"), F.col(f"_p{i}").alias("positives")) for i in range(k)]))
        fits.append(per.select(*by, each).select(F.lit(s).alias("strategy"), "eval_fold", *by, "n", "positives"))
    if "real_data" in present:
        per = extra.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(positive).alias("positives"))
        fits.append(per.select(F.lit("real_data").alias("strategy"), F.explode(F.sequence(F.lit(1), F.lit(k))).alias("eval_fold"), *by, "n", "positives"))
    counted = fits[0]
    for f in fits[1:]:
        counted = counted.unionByName(f)
    counted = counted.groupBy("strategy", "eval_fold", *by).agg(F.sum("n").alias("n"), F.sum("positives").alias("positives")).where("n > 0")
    model = estimator.fit_counts(counted, ["strategy", "eval_fold"])

    # one array of predictions for each group and strategy, joined once to the rows
    rule = F.col(model.ruleCol)
    chosen = lambda s, i: F.max(F.when((F.col("strategy") == s) & (F.col("eval_fold") == i), rule))
    per_group = broadcast_if_small(model.rules.groupBy(*by).agg(*[
        F.array(*[F.coalesce(chosen(s, i), F.lit(0)).cast("tinyint") for i in range(1, k + 1)]).alias(f"pred_{s}") for s in present
    ]))
    none = F.array(*[F.lit(0).cast("tinyint")] * k)
    zero = F.array(*[F.lit(0)] * k)

    def score(t: DataFrame) -> DataFrame:
        keep = list(dict.fromkeys([spec.key, y, spec.cohort_column]))
        return t.join(per_group, by, "left").select(
            *keep, "fold", "origin", *[F.coalesce(f"pred_{s}", none).alias(f"pred_{s}") for s in present], *[f"copies_{s}" for s in grown]
        )

    table = rows.withColumn("origin", F.lit("train"))
    if "real_data" in present:
        more = extra.select(*cols, F.lit(0).alias("fold"), *[zero.alias(f"copies_{s}") for s in grown], F.lit("extra").alias("origin"))
        table = table.unionByName(more)
    stored = materialize(score(table), "cv-scored")
    preds = long_predictions(stored, present, list(grown), k, spec)
    assert_complete(rows, preds.where(F.col("split") == "val"), spec.key, present)
    return preds, _fold_stats(stored, sizes.get("smote_cohort"), k, spec)


def long_predictions(stored: DataFrame, strategies: list[str], grown: list[str], k: int, spec) -> DataFrame:
    """The view of scored rows with a row for each fit that holds them; nothing is written.

    ``fold`` 0 marks rows that only join the fits of ``real_data``.
    """
    y_true = F.col(spec.target).cast("int").alias("y_true")
    of = lambda s: F.col(f"pred_{s}")
    own = F.inline(F.array(*[F.struct(F.lit(s).alias("strategy"), F.element_at(of(s), F.col("fold")).cast("int").alias("y_pred")) for s in strategies]))
    val = stored.where("origin = 'train'").select("fold", spec.key, y_true, spec.cohort_column, own)
    val = val.select("strategy", "fold", F.lit("val").alias("split"), spec.key, F.lit(0).alias("syn_j"), "y_true", "y_pred", spec.cohort_column, F.lit("train").alias("origin"))
    each = F.inline(F.array(*[
        F.struct(
            F.lit(s).alias("strategy"), F.lit(i).alias("eval_fold"), of(s)[i - 1].cast("int").alias("y_pred"),
            (F.col(f"copies_{s}")[i - 1] if s in grown else F.lit(0)).alias("more"),
        )
        for s in strategies for i in range(1, k + 1)
    ]))
    held = stored.select("fold", F.col("origin").alias("source"), spec.key, y_true, spec.cohort_column, each).where(
        ((F.col("source") == "train") & (F.col("fold") != F.col("eval_fold"))) | ((F.col("source") == "extra") & (F.col("strategy") == "real_data"))
    )
    held = held.withColumn("syn_j", F.explode(F.sequence(F.lit(0), F.col("more"))))
    origin = F.when(F.col("syn_j") > 0, "synthetic").otherwise(F.col("source")).alias("origin")
    train = held.select("strategy", F.col("eval_fold").alias("fold"), F.lit("train").alias("split"), spec.key, "syn_j", "y_true", "y_pred", spec.cohort_column, origin)
    return train.unionByName(val)


def _fold_stats(stored: DataFrame, sizes: list[dict] | None, k: int, spec) -> DataFrame:
    """Sizes of each fold's cohort before and after SMOTE, and of its fit table."""
    schema = (
        "strategy string, fold int, cohort_original_n long, cohort_original_minority_n long, cohort_original_majority_n long, "
        "cohort_resampled_n long, cohort_synthetic_n long, fold_total_n_after_smote long, train_fold_n long, cohort_fold_n long"
    )
    spark = stored.sparkSession
    if sizes is None:
        return spark.createDataFrame([], schema)
    own = stored.where("origin = 'train'")
    out = own.agg(*[F.count_if(F.col("fold") != i).alias(f"n{i}") for i in range(1, k + 1)]).first()  # k scalars
    rows = []
    for i, size in enumerate(sizes, 1):
        counts = [c for c in size.values() if c]
        if not counts:
            continue
        total, low, high = sum(counts), min(counts), max(counts)
        made = high - low if len(counts) == 2 and low >= 2 else 0
        rows.append(("smote_cohort", i, total, low, high, total + made, made, out[f"n{i}"] + made, out[f"n{i}"], total))
    return spark.createDataFrame(rows, schema)


def out_of_fold(df: DataFrame, learner, label: str, k: int, fold_col: str = "fold") -> DataFrame:
    """``df`` with the prediction of the model fitted on the other folds; no row is copied."""
    by = learner.estimator.getOrDefault("groupCols")
    model = learner.estimator.fit_counts(fold_counts(df, by, label, k, fold_col), ["eval_fold"])
    return model.transform(df.withColumn("eval_fold", F.col(fold_col).cast("int")))


# ---------------------------------------------------------------- learning subsets as cuts of one rank
def subset_cells(df: DataFrame, by: list[str], k: int, fractions, min_rows: int, seed: int, key: str, fold_col: str = "fold"):
    """(cells, sizes): counts of rows by (by..., fold, cuts), and the rows of each fold's subsets.

    ``cuts[i - 1]`` is the position of the first (smallest) subset of fold i's fit rows that holds the row, null
    for rows of fold i.  All folds cut the same order, so a table of any size has at most
    about ``k * len(fractions)`` different arrays for each fold: ``cells`` stays small.
    """
    rows = df.select(*by, F.col(key), F.col(fold_col).cast("int").alias("fold"))
    ranked = SP.fold_out_ranks(rows, k, {"_ranks": F.lit(True)}, [], seed, key, "fold", salt="subset")
    per = rows.groupBy("fold").count().collect()  # k scalars
    total = sum(r["count"] for r in per)
    outside = [total - sum(r["count"] for r in per if r["fold"] == i) for i in range(1, k + 1)]
    shares = [Decimal(str(f)) for f in fractions]
    sizes = [[min(n, max(int(n * f), min_rows)) for f in shares] for n in outside]
    cut = lambda i: F.when(F.col("_ranks")[i].isNotNull(), sum((F.when(F.col("_ranks")[i] > s, 1).otherwise(0) for s in sizes[i]), F.lit(0)))
    cells = ranked.groupBy(*by, "fold", F.array(*[cut(i) for i in range(k)]).alias("cuts")).agg(F.count(F.lit(1)).alias("c"))
    return cells, sizes


def subset_counts(cells: DataFrame, by: list[str], n_fractions: int) -> DataFrame:
    """(by..., eval_fold, position, c): rows of each subset, as sums over the cuts up to it."""
    at = cells.select(*by, F.posexplode("cuts").alias("_i", "cut"), "c").where(F.col("cut").isNotNull() & (F.col("cut") < n_fractions))
    at = at.groupBy(*by, (F.col("_i") + 1).alias("eval_fold"), "cut").agg(F.sum("c").alias("c"))
    held = at.withColumn("position", F.explode(F.sequence(F.col("cut"), F.lit(n_fractions - 1))))
    return held.groupBy(*by, "eval_fold", "position").agg(F.sum("c").alias("c"))


def curve_cells(df: DataFrame, learner, spec, fractions, min_rows: int, fold_col: str = "fold") -> DataFrame:
    """(fraction, fold, split, y_true, y_pred, c): what a learning curve is read from."""
    y, by = spec.target, learner.estimator.getOrDefault("groupCols")
    cells, _ = subset_cells(df, [*by, y], spec.k, fractions, min_rows, spec.seed, spec.key, fold_col)
    cells = materialize(cells, "curve-cells")
    train = subset_counts(cells, [*by, y], len(fractions))
    fits = train.groupBy("eval_fold", "position", *by).agg(F.sum("c").alias("n"), F.sum(F.when(F.col(y) == 1, F.col("c")).otherwise(0)).alias("positives"))
    model = learner.estimator.fit_counts(fits, ["eval_fold", "position"])
    val = cells.groupBy(*by, y, F.col("fold").alias("eval_fold")).agg(F.sum("c").alias("c"))
    val = val.withColumn("position", F.explode(F.sequence(F.lit(0), F.lit(len(fractions) - 1))))
    share = F.array(*[F.lit(float(f)) for f in fractions])[F.col("position")].alias("fraction")
    parts = [
        model.transform(t).select(share, F.col("eval_fold").alias("fold"), F.lit(split).alias("split"), F.col(y).cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"), "c")
        for split, t in (("train", train), ("val", val))
    ]
    return parts[0].unionByName(parts[1])
