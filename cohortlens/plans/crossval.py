"""Evaluation protocols: out-of-fold scoring, strategy CV, augmentation
comparison, learning curve and the final fit.

Every protocol produces one long predictions table
``(strategy, fold, split, row_id, syn_j, y_true, y_pred, <cohort col>)``
that is written to the shared folder (the stage cut: models are not
re-applied per report) and read back; all metric tables are aggregates over
it.  Preparation is fitted inside each fold on the sub-train only, extra
rows and synthetic rows only ever enter sub-trains, and validation rows are
always real.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from typing import Callable

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.ratios import confusion_aggs, metric_columns
from cohortlens.operators import metrics as M
from cohortlens.operators import resample as RS
from cohortlens.operators import split as SP
from cohortlens.operators.estimators import predicted
from cohortlens.operators.validate import assert_complete
from cohortlens.plans import subtract as SUB
from cohortlens.plans.fits import FIT_THREADS, fit_table, is_bounded, materialize, run_concurrently, scored

STRATEGIES = ["baseline", "real_data", "smote", "smote_cohort"]

Featurizer = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]


@dataclass
class Learner:
    """An estimator plus the preparation it needs (fitted per training set).

    ``featurizer(train)`` returns a function adding the ``vec`` column
    (array<double>) to any table; ``needs_vectors`` tells SMOTE whether the
    estimator reads interpolated vectors or only carried columns.  A fit on a
    whole fold holds its forest in the driver: ``threads`` says how many may be there.
    """

    estimator: Estimator
    featurizer: Featurizer | None = None
    vec: str = "x"
    needs_vectors: bool = True
    stateless_features: bool = False
    threads: int = FIT_THREADS  # fits at the same time

    @property
    def batched(self) -> bool:
        """All fold models can be fitted as one grouped job: the estimator
        supports model-key columns and preparation does not depend on the
        training rows."""
        return hasattr(self.estimator, "with_models") and (self.featurizer is None or self.stateless_features)

    @property
    def countable(self) -> bool:
        """Models are fitted from counts alone, so no protocol needs a copy of a row."""
        return self.batched and not self.needs_vectors and hasattr(self.estimator, "fit_counts")


@dataclass
class Spec:
    target: str
    cohort_column: str
    cohort_value: str
    key: str = "row_id"
    k: int = 5
    seed: int = 42
    k_nn: int = 5
    carry: list[str] = field(default_factory=list)

    def in_cohort(self) -> Column:
        return F.col(self.cohort_column).eqNullSafe(F.lit(self.cohort_value))

    def carried(self) -> list[str]:
        return list(dict.fromkeys([*self.carry, self.cohort_column]))


CURVE_THREADS = 4  # fits on whole subsets: few forests in the driver at once


def _featurize(learner: Learner, train: DataFrame):
    if learner.featurizer is None:
        return lambda df: df
    return learner.featurizer(train)


def _base_rows(df: DataFrame, spec: Spec, learner: Learner, origin: str | None = "train") -> DataFrame:
    out = df.select(spec.key, spec.target, learner.vec, *spec.carried(), *(["origin"] if origin is None else []))
    out = out.withColumn("syn_j", F.lit(0)).withColumn("is_synthetic", F.lit(False))
    return out.withColumn("origin", F.lit(origin)) if origin is not None else out


def _with_origin(rows: DataFrame) -> DataFrame:
    return rows.drop("neighbour_id").withColumn("origin", F.when(F.col("is_synthetic"), "synthetic").otherwise("train"))


def augment(strategy: str, train: DataFrame, extra: DataFrame | None, learner: Learner, spec: Spec, fitted=None):
    """(fit table, featurize function, SMOTE stats or None) for one strategy.

    ``fitted`` is an already fitted featurize function for ``train`` (shared
    by the strategies that prepare on the sub-train alone).
    """
    if strategy == "real_data":
        if extra is None:
            raise ValueError("real_data needs a table of extra rows, and none was given")
        both = train.withColumn("origin", F.lit("train")).unionByName(
            extra.select(*train.columns).withColumn("origin", F.lit("extra"))
        )
        f = _featurize(learner, both)
        return _base_rows(f(both), spec, learner, origin=None), f, None
    f = fitted or _featurize(learner, train)
    prepared = f(train)
    if strategy == "baseline":
        return _base_rows(prepared, spec, learner), f, None
    if strategy == "smote":
        rows, st = RS.smote(prepared, spec.target, learner.vec, spec.k_nn, spec.seed, spec.key, spec.carried(), learner.needs_vectors)
        return _with_origin(rows), f, None
    if strategy == "smote_cohort":
        rows, st = RS.smote_cohort(
            prepared, spec.target, spec.in_cohort(), learner.vec, spec.k_nn, spec.seed, spec.key, spec.carried(), learner.needs_vectors
        )
        return _with_origin(rows), f, st
    raise ValueError(f"Unknown strategy: {strategy}")


def _scored(model, df: DataFrame, spec: Spec, strategy: str, fold: int, split: str) -> DataFrame:
    out = predicted(model, df)
    return out.select(
        F.lit(strategy).alias("strategy"),
        F.lit(fold).cast("int").alias("fold"),
        F.lit(split).alias("split"),
        spec.key,
        F.col("syn_j").cast("int").alias("syn_j") if "syn_j" in out.columns else F.lit(0).alias("syn_j"),
        F.col(spec.target).cast("int").alias("y_true"),
        F.col("prediction").cast("int").alias("y_pred"),
        spec.cohort_column,
        F.col("origin") if "origin" in out.columns else F.lit("train").alias("origin"),
    )


def strategy_cv(
    df: DataFrame,
    extra: DataFrame | None,
    learner: Learner,
    spec: Spec,
    strategies=STRATEGIES,
    fold_col: str = "fold",
) -> tuple[DataFrame, DataFrame]:
    """Same folds for every strategy; returns (predictions, SMOTE fold stats)."""
    unknown = [s for s in strategies if s not in STRATEGIES]
    if unknown:
        raise ValueError(f"No such strategy: {unknown}")
    if learner.countable:
        return SUB.strategy_cv(df, extra, learner, spec, strategies, fold_col)
    if learner.batched:
        return _strategy_cv_batched(df, extra, learner, spec, strategies, fold_col)
    parts, stats = [], []
    folds = list(range(1, spec.k + 1))
    # every fold and strategy re-reads the input: write it once
    df = materialize(df, "cv-input")
    extra = materialize(extra, "cv-extra") if extra is not None else None
    runs = [(s, i) for s in strategies if not (s == "real_data" and extra is None) for i in folds]
    split = lambda i: (df.where(F.col(fold_col) != i).drop(fold_col), df.where(F.col(fold_col) == i).drop(fold_col))
    # preparation fitted once per fold, shared by the strategies that prepare on the sub-train
    prep = dict(zip(folds, run_concurrently([lambda i=i: _featurize(learner, split(i)[0]) for i in folds])))

    def one(s: str, i: int):
        train, val = split(i)
        fit_rows, f, st = augment(s, train, extra, learner, spec, None if s == "real_data" else prep[i])
        bounded = is_bounded(learner.estimator)
        if bounded and s.startswith("smote"):  # the whole fit table is counted and filtered: keep it (others are plain maps)
            fit_rows = materialize(fit_rows, "cv-fit")
        estimator, table = fit_table(learner.estimator, fit_rows)  # train scores are taken on the rows the model has seen
        if not bounded:  # the stored table is the whole one
            fit_rows = table
        model = estimator.fit(table)
        rows = scored([_scored(model, table, spec, s, i, "train"), _scored(model, f(val).withColumn("syn_j", F.lit(0)), spec, s, i, "val")])
        counted = fit_rows.select(F.lit(s).alias("strategy"), F.lit(i).cast("int").alias("fold"), F.col("syn_j").cast("int").alias("syn_j"), spec.cohort_column)
        return [rows], st, counted

    fit_tables = []
    for (s, i), (rows, st, counted) in zip(runs, run_concurrently([lambda s=s, i=i: one(s, i) for s, i in runs], learner.threads)):
        parts.extend(rows)
        fit_tables.append(counted)
        if st is not None:
            stats.append((s, i, st))
    preds = M.union_all(parts)  # each part is stored already
    assert_complete(df, preds.where(F.col("split") == "val"), spec.key, list(dict.fromkeys(s for s, _ in runs)))
    spark = df.sparkSession
    rows = []
    for s, i, st in stats:
        rows.append((s, i, st["cohort_original_n"], st["cohort_original_minority_n"], st["cohort_original_majority_n"], st["cohort_resampled_n"], st["cohort_synthetic_n"]))
    st_df = spark.createDataFrame(
        rows,
        "strategy string, fold int, cohort_original_n long, cohort_original_minority_n long, "
        "cohort_original_majority_n long, cohort_resampled_n long, cohort_synthetic_n long",
    )
    # sizes of the whole fit tables, whatever part of them the estimator reads
    sizes = M.union_all(fit_tables).groupBy("strategy", "fold").agg(
        F.count(F.lit(1)).alias("fold_total_n_after_smote"),
        F.count_if(F.col("syn_j") == 0).alias("train_fold_n"),
        F.count_if((F.col("syn_j") == 0) & spec.in_cohort()).alias("cohort_fold_n"),
    )
    fold_stats = st_df.join(sizes, ["strategy", "fold"], "inner")
    return preds, fold_stats


def _strategy_cv_batched(df, extra, learner: Learner, spec: Spec, strategies, fold_col: str):
    """Every (strategy, fold) model in one fit: fold rows are laid out long
    (row x eval_fold), SMOTE runs grouped by fold, and the estimator fits one
    model per (strategy, eval_fold) key in a single grouped job."""
    df = materialize(df, "cv-input")
    extra = materialize(extra, "cv-extra") if extra is not None else None
    f = _featurize(learner, df)
    carried = spec.carried()
    long = SP.fold_membership(f(df), spec.k, fold_col)
    train_long = long.where(F.col("split") == "train").drop("split", fold_col)
    val_long = long.where(F.col("split") == "val").drop("split", fold_col)

    def base(t: DataFrame, origin: str) -> DataFrame:
        return t.select("eval_fold", spec.key, spec.target, learner.vec, *carried).withColumn("syn_j", F.lit(0)).withColumn(
            "is_synthetic", F.lit(False)
        ).withColumn("origin", F.lit(origin))

    def grouped_smote(t: DataFrame):
        rows, st = RS.smote_grouped(t, spec.target, ["eval_fold"], learner.vec, spec.k_nn, spec.seed, spec.key, carried, learner.needs_vectors)
        return rows.drop("neighbour_id").withColumn("origin", F.when(F.col("is_synthetic"), "synthetic").otherwise("train")), st

    fits, present, cohort_stats = [], [], None
    for s in strategies:
        if s == "real_data" and extra is None:
            continue
        present.append(s)
        if s == "baseline":
            rows = base(train_long, "train")
        elif s == "real_data":
            ex = f(extra).withColumn("eval_fold", F.explode(F.sequence(F.lit(1), F.lit(spec.k))))
            rows = base(train_long, "train").unionByName(base(ex, "extra"))
        elif s == "smote":
            rows, _ = grouped_smote(train_long)
        elif s == "smote_cohort":
            tagged = train_long.withColumn("_in", F.coalesce(spec.in_cohort(), F.lit(False)))
            rows_c, cohort_stats = grouped_smote(tagged.where("_in").drop("_in"))
            rows = base(tagged.where(~F.col("_in")).drop("_in"), "train").unionByName(rows_c)
        else:
            raise ValueError(f"Unknown strategy: {s}")
        fits.append(rows.select(*rows.columns).withColumn("strategy", F.lit(s)))
    fit_all = materialize(M.union_all(fits), "cv-fit", ["strategy"])
    model = learner.estimator.with_models(["strategy", "eval_fold"]).fit(fit_all)
    cols = lambda split, syn, origin: [
        "strategy", F.col("eval_fold").cast("int").alias("fold"), F.lit(split).alias("split"), spec.key,
        syn, F.col(spec.target).cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"),
        spec.cohort_column, origin,
    ]
    tp = model.transform(fit_all).select(*cols("train", F.col("syn_j").cast("int").alias("syn_j"), F.col("origin")))
    vx = val_long.withColumn("strategy", F.explode(F.array(*[F.lit(x) for x in present])))
    vp = model.transform(vx).select(*cols("val", F.lit(0).alias("syn_j"), F.lit("train").alias("origin")))
    preds = materialize(tp.unionByName(vp), "predictions", ["strategy"])
    assert_complete(df, preds.where(F.col("split") == "val"), spec.key, present)
    if cohort_stats is None:
        st_df = df.sparkSession.createDataFrame([], "strategy string, fold int, cohort_original_n long")
    else:
        st_df = cohort_stats.select(
            F.lit("smote_cohort").alias("strategy"), F.col("eval_fold").cast("int").alias("fold"),
            F.col("original_n").alias("cohort_original_n"), F.col("minority_n").alias("cohort_original_minority_n"),
            F.col("majority_n").alias("cohort_original_majority_n"), F.col("resampled_n").alias("cohort_resampled_n"),
            F.col("synthetic_n").alias("cohort_synthetic_n"),
        )
    sizes = preds.where("split = 'train'").groupBy("strategy", "fold").agg(
        F.count(F.lit(1)).alias("fold_total_n_after_smote"),
        F.count_if(F.col("syn_j") == 0).alias("train_fold_n"),
        F.count_if((F.col("syn_j") == 0) & spec.in_cohort()).alias("cohort_fold_n"),
    )
    return preds, materialize(st_df.join(sizes, ["strategy", "fold"], "inner"), "cv-fold-stats")


def comparison(predictions: DataFrame, spec: Spec) -> DataFrame:
    """Global and cohort validation metrics per strategy (one aggregate)."""
    val = predictions.where(F.col("split") == "val")
    return M.global_vs_cohort(val, spec.cohort_column, spec.cohort_value, by=["strategy"])


def fold_metrics(predictions: DataFrame) -> DataFrame:
    """Per (strategy, fold): train/val sizes and the four ratios of each split."""
    tr, va = F.col("split") == "train", F.col("split") == "val"
    agg = predictions.groupBy("strategy", "fold").agg(
        *confusion_aggs(where=tr, prefix="train_"), *confusion_aggs(where=va, prefix="val_")
    )
    return agg.select(
        "strategy", "fold", F.col("train_n"), F.col("val_n"), *metric_columns("train_"), *metric_columns("val_")
    )


def oof_predictions(predictions: DataFrame, strategy: str = "baseline") -> DataFrame:
    val = predictions.where((F.col("split") == "val") & (F.col("strategy") == strategy))
    return M.error_flags(val.drop("split", "syn_j", "origin"))


def oof_predict(estimator: Estimator, df: DataFrame, spec: Spec, learner: Learner | None = None, fold_col: str = "fold") -> DataFrame:
    """Each row scored by the model fitted on the other folds."""
    learner = learner or Learner(estimator)
    preds, _ = strategy_cv(df, None, learner, spec, ["baseline"], fold_col)
    out = oof_predictions(preds)
    assert_complete(df, out, spec.key)
    return out


# ---------------------------------------------------------------- augmentation protocol
def augmentation_comparison(df: DataFrame, extra: DataFrame | None, learner: Learner, spec: Spec) -> DataFrame:
    """The other protocol: folds drawn over the augmented table itself.

    baseline: OOF over train, cohort = cohort rows.  real_data: OOF over
    train + extra, cohort metrics over the extra rows only.  smote: SMOTE on
    the whole train *before* CV (leaky, kept for comparison), global metrics
    over real + synthetic rows, cohort metrics over the original cohort rows.
    Metrics are rounded to 4 places and prefixed.
    """
    out = []
    df = materialize(df, "aug-input")
    extra = materialize(extra, "aug-extra") if extra is not None else None

    def run(table: DataFrame, name: str, cohort_rows: Column):
        keyed = table.withColumn("_uid", F.concat_ws(":", F.col(spec.key).cast("string"), F.col("syn_j").cast("string")))
        folded = materialize(SP.add_folds(keyed, spec.target, spec.k, spec.seed, key="_uid"), f"aug-folds-{name}")
        preds = []
        if learner.countable:
            preds.append(SUB.out_of_fold(folded, learner, spec.target, spec.k).select(
                spec.key, "syn_j", spec.cohort_column, "_src", F.col(spec.target).cast("int").alias("y_true"),
                F.col("prediction").cast("int").alias("y_pred")))
        elif learner.batched:
            long = SP.fold_membership(folded, spec.k, "fold")
            tr = long.where(F.col("split") == "train")
            model = learner.estimator.with_models(["eval_fold"]).fit(tr)
            preds.append(model.transform(long.where(F.col("split") == "val")).select(
                spec.key, "syn_j", spec.cohort_column, "_src", F.col(spec.target).cast("int").alias("y_true"),
                F.col("prediction").cast("int").alias("y_pred")))

        def one(i: int) -> DataFrame:
            estimator, table = fit_table(learner.estimator, folded.where(F.col("fold") != i))
            model = estimator.fit(table)
            val = predicted(model, folded.where(F.col("fold") == i))
            return scored([val.select(spec.key, "syn_j", spec.cohort_column, "_src", F.col(spec.target).cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))], f"aug-{name}-fold")

        if not learner.batched:
            preds += run_concurrently([lambda i=i: one(i) for i in range(1, spec.k + 1)], learner.threads)
        p = materialize(M.union_all(preds), f"aug-{name}")
        g = M.metrics_row(p, "global_")
        c = M.metrics_row(p, "cohort_", where=cohort_rows)
        out.append(M.metrics_rows(p, [g, c]).select(F.lit(name).alias("strategy"), "*"))

    # as in the reference, one preparation, fitted on train, serves train and extra rows
    f = _featurize(learner, df)
    ready = (lambda t: t) if learner.batched else f
    base = ready(df).withColumn("syn_j", F.lit(0)).withColumn("_src", F.lit("train"))
    run(base, "baseline", spec.in_cohort() & (F.col("_src") == "train"))
    if extra is not None:
        ex = ready(extra.select(*df.columns)).withColumn("syn_j", F.lit(0)).withColumn("_src", F.lit("extra"))
        run(base.unionByName(ex), "real_data", F.col("_src") == "extra")
    rows, _ = RS.smote(f(df), spec.target, learner.vec, spec.k_nn, spec.seed, spec.key, spec.carried(), learner.needs_vectors)
    rows = rows.drop("neighbour_id", "is_synthetic").withColumn("_src", F.when(F.col("syn_j") == 0, "train").otherwise("synthetic"))
    run(rows, "smote", spec.in_cohort() & (F.col("_src") == "train"))
    return M.union_all(out)


# ---------------------------------------------------------------- learning curve
FRACTIONS = [Decimal(i) / 10 for i in range(1, 11)]


def learning_curve(df: DataFrame, learner: Learner, spec: Spec, fractions=FRACTIONS, min_rows: int = 50, fold_col: str = "fold") -> DataFrame:
    """Mean train/val F1 and recall over folds for growing nested subsets."""
    parts = []
    df = materialize(df, "curve-input")
    if learner.countable:
        return _curve_table(df, [SUB.curve_cells(df, learner, spec, fractions, min_rows, fold_col)], spec, "c")
    if learner.batched:
        f = _featurize(learner, df)
        long = SP.fold_membership(f(df), spec.k, fold_col)
        train_long = long.where(F.col("split") == "train").drop("split", fold_col)
        subsets = materialize(SP.learning_subsets(train_long, ["eval_fold"], fractions, min_rows, spec.seed, spec.key), "curve-subsets")
        model = learner.estimator.with_models(["eval_fold", "fraction"]).fit(subsets)
        frs = F.array(*[F.lit(Decimal(str(x))).cast("decimal(4,2)") for x in fractions])
        val = long.where(F.col("split") == "val").drop("split", fold_col).withColumn("fraction", F.explode(frs))
        for split, table in (("train", subsets), ("val", val)):
            parts.append(
                model.transform(table).select(
                    F.col("eval_fold").alias("fold"), F.col("fraction").cast("double").alias("fraction"), F.lit(split).alias("split"),
                    F.col(spec.target).cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"),
                )
            )
        return _curve_table(df, parts, spec)
    # as in the reference, the curve reads the table prepared once on the whole train
    f = _featurize(learner, df)
    prepared = materialize(f(df), "curve-prepared")
    long = SP.fold_membership(prepared, spec.k, fold_col)
    subsets = materialize(
        SP.learning_subsets(long.where(F.col("split") == "train"), ["eval_fold"], fractions, min_rows, spec.seed, spec.key),
        "curve-subsets",
    )
    def one(i, fr):
        val = prepared.where(F.col(fold_col) == i)
        sub = subsets.where((F.col("eval_fold") == i) & (F.col("fraction") == F.lit(fr).cast("decimal(4,2)")))
        estimator, table = fit_table(learner.estimator, sub)
        model = estimator.fit(table)
        rows = [
            predicted(model, table).select(
                F.lit(i).alias("fold"), F.lit(float(fr)).alias("fraction"), F.lit(split).alias("split"),
                F.col(spec.target).cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"),
            )
            for split, table in (("train", table), ("val", val))
        ]
        return [scored(rows, "curve-scored")]

    jobs = [(i, fr) for i in range(1, spec.k + 1) for fr in fractions]
    for got in run_concurrently([lambda i=i, fr=fr: one(i, fr) for i, fr in jobs], min(learner.threads, CURVE_THREADS)):
        parts.extend(got)
    return _curve_table(df, parts, spec)


def _curve_table(df: DataFrame, parts: list, spec: Spec, weight: str | None = None) -> DataFrame:
    p = materialize(M.union_all(parts), "learning-curve")
    per = M.binary_metrics(p, ["fraction", "fold", "split"], weight=weight)
    tr, va = F.col("split") == "train", F.col("split") == "val"
    curve = per.groupBy("fraction").agg(
        F.round(F.avg(F.when(tr, F.col("f1"))), 6).alias("train_f1"),
        F.round(F.avg(F.when(va, F.col("f1"))), 6).alias("val_f1"),
        F.round(F.avg(F.when(tr, F.col("recall"))), 6).alias("train_recall"),
        F.round(F.avg(F.when(va, F.col("recall"))), 6).alias("val_recall"),
    )
    k = spec.k
    n_rows = df.count()  # one scalar
    share = F.lit(Decimal(k - 1) / Decimal(k)).cast("decimal(20,10)")
    return curve.withColumn(
        "n_samples", F.floor(F.lit(n_rows) * share * F.col("fraction").cast("decimal(4,2)")).cast("long")
    ).orderBy("fraction")


def curve_verdict(curve: DataFrame, gap_limit: float = 0.15, trend_limit: float = 0.02, mid_index: int = 5) -> DataFrame:
    """gap = train F1 - val F1 at the largest fraction; trend = last val F1 -
    val F1 at position ``mid_index`` (0-based, fractions ascending)."""
    from pyspark.sql import Window

    w = Window.partitionBy(F.lit(0)).orderBy("fraction")
    c = curve.withColumn("_pos", F.row_number().over(w) - 1)
    last = F.max_by("train_f1", "fraction"), F.max_by("val_f1", "fraction")
    agg = c.agg(
        last[0].alias("_tf"), last[1].alias("_vf"), F.max(F.when(F.col("_pos") == mid_index, F.col("val_f1"))).alias("_vm")
    )
    return agg.select(
        F.round(F.col("_tf") - F.col("_vf"), 6).alias("gap_f1"),
        F.round(F.col("_vf") - F.col("_vm"), 6).alias("trend"),
        (F.col("_tf") - F.col("_vf") > gap_limit).alias("overfit"),
        (F.col("_vf") - F.col("_vm") > trend_limit).alias("still_rising"),
    )


# ---------------------------------------------------------------- final fit
def fit_final(train: DataFrame, extra: DataFrame | None, strategy: str, learner: Learner, spec: Spec):
    """Fit on the whole train under the chosen strategy; returns (model, featurize, stats)."""
    fit_rows, f, st = augment(strategy, train, extra, learner, spec)
    estimator, table = fit_table(learner.estimator, fit_rows)
    return estimator.fit(table), f, st


def test_predictions(model, featurize, test: DataFrame, spec: Spec, strategy: str) -> DataFrame:
    return _scored(model, featurize(test).withColumn("syn_j", F.lit(0)), spec, strategy, 0, "test")
