"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

The queries run the toolkit over proxy views of the driver tables (see
``cohortlens.sources.proxies``); ``oracle/sql.py`` holds the DuckDB text of
the same questions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import metrics as M
from cohortlens.operators import validate as V
from cohortlens.session import hadoop_path
from cohortlens.sources import proxies as P

LABELLED_COLUMNS = [
    "row_id", "y_true", "y_pred", "y_learn", "segment", "priority", "nation",
    "total_price", "acctbal", "part_a", "part_b", "part_total", "month", "week",
    "zero", "line_flag",
]


_MEMO: dict = {}


def _state(spark, sf_dir: str) -> int:
    """Changes when a file below the input folder does."""
    p, fs = hadoop_path(spark, sf_dir)
    found = []
    for f in fs.listStatus(p):
        inner = fs.listStatus(f.getPath()) if f.isDirectory() else [f]
        found += [(x.getPath().toString(), x.getLen(), x.getModificationTime()) for x in inner]
    return hash(tuple(sorted(found)))


def clear_memo() -> None:
    """Forget shared intermediate results (so that a query is timed alone)."""
    _MEMO.clear()


def _memo(spark, key, fn):
    """Protocol results that several queries report on, for one state of the input files."""
    k = (id(spark), spark.sparkContext.applicationId, key, _state(spark, key[1]))
    if k not in _MEMO:
        _MEMO[k] = fn()
    return _MEMO[k]


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.labelled_orders(spark, sf_dir)


# ---------------------------------------------------------------- IO / validation
def q_load_labelled(spark, sf_dir):
    return labelled(spark, sf_dir).select(*LABELLED_COLUMNS)


def q_validate_target(spark, sf_dir):
    df = labelled(spark, sf_dir)
    V.require_columns(df, {"y_true", *P.COHORT_COLUMNS})
    return V.target_summary(df, "y_true")


# ---------------------------------------------------------------- predicates
def q_error_flags(spark, sf_dir):
    return M.error_flags(labelled(spark, sf_dir).select("row_id", "y_true", "y_pred"))


def q_false_positives(spark, sf_dir):
    df = labelled(spark, sf_dir).select("row_id", "y_true", "y_pred", "segment", "priority", "total_price")
    return M.false_positives(df)


def q_false_negatives(spark, sf_dir):
    df = labelled(spark, sf_dir).select("row_id", "y_true", "y_pred", "segment", "priority", "total_price")
    return M.false_negatives(df)


def q_cohort_filter(spark, sf_dir):
    """Cohort line_flag = 'R' and its complement; null flags fall in the complement."""
    df = labelled(spark, sf_dir).select("row_id", "line_flag")
    in_c = F.col("line_flag").eqNullSafe(F.lit("R"))
    return df.select("row_id", "line_flag", F.when(in_c, "cohort").otherwise("rest").alias("side"))


# ---------------------------------------------------------------- metrics
def q_global_metrics(spark, sf_dir):
    return M.binary_metrics(labelled(spark, sf_dir))


def q_cohort_metrics(spark, sf_dir):
    return M.cohort_metrics(labelled(spark, sf_dir), P.COHORT_COLUMNS)


def q_worst_cohorts(spark, sf_dir):
    return M.worst_cohorts(M.cohort_metrics(labelled(spark, sf_dir), P.COHORT_COLUMNS))


def q_global_vs_cohort(spark, sf_dir):
    return M.global_vs_cohort(labelled(spark, sf_dir), P.FOCUS_COLUMN, P.FOCUS_VALUE)


def q_strategy_row_prefixed(spark, sf_dir):
    df = labelled(spark, sf_dir)
    g = M.metrics_row(df, "global_")
    c = M.metrics_row(df, "cohort_", where=F.col(P.FOCUS_COLUMN) == P.FOCUS_VALUE)
    return M.metrics_rows(df, [g, c]).select(F.lit("rule").alias("strategy"), "*")


def q_class_balance(spark, sf_dir):
    return M.class_balance(labelled(spark, sf_dir), "y_learn", by=["segment"])


QUERIES = {
    "load_labelled": q_load_labelled,
    "validate_target": q_validate_target,
    "error_flags": q_error_flags,
    "false_positives": q_false_positives,
    "false_negatives": q_false_negatives,
    "cohort_filter": q_cohort_filter,
    "global_metrics": q_global_metrics,
    "cohort_metrics": q_cohort_metrics,
    "worst_cohorts": q_worst_cohorts,
    "global_vs_cohort": q_global_vs_cohort,
    "strategy_row_prefixed": q_strategy_row_prefixed,
    "class_balance": q_class_balance,
}


# ---------------------------------------------------------------- profile
from cohortlens.operators import dictionary as DI  # noqa: E402
from cohortlens.operators import prepare as PR  # noqa: E402
from cohortlens.operators import profile as PF  # noqa: E402
from cohortlens.operators import split as SP  # noqa: E402
from cohortlens.plans import subtract as SUB  # noqa: E402

TARGETS = ["row_id", "y_true", "y_pred", "y_learn"]
NUMERIC_FEATURES = ["total_price", "acctbal", "part_a", "part_b", "month"]
CATEGORICAL_FEATURES = ["segment", "line_flag"]
K_FOLDS = 5
SEED = 42


def q_drop_redundant(spark, sf_dir):
    return PF.drop_redundant(q_load_labelled(spark, sf_dir), P.REDUNDANT_COLUMNS)


def q_feature_groups(spark, sf_dir):
    df = q_load_labelled(spark, sf_dir)
    return PF.feature_groups_table(df, exclude=TARGETS)


def q_redundancy_checks(spark, sf_dir):
    return PF.redundancy_checks(
        labelled(spark, sf_dir),
        sums={"part_total": ["part_a", "part_b"]},
        zeros=["zero"],
        pairs=[("week", "month")],
    )


def q_high_correlations(spark, sf_dir):
    return PF.high_correlations(q_load_labelled(spark, sf_dir), exclude=TARGETS)


# ---------------------------------------------------------------- split
def q_stratified_rank(spark, sf_dir):
    df = labelled(spark, sf_dir).select("row_id", "y_true")
    return SP.hashed_rank(df, ["y_true"], SEED)


def q_stratified_split(spark, sf_dir):
    df = labelled(spark, sf_dir).select("row_id", "y_true")
    return SP.stratified_split(df, "y_true", 0.2, SEED)


def folds_table(spark, sf_dir, k=K_FOLDS):
    df = labelled(spark, sf_dir)
    return SP.add_folds(df, "y_learn", k, SEED)


def q_stratified_folds(spark, sf_dir):
    return folds_table(spark, sf_dir).select("row_id", "y_learn", "fold")


def q_fold_membership(spark, sf_dir):
    """Sizes of every fold's two sides: its own rows, and the total less them."""
    df = folds_table(spark, sf_dir).select("row_id", "y_learn", "fold")
    train = SUB.fold_counts(df, [], "y_learn", K_FOLDS).select("eval_fold", F.lit("train").alias("split"), F.col("n").alias("n_rows"), F.col("positives").alias("n_pos"))
    val = df.groupBy(F.col("fold").alias("eval_fold")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("y_learn") == 1).alias("n_pos"))
    return train.unionByName(val.select("eval_fold", F.lit("val").alias("split"), "n_rows", "n_pos"))


def q_learning_subsets(spark, sf_dir):
    """Sizes and positives of the nested subsets of every fold, as cuts of one rank."""
    cells, sizes = SUB.subset_cells(folds_table(spark, sf_dir), ["y_learn"], K_FOLDS, SP.FRACTIONS, 50, SEED, "row_id")
    held = SUB.subset_counts(cells, ["y_learn"], len(SP.FRACTIONS)).groupBy("eval_fold", "position").agg(
        F.sum("c").alias("n_rows"), F.sum(F.when(F.col("y_learn") == 1, F.col("c")).otherwise(0)).alias("n_pos")
    )
    size = F.array(*[F.array(*[F.lit(n).cast("long") for n in row]) for row in sizes])[F.col("eval_fold") - 1][F.col("position")]
    share = F.array(*[F.lit(float(f)) for f in SP.FRACTIONS])[F.col("position")]
    return held.select("eval_fold", share.alias("fraction"), size.alias("subset_n"), "n_rows", "n_pos")


# ---------------------------------------------------------------- prepare
def _round_doubles(df, digits=6):
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema.fields])


def q_fit_stats(spark, sf_dir):
    df = labelled(spark, sf_dir)
    stats = PR.fit_statistics(df, NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    return _round_doubles(PR.fit_stats_table(spark, stats))


def q_impute_median(spark, sf_dir):
    df = labelled(spark, sf_dir)
    cols = ["part_a", "part_b", "part_total"]
    med = PR.exact_medians(df, cols)
    return df.select("row_id", *[F.coalesce(F.col(c), F.lit(med[c])).alias(c) for c in cols])


def q_impute_mode(spark, sf_dir):
    df = labelled(spark, sf_dir)
    st = PR.fit_statistics(df, [], ["line_flag"])
    return df.select("row_id", F.coalesce("line_flag", F.lit(st["categorical"]["line_flag"]["mode"])).alias("line_flag"))


def q_standard_scale(spark, sf_dir):
    df = labelled(spark, sf_dir)
    model = PR.TablePreprocessor(numericCols=["total_price", "acctbal", "month", "zero"], keepCols=["row_id"]).fit(df)
    return _round_doubles(model.transform(df).drop("features"))


def q_one_hot(spark, sf_dir):
    df = labelled(spark, sf_dir)
    model = PR.TablePreprocessor(categoricalCols=["segment"], keepCols=["row_id"]).fit(df)
    return model.transform(df).drop("features")


def split_tables(spark, sf_dir):
    """Train/test split, computed once per session and stored (partitioned by
    side) in the shared folder: every fit, transform and protocol reads it."""

    def run():
        # the split reads its table several times: the joins behind it run once
        s = SP.stratified_split(CV.materialize(labelled(spark, sf_dir), "labelled"), "y_learn", 0.2, SEED)
        t = CV.materialize(s, "split", ["split"])
        return t.where(F.col("split") == "train").drop("split"), t.where(F.col("split") == "test").drop("split")

    return _memo(spark, ("split", sf_dir), run)


def fitted_preprocessor(train):
    return PR.TablePreprocessor(
        numericCols=NUMERIC_FEATURES, categoricalCols=CATEGORICAL_FEATURES, keepCols=["row_id", "y_learn"]
    ).fit(train)


def q_transform_test(spark, sf_dir):
    train, test = split_tables(spark, sf_dir)
    return _round_doubles(fitted_preprocessor(train).transform(test).drop("features"))


def q_transform_extra(spark, sf_dir):
    """The preparation fitted on train, applied to the extra table."""
    train, _ = split_tables(spark, sf_dir)
    return _round_doubles(fitted_preprocessor(train).transform(P.extra_rows(spark, sf_dir)).drop("features"))


def q_features_target(spark, sf_dir):
    """Features and target as two tables, the target (read as text) cast to int, aligned again by key."""
    df = PF.drop_redundant(q_load_labelled(spark, sf_dir), [*P.REDUNDANT_COLUMNS, "y_true", "y_pred"])
    x, y = PF.features_target(df.withColumn("y_learn", F.col("y_learn").cast("string")), "y_learn")
    return x.join(y, "row_id")


def q_dictionary_encode(spark, sf_dir):
    """Users and properties of purchases as a dictionary, applied to all events (null: unseen)."""
    ev = P.table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), "event_type", F.col("user_id").cast("string").alias("user"), "props")
    model = DI.DictionaryEncoder(inputCols=["user", "props"]).fit(ev.where("event_type = 'purchase'"))
    return model.indices(ev).select("row_id", "user_index", "props_index")


def q_dictionary_table(spark, sf_dir):
    ev = P.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("user"), "props", "event_type")
    return DI.DictionaryEncoder(inputCols=["user", "props", "event_type"]).fit(ev).dictionary()


def q_row_parity(spark, sf_dir):
    train, _ = split_tables(spark, sf_dir)
    prepared = fitted_preprocessor(train).transform(train)
    return V.row_parity(labelled(spark, sf_dir), prepared)


QUERIES.update(
    {
        "drop_redundant": q_drop_redundant,
        "feature_groups": q_feature_groups,
        "redundancy_checks": q_redundancy_checks,
        "high_correlations": q_high_correlations,
        "stratified_rank": q_stratified_rank,
        "stratified_split": q_stratified_split,
        "stratified_folds": q_stratified_folds,
        "fold_membership": q_fold_membership,
        "learning_subsets": q_learning_subsets,
        "fit_stats": q_fit_stats,
        "impute_median": q_impute_median,
        "impute_mode": q_impute_mode,
        "standard_scale": q_standard_scale,
        "one_hot": q_one_hot,
        "transform_test": q_transform_test,
        "transform_extra": q_transform_extra,
        "features_target": q_features_target,
        "dictionary_encode": q_dictionary_encode,
        "dictionary_table": q_dictionary_table,
        "row_parity": q_row_parity,
    }
)


# ---------------------------------------------------------------- resample
from cohortlens.operators import knn as KN  # noqa: E402
from cohortlens.operators import resample as RS  # noqa: E402

K_NN = 5


def events(spark, sf_dir):
    return P.events_labelled(spark, sf_dir).withColumn("x", F.array("x1", "x2"))


def _vec_out(df, names=("x1", "x2"), vec="x"):
    return [F.round(F.col(vec)[i], 6).alias(n) for i, n in enumerate(names)]


def q_knn_minority(spark, sf_dir):
    ev = events(spark, sf_dir).where("y = 1")
    return KN.knn(ev, K_NN, key="row_id", vec="x").withColumn("distance", F.round("distance", 6))


def q_smote_full(spark, sf_dir):
    rows, _ = RS.smote(events(spark, sf_dir), "y", "x", K_NN, SEED)
    return rows.select("row_id", "syn_j", "is_synthetic", "y", *_vec_out(rows), "neighbour_id")


def cohort_points(spark, sf_dir):
    return labelled(spark, sf_dir).withColumn("x", F.array("total_price", "acctbal"))


def q_smote_cohort(spark, sf_dir):
    df = cohort_points(spark, sf_dir)
    rows, _ = RS.smote_cohort(df, "y_learn", F.col(P.FOCUS_COLUMN) == P.FOCUS_VALUE, "x", K_NN, SEED, carry=["segment"])
    return rows.select("row_id", "syn_j", "is_synthetic", "y_learn", "segment", *_vec_out(rows, ("total_price", "acctbal")), "neighbour_id")


def q_smote_cohort_counts(spark, sf_dir):
    df = cohort_points(spark, sf_dir)
    rows, st = RS.smote_cohort(df, "y_learn", F.col(P.FOCUS_COLUMN) == P.FOCUS_VALUE, "x", K_NN, SEED, carry=["segment"])
    agg = rows.agg(
        F.count(F.lit(1)).alias("total_n_after"),
        F.count_if(F.col("segment") == P.FOCUS_VALUE).alias("cohort_resampled_n"),
        F.count_if(F.col("is_synthetic")).alias("cohort_synthetic_n"),
    )
    return agg.select(
        F.lit(st["cohort_original_n"]).cast("long").alias("cohort_original_n"),
        F.lit(st["cohort_original_minority_n"]).cast("long").alias("cohort_original_minority_n"),
        F.lit(st["cohort_original_majority_n"]).cast("long").alias("cohort_original_majority_n"),
        "cohort_resampled_n",
        "cohort_synthetic_n",
        "total_n_after",
    )


QUERIES.update(
    {
        "knn_minority": q_knn_minority,
        "smote_full": q_smote_full,
        "smote_cohort": q_smote_cohort,
        "smote_cohort_counts": q_smote_cohort_counts,
    }
)


# ---------------------------------------------------------------- protocols (group-rate estimator)
from cohortlens.operators.estimators import GroupRateClassifier  # noqa: E402
from cohortlens.operators.joins import align_rows  # noqa: E402
from cohortlens.plans import crossval as CV  # noqa: E402

def rate_learner() -> CV.Learner:
    est = GroupRateClassifier(groupCols=["segment", "priority"], labelCol="y_learn")
    feat = lambda train: (lambda df: df.withColumn("x", F.array("total_price", "acctbal")))
    return CV.Learner(est, feat, "x", needs_vectors=False, stateless_features=True)


RATE_SPEC = CV.Spec(target="y_learn", cohort_column=P.FOCUS_COLUMN, cohort_value=P.FOCUS_VALUE, k=K_FOLDS, seed=SEED, carry=["priority"])


RATE_COLUMNS = ["row_id", "y_learn", "segment", "priority", "total_price", "acctbal"]


def rate_inputs(spark, sf_dir):
    """CV folds over the train split only; the test split is never seen by selection."""
    train, _ = split_tables(spark, sf_dir)
    df = SP.add_folds(train.select(*RATE_COLUMNS), "y_learn", K_FOLDS, SEED)
    extra = P.extra_rows(spark, sf_dir).select(*RATE_COLUMNS)
    return df, extra


def rate_cv(spark, sf_dir):
    def run():
        df, extra = rate_inputs(spark, sf_dir)
        return CV.strategy_cv(df, extra, rate_learner(), RATE_SPEC)

    return _memo(spark, ("rate_cv", sf_dir), run)


def q_strategy_cv_rate(spark, sf_dir):
    preds, _ = rate_cv(spark, sf_dir)
    return CV.comparison(preds, RATE_SPEC)


def q_fold_metrics(spark, sf_dir):
    preds, _ = rate_cv(spark, sf_dir)
    return CV.fold_metrics(preds)


def q_oof_predictions_rate(spark, sf_dir):
    preds, _ = rate_cv(spark, sf_dir)
    return CV.oof_predictions(preds).drop("strategy")


# ---------------------------------------------------------------- reports over the protocol
from cohortlens.plans import report as RP  # noqa: E402
from cohortlens.sources import reports as JR  # noqa: E402
from cohortlens.sources import tables as TB  # noqa: E402


def rate_comparison(spark, sf_dir):
    preds, _ = rate_cv(spark, sf_dir)
    return CV.comparison(preds, RATE_SPEC)


def q_rank_strategies(spark, sf_dir):
    return RP.rank_strategies(rate_comparison(spark, sf_dir)).select("rank", "strategy", "global_f1", "cohort_f1")


def q_selected_strategy(spark, sf_dir):
    return RP.selected_strategy(rate_comparison(spark, sf_dir))


def q_strategy_deltas(spark, sf_dir):
    return RP.strategy_deltas(rate_comparison(spark, sf_dir))


def q_strategy_long(spark, sf_dir):
    return RP.strategy_long(rate_comparison(spark, sf_dir))


def q_train_val_by_strategy(spark, sf_dir):
    preds, _ = rate_cv(spark, sf_dir)
    return RP.train_val_by_strategy(CV.fold_metrics(preds))


def q_smote_summary(spark, sf_dir):
    _, st = rate_cv(spark, sf_dir)
    return RP.smote_summary(st)


def q_strategy_sizes(spark, sf_dir):
    preds, _ = rate_cv(spark, sf_dir)
    return RP.strategy_sizes(preds, RATE_SPEC.in_cohort())


def q_strategy_table(spark, sf_dir):
    preds, _ = rate_cv(spark, sf_dir)
    return RP.strategy_table(rate_comparison(spark, sf_dir), RP.strategy_sizes(preds, RATE_SPEC.in_cohort()))


def q_cohort_breakdown(spark, sf_dir):
    train, _ = split_tables(spark, sf_dir)
    extra = P.extra_rows(spark, sf_dir)
    return RP.cohort_breakdown(train, extra, "y_learn", F.col(P.FOCUS_COLUMN) == P.FOCUS_VALUE)


def q_cohort_summary(spark, sf_dir):
    preds, _ = rate_cv(spark, sf_dir)
    oof = CV.oof_predictions(preds)
    train, _ = split_tables(spark, sf_dir)
    raw = train.select("row_id", "priority", "nation", "line_flag")
    joined = align_rows(oof.select("row_id", "y_true", "y_pred", "segment"), raw)
    return RP.cohort_summary(M.cohort_metrics(joined, P.COHORT_COLUMNS))


def q_align_predictions(spark, sf_dir):
    """raw x prepared x OOF prediction, aligned by key (inner equi-joins)."""
    preds, _ = rate_cv(spark, sf_dir)
    oof = CV.oof_predictions(preds).select("row_id", "fold", "y_pred", "is_error")
    train, _ = split_tables(spark, sf_dir)
    prepared = fitted_preprocessor(train).transform(train).select("row_id", F.round("total_price", 6).alias("total_price_scaled"))
    raw = train.select("row_id", "y_learn", "segment", "total_price")
    return align_rows(raw, prepared, oof)


def rate_final(spark, sf_dir):
    def run():
        train, test = split_tables(spark, sf_dir)
        sel = RP.selected_strategy(rate_comparison(spark, sf_dir)).first()["strategy"]  # one name
        extra = P.extra_rows(spark, sf_dir).select(*RATE_COLUMNS)
        model, f, _ = CV.fit_final(train.select(*RATE_COLUMNS), extra, sel, rate_learner(), RATE_SPEC)
        preds = CV.test_predictions(model, f, test.select(*RATE_COLUMNS), RATE_SPEC, sel)
        return CV.materialize(preds, "final-test"), sel

    return _memo(spark, ("rate_final", sf_dir), run)


def q_final_test_rate(spark, sf_dir):
    preds, _ = rate_final(spark, sf_dir)
    return M.global_vs_cohort(preds, RATE_SPEC.cohort_column, RATE_SPEC.cohort_value, by=["strategy"])


def q_final_vs_cohort(spark, sf_dir):
    return RP.final_vs_cohort(q_final_test_rate(spark, sf_dir))


def q_best_strategy_tvt(spark, sf_dir):
    preds, _ = rate_cv(spark, sf_dir)
    test, sel = rate_final(spark, sf_dir)
    tm = M.binary_metrics(test)
    return RP.best_strategy_tvt(CV.fold_metrics(preds), tm, RP.selected_strategy(rate_comparison(spark, sf_dir)))


def q_report_json(spark, sf_dir):
    """Comparison metadata as one JSON document per strategy row."""
    ranked = RP.rank_strategies(rate_comparison(spark, sf_dir))
    return JR.json_report(ranked, ["rank", "strategy", "global_n", "global_tp", "cohort_n", "cohort_tp"], "report").orderBy("report")


def q_roundtrip_csv(spark, sf_dir):
    return TB.roundtrip_csv(q_load_labelled(spark, sf_dir))


def rate_curve(spark, sf_dir):
    def run():
        df, _ = rate_inputs(spark, sf_dir)
        return CV.materialize(CV.learning_curve(df, rate_learner(), RATE_SPEC), "curve")

    return _memo(spark, ("rate_curve", sf_dir), run)


def q_learning_curve_rate(spark, sf_dir):
    return rate_curve(spark, sf_dir)


def q_curve_verdict(spark, sf_dir):
    return CV.curve_verdict(rate_curve(spark, sf_dir))


def q_augmentation_rate(spark, sf_dir):
    train, _ = split_tables(spark, sf_dir)
    extra = P.extra_rows(spark, sf_dir).select(*RATE_COLUMNS)
    return CV.augmentation_comparison(train.select(*RATE_COLUMNS), extra, rate_learner(), RATE_SPEC)


def q_smote_fold_stats(spark, sf_dir):
    _, st = rate_cv(spark, sf_dir)
    return st


def q_append_extra(spark, sf_dir):
    df = labelled(spark, sf_dir).select("row_id", "y_learn", "segment").withColumn("source", F.lit("train"))
    ex = P.extra_rows(spark, sf_dir).select("row_id", "y_learn", "segment").withColumn("source", F.lit("extra"))
    return df.unionByName(ex, allowMissingColumns=True)


QUERIES.update(
    {
        "strategy_cv_rate": q_strategy_cv_rate,
        "fold_metrics": q_fold_metrics,
        "oof_predictions_rate": q_oof_predictions_rate,
        "smote_fold_stats": q_smote_fold_stats,
        "append_extra": q_append_extra,
        "rank_strategies": q_rank_strategies,
        "selected_strategy": q_selected_strategy,
        "strategy_deltas": q_strategy_deltas,
        "strategy_long": q_strategy_long,
        "train_val_by_strategy": q_train_val_by_strategy,
        "smote_summary": q_smote_summary,
        "strategy_sizes": q_strategy_sizes,
        "strategy_table": q_strategy_table,
        "cohort_breakdown": q_cohort_breakdown,
        "cohort_summary": q_cohort_summary,
        "align_predictions": q_align_predictions,
        "final_test_rate": q_final_test_rate,
        "final_vs_cohort": q_final_vs_cohort,
        "best_strategy_tvt": q_best_strategy_tvt,
        "report_json": q_report_json,
        "roundtrip_csv": q_roundtrip_csv,
        "learning_curve_rate": q_learning_curve_rate,
        "curve_verdict": q_curve_verdict,
        "augmentation_rate": q_augmentation_rate,
    }
)


# ---------------------------------------------------------------- learned models (rows-only checks)
from cohortlens.operators.estimators import BoundedFit, CentroidClassifier, forest, logistic  # noqa: E402
from cohortlens.operators.smote_model import RawSmoteEstimator  # noqa: E402
from cohortlens.plans import scoring as SC  # noqa: E402
from cohortlens.plans import selection as SEL  # noqa: E402
from cohortlens.plans.fits import ModelStore, scored  # noqa: E402
from cohortlens.sources.models_io import load_model  # noqa: E402

# the reference's forest, folds and grids
RF_TREES, RF_DEPTH, RF_FOLDS = 200, 15, 5
FIT_ROWS = None  # no bound: every model is fitted on all rows of its fold
KEEP = ["row_id", "y_learn", "segment", "priority", "origin", "syn_j", "is_synthetic", "fold", "eval_fold", "_src", "_uid"]
RF_SPEC = CV.Spec(target="y_learn", cohort_column=P.FOCUS_COLUMN, cohort_value=P.FOCUS_VALUE, k=RF_FOLDS, seed=SEED, carry=["priority"])


def _preparer():
    return PR.TablePreprocessor(numericCols=NUMERIC_FEATURES, categoricalCols=CATEGORICAL_FEATURES, keepCols=KEEP, arrayCol="x")


def _prep_featurizer(train):
    model = _preparer().fit(train)
    return lambda df: model.transform(df).drop("features")


FOREST_MB = 256  # large fits have many open nodes: smaller groups of node statistics keep tasks within an executor's heap


def rf_learner(depth=RF_DEPTH, min_leaf=1, balanced=True, trees=RF_TREES) -> CV.Learner:
    """The forest of the reference, fitted on every row of its table."""
    est = BoundedFit(forest("y_learn", "x", trees, depth, min_leaf, balanced, SEED, memory_mb=FOREST_MB), FIT_ROWS)
    return CV.Learner(est, _prep_featurizer, "x", needs_vectors=True, threads=CV.CURVE_THREADS)


def curve_learner(depth=RF_DEPTH, trees=RF_TREES) -> CV.Learner:
    return CV.Learner(forest("y_learn", "x", trees, depth, 1, True, SEED, memory_mb=FOREST_MB), _prep_featurizer, "x", needs_vectors=True, threads=CV.CURVE_THREADS)


def lr_learner(C=1.0, balanced=True) -> CV.Learner:
    return CV.Learner(BoundedFit(logistic("y_learn", "x", C, balanced), FIT_ROWS), _prep_featurizer, "x", needs_vectors=True)


def rf_inputs(spark, sf_dir):
    train, _ = split_tables(spark, sf_dir)
    cols = ["row_id", "y_learn", "segment", "priority", *[c for c in NUMERIC_FEATURES + CATEGORICAL_FEATURES if c != "segment"]]
    df = SP.add_folds(train.select(*cols), "y_learn", RF_FOLDS, SEED)
    extra = P.extra_rows(spark, sf_dir).select(*cols)
    return df, extra


# the protocols with a learner that reads vectors: preparation per fold, exact kNN and
# SMOTE vectors all run, and the answer still has an exact oracle
CENTROID_FEATURES = ["total_price", "acctbal", "part_total"]
CENTROID_SPEC = CV.Spec(target="y_learn", cohort_column=P.FOCUS_COLUMN, cohort_value=P.FOCUS_VALUE, k=K_FOLDS, seed=SEED)


def _centroid_featurizer(train):
    model = PR.TablePreprocessor(numericCols=CENTROID_FEATURES, keepCols=KEEP, arrayCol="x").fit(train)
    return lambda df: model.transform(df).drop("features")


def centroid_learner() -> CV.Learner:
    return CV.Learner(CentroidClassifier(inputCol="x", labelCol="y_learn"), _centroid_featurizer, "x", needs_vectors=True)


def centroid_inputs(spark, sf_dir):
    train, _ = split_tables(spark, sf_dir)
    cols = ["row_id", "y_learn", "segment", *CENTROID_FEATURES]
    return SP.add_folds(train.select(*cols), "y_learn", K_FOLDS, SEED), P.extra_rows(spark, sf_dir).select(*cols)


def centroid_cv(spark, sf_dir):
    def run():
        df, extra = centroid_inputs(spark, sf_dir)
        return CV.strategy_cv(df, extra, centroid_learner(), CENTROID_SPEC)

    return _memo(spark, ("centroid_cv", sf_dir), run)


def q_strategy_cv_centroid(spark, sf_dir):
    return CV.comparison(centroid_cv(spark, sf_dir)[0], CENTROID_SPEC)


def q_fold_metrics_centroid(spark, sf_dir):
    return CV.fold_metrics(centroid_cv(spark, sf_dir)[0])


def q_oof_predictions_centroid(spark, sf_dir):
    """Out-of-fold rows of the strategy with SMOTE: they depend on its vectors."""
    return CV.oof_predictions(centroid_cv(spark, sf_dir)[0], "smote").drop("strategy")


QUERIES.update(
    {
        "strategy_cv_centroid": q_strategy_cv_centroid,
        "fold_metrics_centroid": q_fold_metrics_centroid,
        "oof_predictions_centroid": q_oof_predictions_centroid,
    }
)


def rf_baseline_cv(spark, sf_dir):
    """The baseline strategy alone: all that out-of-fold reports need."""

    def run():
        df, _ = rf_inputs(spark, sf_dir)
        return CV.strategy_cv(df, None, rf_learner(), RF_SPEC, ["baseline"])[0]

    return _memo(spark, ("rf_baseline_cv", sf_dir), run)


def rf_cv(spark, sf_dir):
    def run():
        first = rf_baseline_cv(spark, sf_dir)
        df, extra = rf_inputs(spark, sf_dir)
        others, stats = CV.strategy_cv(df, extra, rf_learner(), RF_SPEC, [s for s in CV.STRATEGIES if s != "baseline"])
        return first.unionByName(others), stats

    return _memo(spark, ("rf_cv", sf_dir), run)


def q_feature_vector(spark, sf_dir):
    train, test = split_tables(spark, sf_dir)
    f = _prep_featurizer(train)
    return f(test).select("row_id", "x")


def q_feature_entries(spark, sf_dir):
    """Entries of the assembled vectors of the test rows: (row_id, position, value)."""
    return q_feature_vector(spark, sf_dir).select("row_id", F.posexplode("x").alias("position", "v")).select("row_id", "position", F.round("v", 6).alias("value"))


def raw_smote_centroid() -> RawSmoteEstimator:
    prep = PR.TablePreprocessor(numericCols=CENTROID_FEATURES, keepCols=["row_id", "y_learn", "segment"], arrayCol="x")
    return RawSmoteEstimator(
        prep, CentroidClassifier(inputCol="x", labelCol="y_learn"), P.FOCUS_VALUE, targetCol="y_learn", cohortCol=P.FOCUS_COLUMN,
        redundantCols=["week", "zero"], k=K_NN, seed=SEED,
    )


def q_final_smote_cohort_centroid(spark, sf_dir):
    """Raw train rows to a saved model with SMOTE in the focus cohort; the reloaded model scores the raw test rows."""
    train, test = split_tables(spark, sf_dir)
    path = ModelStore(spark).save("raw-smote", raw_smote_centroid().fit(train))
    out = load_model(path).transform(test).select("row_id", "segment", F.col("y_learn").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))
    return M.error_flags(out)


def q_oof_predictions(spark, sf_dir):
    return CV.oof_predictions(rf_baseline_cv(spark, sf_dir)).drop("strategy")


def q_strategy_cv(spark, sf_dir):
    preds, _ = rf_cv(spark, sf_dir)
    return CV.comparison(preds, RF_SPEC)


def q_oof_cohort_report(spark, sf_dir):
    oof = CV.oof_predictions(rf_baseline_cv(spark, sf_dir))
    train, _ = split_tables(spark, sf_dir)
    joined = align_rows(oof.select("row_id", "y_true", "y_pred", "segment"), train.select("row_id", "priority", "nation", "line_flag"))
    return M.worst_cohorts(M.cohort_metrics(joined, P.COHORT_COLUMNS))


def rf_final(spark, sf_dir):
    def run():
        train, test = split_tables(spark, sf_dir)
        df, extra = rf_inputs(spark, sf_dir)
        sel = RP.selected_strategy(q_strategy_cv(spark, sf_dir)).first()["strategy"]
        model = SC.fit_final_model(df.drop("fold"), extra, sel, rf_learner().estimator, _preparer(), RF_SPEC)
        return ModelStore(spark).save("final", model), sel, test

    return _memo(spark, ("rf_final", sf_dir), run)


def q_final_test_metrics(spark, sf_dir):
    path, sel, test = rf_final(spark, sf_dir)
    preds = scored([SC.final_predictions(load_model(path), test, RF_SPEC, sel)], "final-predictions")
    return M.global_vs_cohort(preds, RF_SPEC.cohort_column, RF_SPEC.cohort_value, by=["strategy"])


def q_score_table(spark, sf_dir):
    """Score the test split with the final model: class and P(1)."""
    path, _, test = rf_final(spark, sf_dir)
    return SC.score(path, test, target="y_learn", redundant=tuple(P.REDUNDANT_COLUMNS))


def baseline(spark, sf_dir, store=None):
    """Full grids over the folds; parameters are chosen on whole folds, and the best model is refitted on all rows."""
    df, _ = rf_inputs(spark, sf_dir)
    cands = {
        "logistic_regression": (lambda p: lr_learner(p["C"], p["balanced"]), SEL.LOGISTIC_GRID),
        "random_forest": (lambda p: rf_learner(p["depth"], p["min_leaf"], p["balanced"]), SEL.FOREST_GRID),
    }
    return SEL.select_baseline(df, cands, RF_SPEC, _preparer(), store)


def q_baseline_selection(spark, sf_dir):
    return baseline(spark, sf_dir).comparison


def q_learning_curve(spark, sf_dir):
    df, _ = rf_inputs(spark, sf_dir)
    return CV.learning_curve(df, curve_learner(), RF_SPEC)


def q_augmentation_comparison(spark, sf_dir):
    df, extra = rf_inputs(spark, sf_dir)
    return CV.augmentation_comparison(df.drop("fold"), extra, rf_learner(), RF_SPEC)


QUERIES.update(
    {
        "feature_vector": q_feature_vector,
        "feature_entries": q_feature_entries,
        "final_smote_cohort_centroid": q_final_smote_cohort_centroid,
        "oof_predictions": q_oof_predictions,
        "strategy_cv": q_strategy_cv,
        "oof_cohort_report": q_oof_cohort_report,
        "final_test_metrics": q_final_test_metrics,
        "score_table": q_score_table,
        "baseline_selection": q_baseline_selection,
        "learning_curve": q_learning_curve,
        "augmentation_comparison": q_augmentation_comparison,
    }
)


# ---------------------------------------------------------------- other labelled tables
def q_validate_document_labels(spark, sf_dir):
    """Target checks on documents left-joined with their quality labels (nulls = unlabelled)."""
    return V.target_summary(P.document_labels(spark, sf_dir), "quality")


def q_knn_embeddings(spark, sf_dir):
    """Exact kNN in 64 dimensions among the embeddings of each label."""
    pts = P.embedding_points(spark, sf_dir)
    return KN.knn(pts, K_NN, key="row_id", vec="features", by=["label"]).withColumn("distance", F.round("distance", 6))


QUERIES.update({"validate_document_labels": q_validate_document_labels, "knn_embeddings": q_knn_embeddings})
