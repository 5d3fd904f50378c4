"""Protocol invariants and oracle parity on the smallest scale factor."""

import duckdb
import pytest
from pyspark.sql import functions as F

from cohortlens.plans import catalog as C

TABLES = "nation customer orders lineitem events documents labels embeddings".split()


@pytest.fixture(scope="module")
def duck(smoke_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    return con


def rows_of(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize(
    "name",
    ["worst_cohorts", "cohort_metrics", "stratified_split", "stratified_folds", "high_correlations", "strategy_cv_rate", "fold_metrics", "smote_cohort_counts", "learning_curve_rate", "validate_document_labels", "knn_embeddings"],
)
def test_oracle_parity(spark, smoke_dir, duck, name):
    from oracle.sql import SQL

    df = C.QUERIES[name](spark, smoke_dir)
    res = duck.execute(SQL[name])
    cols = [d[0] for d in res.description]
    want = sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in (dict(zip(cols, r))[c] for c in df.columns)) for r in res.fetchall())
    assert rows_of(df) == want


def test_validation_rows_are_real_and_complete(spark, smoke_dir):
    preds, _ = C.rate_cv(spark, smoke_dir)
    val = preds.where("split = 'val'")
    assert val.where("syn_j <> 0 or origin <> 'train'").count() == 0
    train, _ = C.split_tables(spark, smoke_dir)
    for s in C.CV.STRATEGIES:
        one = val.where(F.col("strategy") == s)
        assert one.count() == train.count()
        assert one.select("row_id").distinct().count() == train.count()
        # no row is validated while it is in its own fit table
        leak = preds.where((F.col("strategy") == s) & (F.col("split") == "train") & (F.col("origin") == "train")).alias("t").join(
            one.alias("v"), (F.col("t.row_id") == F.col("v.row_id")) & (F.col("t.fold") == F.col("v.fold"))
        )
        assert leak.count() == 0


def test_batched_and_looped_protocols_agree(spark, smoke_dir):
    df, extra = C.rate_inputs(spark, smoke_dir)
    looped = C.rate_learner()
    looped.stateless_features = False  # forces the per-fold loop
    p1, s1 = C.CV.strategy_cv(df, extra, looped, C.RATE_SPEC)
    p2, s2 = C.CV.strategy_cv(df, extra, C.rate_learner(), C.RATE_SPEC)
    cols = ["strategy", "fold", "split", "row_id", "syn_j", "y_true", "y_pred"]
    assert rows_of(p1.select(*cols)) == rows_of(p2.select(*cols))
    assert rows_of(s1.select(*sorted(s1.columns))) == rows_of(s2.select(*sorted(s2.columns)))


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns[:2] == ["cohort_feature", "cohort_value"]
    assert df.count() > 0


def test_extra_rows_are_in_no_split(spark, smoke_dir):
    from cohortlens.sources import proxies as P

    extra = {r.row_id - P.EXTRA_KEY_SHIFT for r in P.extra_rows(spark, smoke_dir).select("row_id").collect()}
    train, test = C.split_tables(spark, smoke_dir)
    kept = {r.row_id for t in (train, test) for r in t.select("row_id").collect()}
    assert extra and kept and not extra & kept
    assert len(extra) + len(kept) == P.labelled_all(spark, smoke_dir).count()


def test_logistic_c_is_the_penalty_of_the_summed_loss(spark):
    """One feature, closed by Newton steps on sum(loss) + w^2 / (2 C), intercept free."""
    import math

    from cohortlens.operators.estimators import logistic

    rows = [(float(i % 7) / 3 - 1, int((i * 5) % 11 > 4 - i % 7)) for i in range(200)]
    df = spark.createDataFrame([([x], y) for x, y in rows], "x array<double>, y int")
    found = {}
    for strength in (0.01, 1.0, 100.0):
        w = b = 0.0
        for _ in range(50):
            p = [1 / (1 + math.exp(-(w * x + b))) for x, _ in rows]
            gw = sum((q - y) * x for q, (x, y) in zip(p, rows, strict=True)) + w / strength
            gb = sum(q - y for q, (_, y) in zip(p, rows, strict=True))
            v = [q * (1 - q) for q in p]
            hww, hwb, hbb = sum(a * x * x for a, (x, _) in zip(v, rows, strict=True)) + 1 / strength, sum(a * x for a, (x, _) in zip(v, rows, strict=True)), sum(v)
            det = hww * hbb - hwb * hwb
            w, b = w - (hbb * gw - hwb * gb) / det, b - (hww * gb - hwb * gw) / det
        found[strength] = logistic("y", "x", strength, balanced=False).fit(df).stages[-1].coefficients[0]
        assert abs(found[strength] - w) < 1e-3
    assert abs(found[0.01]) < abs(found[1.0]) < abs(found[100.0])


def test_forest_depth_limit():
    from cohortlens.operators.estimators import forest

    with pytest.raises(ValueError, match="30 levels"):
        forest("y", depth=31)
    assert forest("y", depth=None).getStages()[-1].getMaxDepth() == 30


def test_final_model_scores_raw_tables_after_reload(spark, smoke_dir):
    """One saved pipeline scores a table or a path, with or without target and redundant columns."""
    from cohortlens.operators.estimators import forest
    from cohortlens.plans import scoring as SC
    from cohortlens.session import scratch_path
    from cohortlens.sources import proxies as P
    from cohortlens.sources.models_io import save_model

    df, extra = C.rf_inputs(spark, smoke_dir)
    _, test = C.split_tables(spark, smoke_dir)
    for strategy in ("baseline", "real_data"):
        model = SC.fit_final_model(df.drop("fold"), extra, strategy, forest("y_learn", "x", 3, 3), C._preparer(), C.RF_SPEC)
        path, table = save_model(model, scratch_path(spark, "final")), scratch_path(spark, "raw")
        test.write.parquet(table)
        want = {tuple(r) for r in SC.score(model, test).collect()}
        assert len(want) == test.count()
        for m, d in ((path, test), (model, table), (path, table)):
            assert {tuple(r) for r in SC.score(m, d, spark, target="y_learn", redundant=tuple(P.REDUNDANT_COLUMNS)).collect()} == want


def test_incomplete_fold_scores_are_an_error(spark):
    from cohortlens.operators.validate import assert_complete, require_strategy_column

    train = spark.range(5).withColumnRenamed("id", "row_id")
    assert_complete(train, train)
    with pytest.raises(RuntimeError):
        assert_complete(train, train.where("row_id < 4"))
    with pytest.raises(ValueError):
        require_strategy_column(train)
