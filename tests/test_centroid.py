"""Nearest class mean: against plain Python, saved and loaded, and inside the protocols."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import prepare as PR
from cohortlens.operators.estimators import CentroidClassifier, CentroidModel
from cohortlens.plans import catalog as C

TABLES = "customer nation orders lineitem events".split()


def points(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, label int, x array<double>")


def plain(rows, x):
    def mean(c):
        of = [v for _, y, v in rows if y == c and v is not None]
        return [sum(col) / len(of) for col in zip(*of)]

    apart = lambda m: sum((a - b) ** 2 for a, b in zip(x, m))
    return 1.0 if apart(mean(1)) < apart(mean(0)) else 0.0


def test_against_plain_python(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, i % 3 == 0 and 1 or 0, [r.gauss(i % 3 == 0, 1), r.gauss(0, 2), r.random()]) for i in range(200)]
    df = points(spark, rows + [(900, None, [9.0, 9.0, 9.0]), (901, 1, None)]).repartition(4)
    model = CentroidClassifier().fit(df)
    want = {i: plain(rows, x) for i, _, x in rows}
    got = lambda m: {x["row_id"]: x["prediction"] for x in m.transform(points(spark, rows)).collect()}
    assert got(model) == want and len(set(want.values())) == 2
    model.write().overwrite().save(str(tmp_path / "centroid"))
    assert got(CentroidModel.load(str(tmp_path / "centroid"))) == want


def test_edges(spark):
    tie = CentroidClassifier().fit(points(spark, [(1, 0, [0.0]), (2, 1, [2.0])]))
    assert [x["prediction"] for x in tie.transform(points(spark, [(3, 0, [1.0])])).collect()] == [0.0]
    for label in (0, 1):
        one = CentroidClassifier().fit(points(spark, [(1, label, [0.0]), (2, label, [5.0])]))
        assert {x["prediction"] for x in one.transform(points(spark, [(3, 0, [1.0])])).collect()} == {float(label)}
    with pytest.raises(ValueError, match="at least one row"):
        CentroidClassifier().fit(points(spark, []))


def test_protocol_reads_vectors_and_preparation(spark, smoke_dir):
    """Equal to the oracle, and not what one gets without SMOTE vectors, or with raw columns."""
    from oracle.sql import SQL

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    clean = lambda rows: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in x) for x in rows)
    for name in ("strategy_cv_centroid", "fold_metrics_centroid", "oof_predictions_centroid"):
        df = C.QUERIES[name](spark, smoke_dir)
        assert clean(df.collect()) == clean(con.execute(f"SELECT {', '.join(df.columns)} FROM ({SQL[name]})").fetchall())

    preds, _ = C.centroid_cv(spark, smoke_dir)
    val = preds.where("split = 'val'").select("strategy", "row_id", "y_pred")
    of = lambda s: {x["row_id"]: x["y_pred"] for x in val.where(F.col("strategy") == s).collect()}
    base = of("baseline")
    for s in ("smote", "real_data"):
        assert of(s).keys() == base.keys() and of(s) != base, s
    # the cohort's classes are nearly even: its few synthetic rows move the means, at this size no validation row
    assert of("smote_cohort").keys() == base.keys()
    assert preds.where("strategy = 'smote_cohort' AND origin = 'synthetic'").count() > 0

    # the same learner on columns that are filled but not scaled
    df, _ = C.centroid_inputs(spark, smoke_dir)
    names = C.CENTROID_FEATURES

    def filled(train):
        stats = PR.fit_statistics(train, names, [])["numeric"]
        return lambda t: t.withColumn("x", F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(stats[c]["median"])) for c in names]))

    raw = C.CV.Learner(C.CentroidClassifier(inputCol="x", labelCol="y_learn"), filled, "x")
    got, _ = C.CV.strategy_cv(df, None, raw, C.CENTROID_SPEC, ["baseline"])
    unscaled = {x["row_id"]: x["y_pred"] for x in got.where("split = 'val'").collect()}
    assert unscaled.keys() == base.keys() and unscaled != base
