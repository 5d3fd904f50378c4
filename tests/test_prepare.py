import pytest
from pyspark.sql import functions as F

from cohortlens.operators import prepare as PR
from cohortlens.operators import profile as PF
from cohortlens.sources import models_io as IO
from cohortlens.session import scratch_path


def test_mode_tie_takes_lowest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    st = PR.fit_statistics(df, [], ["c"])
    assert st["categorical"]["c"]["mode"] == "a"
    assert st["categorical"]["c"]["vocabulary"] == ["a", "b"]


def test_median_even_and_odd(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    assert PR.exact_median(df, "x") == 2.5
    assert PR.exact_median(df.where("x < 4"), "x") == 2.0


def test_median_many_buckets_with_hot_value(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    vals = list(rng.normal(size=3000)) + [7.0] * 1500  # a third of the rows are one value
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    assert PR.exact_median(df, "x", buckets=64) == pytest.approx(float(np.median(vals)))


def test_constant_column_scale_one(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 3.0)], "c double, x double")
    m = PR.TablePreprocessor(numericCols=["c", "x"]).fit(df)
    st = m.statistics["numeric"]
    assert st["c"]["scale"] == 1.0 and st["x"]["std"] == pytest.approx((2 / 3) ** 0.5)
    out = m.transform(df).collect()
    assert all(r["c"] == 0.0 for r in out)
    assert sum(r["x"] for r in out) == pytest.approx(0.0)


def test_unseen_category_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "s string")
    test = spark.createDataFrame([("z",)], "s string")
    m = PR.TablePreprocessor(categoricalCols=["s"]).fit(train)
    r = m.transform(test).first()
    assert (r["s_a"], r["s_b"]) == (0.0, 0.0)
    assert m.feature_names() == ["s_a", "s_b"]


def test_preprocessor_roundtrip(spark):
    train = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, None)], "x double, s string")
    m = PR.TablePreprocessor(numericCols=["x"], categoricalCols=["s"], arrayCol="v").fit(train)
    path = scratch_path(spark, "prep-model")
    m.write().overwrite().save(path)
    back = PR.TablePreprocessorModel.load(path)
    assert [r["v"] for r in back.transform(train).collect()] == [r["v"] for r in m.transform(train).collect()]


def test_constant_column_correlation_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0), (3.0, 0.0)], "a double, z double")
    t = PF.redundancy_checks(df, sums={}, zeros=["z"], pairs=[("a", "z")]).collect()
    assert t[0]["passed"] is True and t[1]["value"] is None
    assert PF.high_correlations(df).count() == 0


def test_total_with_null_fails_derivation(spark):
    df = spark.createDataFrame([(3.0, 1.0, 2.0), (None, 1.0, 1.0)], "t double, a double, b double")
    r = PF.redundancy_checks(df, sums={"t": ["a", "b"]}).first()
    assert r["passed"] is False
    r2 = PF.redundancy_checks(df.where("t is not null"), sums={"t": ["a", "b"]}).first()
    assert r2["passed"] is True


def test_model_save_load_scores_equal(spark):
    from cohortlens.operators.estimators import forest

    rows = [(i, i % 2, [float(i % 7), float(i % 2) + 0.1 * (i % 3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, y int, x array<double>")
    model = forest("y", "x", trees=5, depth=3).fit(df)
    path = scratch_path(spark, "forest")
    IO.save_model(model, path)
    back = IO.load_model(path)
    a = [r["prediction"] for r in model.transform(df).orderBy("row_id").collect()]
    b = [r["prediction"] for r in back.transform(df).orderBy("row_id").collect()]
    assert a == b
    with pytest.raises(FileNotFoundError):
        IO.load_model("/nonexistent/model")
