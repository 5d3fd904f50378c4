import pytest

from cohortlens.operators import profile as PF
from cohortlens.operators import validate as V
from cohortlens.sources import tables as TB
from cohortlens.session import scratch_path


def test_missing_columns_sorted(spark):
    df = spark.createDataFrame([(1,)], "other int")
    with pytest.raises(V.ValidationError, match=r"\['b', 'target'\]"):
        V.validate(df, "target", ["b"])


def test_null_target(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (0, "z")], "t int, c string")
    with pytest.raises(V.ValidationError, match="have no value"):
        V.validate(df, "t", ["c"])


def test_target_outside_domain(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (0, "z")], "t int, c string")
    with pytest.raises(V.ValidationError, match=r"1 other values: \[2\]"):
        V.validate(df, "t", ["c"])


def test_valid_passes_through(spark):
    df = spark.createDataFrame([(1, "x"), (0, "y")], "t int, c string")
    assert V.validate(df, "t", ["c"]) is df


def test_empty_csv_load_error(spark):
    path = scratch_path(spark, "empty")
    spark.createDataFrame([], "a int, b string").coalesce(1).write.option("header", True).csv(path)
    with pytest.raises(TB.EmptyTableError):
        TB.load_table(spark, path, schema="a int, b string", fmt="csv")


def test_missing_path(spark):
    with pytest.raises(FileNotFoundError):
        TB.load_table(spark, "/nonexistent/path/x.parquet")


def test_date_column_unclassified(spark):
    df = spark.sql("select 1 as a, 'x' as b, date'2024-01-01' as d")
    with pytest.raises(ValueError, match=r"\['d'\]"):
        PF.feature_groups(df)
    g = PF.feature_groups(df, strict=False)
    assert g.numeric == ["a", "d"] and g.categorical == ["b"]


def test_row_parity_and_completeness(spark):
    a = spark.range(5).withColumnRenamed("id", "row_id")
    b = spark.range(1, 6).withColumnRenamed("id", "row_id")
    r = V.row_parity(a, b).first()
    assert (r["only_left"], r["only_right"], r["n_both"], r["parity"]) == (1, 1, 4, False)
    with pytest.raises(RuntimeError):
        V.assert_complete(a, b)


def test_roundtrip_csv_and_optional(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5)], "row_id long, s string, x double")
    back = TB.roundtrip_csv(df)
    assert sorted(map(tuple, back.collect()), key=lambda t: t[0]) == [(1, "a", None), (2, None, 2.5)]
    assert TB.optional_table(spark, "/nonexistent/extra.csv") is None
