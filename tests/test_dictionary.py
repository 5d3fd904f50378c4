"""Stored dictionaries and sparse one-hot vectors."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.operators.dictionary import DictionaryEncoder, DictionaryModel
from cohortlens.session import scratch_path

SCHEMA = "row_id int, a string, b string, none string"


@pytest.fixture(scope="module")
def train(spark):
    rows = [(1, "x", "é", None), (2, "y", "z", None), (3, "x", None, None), (4, None, "z", None), (5, "y", "", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def vectors(model, df):
    out = model.transform(df)
    return {r["row_id"]: r["v"] for r in out.select("row_id", vector_to_array(model.getOrDefault("outputCol")).alias("v")).collect()}


def test_ranks_modes_and_vectors(spark, train):
    model = DictionaryEncoder(inputCols=["a", "b", "none"]).fit(train)
    table = {(r["feature"], r["value"]): (r["rank"], r["n"]) for r in model.dictionary().collect()}
    assert table == {("a", "x"): (0, 2), ("a", "y"): (1, 2), ("b", ""): (0, 1), ("b", "z"): (1, 2), ("b", "é"): (2, 1)}
    assert {c: s["mode"] for c, s in model.known().items()} == {"a": "x", "b": "z"}  # a tie goes to the lowest value
    test = spark.createDataFrame([(1, "y", "é", "q"), (2, None, None, None), (3, "new", "", None)], SCHEMA)
    assert vectors(model, test) == {1: [0, 1, 0, 0, 1], 2: [1, 0, 0, 1, 0], 3: [0, 0, 1, 0, 0]}
    assert model.transform(test).columns == [*test.columns, "encoded"]
    path = scratch_path(spark, "dictionary-model")
    model.write().overwrite().save(path)
    again = DictionaryModel.load(path)
    assert again.getOrDefault("path").startswith(path) and vectors(again, test) == vectors(model, test)


def test_nothing_to_encode(train):
    model = DictionaryEncoder(inputCols=["none"]).fit(train)
    assert model.dictionary().count() == 0 and model.known() == {}
    with pytest.raises(ValueError, match="No column"):
        model.transform(train)
    assert DictionaryEncoder(inputCols=["a"]).fit(train.limit(0)).known() == {}


@pytest.mark.parametrize("small", [True, False])
def test_a_hundred_thousand_values(spark, monkeypatch, small):
    """Every third row holds one value; each other value is rare. Nothing of them is in the model's parameters."""
    from cohortlens.operators import dictionary as DI

    if not small:
        monkeypatch.setattr(DI, "MAX_BROADCAST_VALUES", 10)  # a shuffle join instead of a broadcast
    n = 150_000
    df = spark.range(n).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("v%06d", "id")).alias("a"))
    model = DictionaryEncoder(inputCols=["a"]).fit(df)
    assert model.known() == {"a": {"size": 100_001, "mode": "hot"}} and len(model.getOrDefault("columns")) < 100
    got = model.indices(df).agg(
        F.count("a_index").alias("n"), F.countDistinct("a_index").alias("d"), F.max("a_index").alias("hi"),
        F.count_if((F.col("a") == "hot") & (F.col("a_index") != 0)).alias("wrong"),
        F.count_if((F.col("a") != "hot") & (F.col("a_index") != (F.col("row_id") - F.floor(F.col("row_id") / 3)))).alias("moved"),
    ).first()
    assert (got["n"], got["d"], got["hi"], got["wrong"], got["moved"]) == (n, 100_001, 100_000, 0, 0)
    one = model.transform(df.where("row_id = 149999")).first()["encoded"]
    assert one.size == 100_001 and list(one.indices) == [100_000]
