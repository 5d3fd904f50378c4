"""One-hot encoding of string columns of any number of values: a stored dictionary and sparse vectors.

``fit`` counts (column, value) pairs, orders them by range over the cluster and stores a table
(feature, value, n, rank); the most frequent value of each column (the lowest on
ties) comes from the same counts.  ``transform`` fills nulls with that value, joins the
dictionary on equality and builds sparse vectors in the JVM.  The driver sees a size
and a most frequent value for each column, never the values.

Defined results: an unseen value has no index and encodes as all zeros; a column without values in
training has no entries and no place in the vector; any type is read as its text; ranks follow the byte order of values
and start at 0 in each column.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.operators.joins import MAX_BROADCAST_BYTES, broadcast_if_small
from cohortlens.session import scratch_path, stored_bytes

MAX_BROADCAST_VALUES = 500_000  # at about 100 bytes a value in memory
AT_BITS = 33  # monotonically_increasing_id: the row within its partition is in the lower 33 bits


def build(df: DataFrame, cols: list[str]) -> tuple[str, dict[str, dict]]:
    """(path of the stored dictionary, column -> size and most frequent value)."""
    spark = df.sparkSession
    each = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = df.select(F.inline(each)).where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.repartitionByRange("feature", "value").sortWithinPartitions("feature", "value").withColumn("_id", F.monotonically_increasing_id())
    at = scratch_path(spark, "dictionary-order")
    ordered.write.parquet(at)
    ordered = spark.read.parquet(at).withColumn("_part", F.shiftright("_id", AT_BITS)).withColumn("_row", F.col("_id").bitwiseAND((1 << AT_BITS) - 1))
    so_far = lambda by: F.coalesce(F.sum("c").over(Window.partitionBy(F.lit(0)).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row for each partition, and one for each column
    parts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("c")).select("_part", so_far("_part").alias("_before"))
    per = ordered.groupBy("feature").agg(F.count(F.lit(1)).alias("c"), F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    per = per.select("feature", "c", "mode", so_far("feature").alias("_start"))
    table = ordered.join(broadcast_if_small(parts), "_part").join(broadcast_if_small(per.select("feature", "_start")), "feature")
    path = scratch_path(spark, "dictionary")
    table.select("feature", "value", "n", (F.col("_row") + F.col("_before") - F.col("_start")).cast("int").alias("rank")).write.parquet(path)
    found = {r["feature"]: {"size": r["c"], "mode": r["mode"]} for r in per.collect()}
    return path, {c: found.get(c, {"size": 0, "mode": None}) for c in cols}


class _DictionaryParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to encode", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "sparse vector column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCols=[], outputCol="encoded")


class DictionaryEncoder(Estimator, _DictionaryParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="encoded"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "DictionaryModel":
        cols = self.getOrDefault("inputCols")
        path, columns = build(df, cols)
        return DictionaryModel(inputCols=cols, outputCol=self.getOrDefault("outputCol"), columns=json.dumps(columns), path=path)


class _ModelWriter(MLWriter):
    def __init__(self, instance: "DictionaryModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.dictionary().write.parquet(f"{path}/dictionary")


class _ModelReader(DefaultParamsReader):
    def load(self, path: str) -> "DictionaryModel":
        model = super().load(path)
        model._set(path=f"{path}/dictionary")  # wherever the saved model lies now
        return model


class DictionaryModel(Model, _DictionaryParams, MLReadable, MLWritable):
    columns = Param(Params._dummy(), "columns", "size and most frequent value of each column (JSON)", TypeConverters.toString)
    path = Param(Params._dummy(), "path", "stored dictionary", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="encoded", columns=None, path=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> "_ModelReader":
        return _ModelReader(cls)

    def dictionary(self) -> DataFrame:
        """(feature, value, n, rank)."""
        return SparkSession.active().read.schema("feature string, value string, n bigint, rank int").parquet(self.getOrDefault("path"))

    def known(self) -> dict[str, dict]:
        """Size and most frequent value of each column that has values, in the order of the vector."""
        return {c: s for c, s in json.loads(self.getOrDefault("columns")).items() if s["size"]}

    def indices(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<column>_index``: the rank of each value, null where unseen."""
        table, known = self.dictionary(), self.known()
        small = sum(s["size"] for s in known.values()) <= MAX_BROADCAST_VALUES and stored_bytes(df.sparkSession, self.getOrDefault("path")) <= MAX_BROADCAST_BYTES
        out = df
        for i, (c, s) in enumerate(known.items()):
            side = table.where(F.col("feature") == c).select(F.col("value").alias(f"_v{i}"), F.col("rank").alias(f"{c}_index"))
            filled = F.coalesce(F.col(c).cast("string"), F.lit(s["mode"]))
            # keys are unique on the dictionary's side; a hot value on the other is split by adaptive execution
            out = out.join(F.broadcast(side) if small else side, filled == F.col(f"_v{i}"), "left").drop(f"_v{i}")
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        known = self.known()
        if not known:
            raise ValueError("No column had a value when the dictionary was fitted")
        tags = {c: (f"_i{i}", f"_o{i}") for i, c in enumerate(known)}
        ins, outs = [t[0] for t in tags.values()], [t[1] for t in tags.values()]
        # an index equal to the size is the extra category of unseen values, which is dropped
        coded = self.indices(df).select(*df.columns, *[F.coalesce(F.col(f"{c}_index"), F.lit(known[c]["size"])).cast("double").alias(i) for c, (i, _) in tags.items()])
        widest = df.sparkSession.range(1).select(*[F.lit(float(known[c]["size"] - 1)).alias(i) for c, (i, _) in tags.items()])
        hot = OneHotEncoder(inputCols=ins, outputCols=outs, handleInvalid="keep", dropLast=True).fit(widest)
        return VectorAssembler(inputCols=outs, outputCol=self.getOrDefault("outputCol")).transform(hot.transform(coded)).drop(*ins, *outs)
