"""Estimators used by the evaluation protocols.

* ``GroupRateClassifier``: predicts 1 when the training positive rate of the
  row's group is at least the overall training rate (``pos_g * n >= pos *
  n_g`` in integers; an unseen group predicts 0).  Fitting is one grouped
  aggregate, so the whole fold/augment/score protocol around it has an
  exact SQL counterpart.
* ``CentroidClassifier``: predicts the class whose mean vector is nearer (class 0
  on equal distance).  It reads the vectors, so preparation and SMOTE change its
  answers, and its fit is one aggregate with an exact SQL counterpart.
* ``forest`` / ``logistic``: Spark ML pipelines over an ``array<double>``
  feature column, with ``balanced`` class weights via ``weightCol``.
* ``ArrayToVector``: array<double> -> ML vector.
* ``predicted``: the class a fitted model gives each row; a forest is walked tree by
  tree for many rows at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.hashing import hash_unit
from cohortlens.operators.joins import broadcast_if_small
from cohortlens.session import scratch_path


class ArrayToVector(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCol="x", outputCol="features"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), array_to_vector(F.col(self.getInputCol())))


class BalancedWeights(Estimator, HasLabelCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """weight = n / (2 * n_class), learned by one aggregate over the fit table."""

    @keyword_only
    def __init__(self, *, labelCol="label", outputCol="weight"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "BalancedWeightsModel":
        y = F.col(self.getLabelCol())
        n, pos = df.agg(F.count(F.lit(1)), F.count_if(y == 1)).first()
        return BalancedWeightsModel(
            labelCol=self.getLabelCol(), outputCol=self.getOutputCol(),
            negativeWeight=n / (2.0 * (n - pos)) if n > pos else 1.0, positiveWeight=n / (2.0 * pos) if pos else 1.0,
        )


class BalancedWeightsModel(Model, HasLabelCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the learned weight of the row's class; tables without a label (scoring) pass unchanged."""

    negativeWeight = Param(Params._dummy(), "negativeWeight", "weight of class 0", TypeConverters.toFloat)
    positiveWeight = Param(Params._dummy(), "positiveWeight", "weight of class 1", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, labelCol="label", outputCol="weight", negativeWeight=1.0, positiveWeight=1.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        y = self.getLabelCol()
        if y not in df.columns:
            return df
        w = F.when(F.col(y) == 1, self.getOrDefault("positiveWeight")).otherwise(self.getOrDefault("negativeWeight"))
        return df.withColumn(self.getOutputCol(), w)


class LogisticByC(Estimator, HasLabelCol):
    """L2 logistic regression whose strength is given as C, the inverse penalty of the summed loss.

    Spark averages the loss over the weight sum, so its penalty is 1 / (C * sum of
    weights); that sum is taken from the table the estimator is fitted on.
    """

    def __init__(self, label: str, C: float = 1.0, weight: str | None = None, max_iter: int = 2000):
        super().__init__()
        self._set(labelCol=label)
        self.C, self.weight, self.max_iter = C, weight, max_iter

    def _fit(self, df: DataFrame):
        total = df.agg(F.sum(self.weight) if self.weight else F.count(F.lit(1)).cast("double")).first()[0]
        kw = {"weightCol": self.weight} if self.weight else {}
        return LogisticRegression(
            labelCol=self.getLabelCol(), featuresCol="features", maxIter=self.max_iter, regParam=1.0 / (self.C * total),
            elasticNetParam=0.0, standardization=False, **kw,
        ).fit(df)


class _GroupRateParams(HasLabelCol):
    groupCols = Param(Params._dummy(), "groupCols", "group columns", TypeConverters.toListString)
    modelCols = Param(Params._dummy(), "modelCols", "one independent model per value of these columns", TypeConverters.toListString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(predictionCol="prediction", modelCols=[])


class GroupRateClassifier(Estimator, _GroupRateParams):
    @keyword_only
    def __init__(self, *, groupCols=None, labelCol="label", predictionCol="prediction", modelCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def with_models(self, cols: list[str]) -> "GroupRateClassifier":
        """Same estimator fitting one model per value of ``cols`` in one job."""
        return GroupRateClassifier(groupCols=self.getOrDefault("groupCols"), labelCol=self.getLabelCol(),
                                   predictionCol=self.getOrDefault("predictionCol"), modelCols=cols)

    def _fit(self, df: DataFrame) -> "GroupRateModel":
        g, y = self.getOrDefault("groupCols"), self.getLabelCol()
        mc = self.getOrDefault("modelCols")
        return self.fit_counts(df.groupBy(*mc, *g).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(y) == 1).alias("positives")), mc)

    def fit_counts(self, counts: DataFrame, model_cols: list[str]) -> "GroupRateModel":
        """The fit from its sufficient statistics: (model columns, group columns, n, positives), one model per value of ``model_cols``."""
        g, mc = self.getOrDefault("groupCols"), model_cols
        stats = counts.select(*mc, *g, F.col("n").alias("_ng"), F.col("positives").alias("_pg"))
        # per-model totals: a plain aggregate of the group table, joined back
        stats = stats.withColumn("_all", F.lit(1))
        totals = stats.groupBy(*mc, "_all").agg(F.sum("_ng").alias("_n"), F.sum("_pg").alias("_p"))
        stats = stats.join(broadcast_if_small(totals), [*mc, "_all"])  # one row per model
        rule = stats.select(*mc, *g, (F.col("_pg") * F.col("_n") >= F.col("_p") * F.col("_ng")).cast("int").alias("_rule"))
        m = GroupRateModel(groupCols=[*mc, *g], predictionCol=self.getOrDefault("predictionCol"))
        # one row per (model, group); scored rows join it on possibly hot group keys
        m.rules = broadcast_if_small(rule)
        return m


class GroupRateModel(Model, _GroupRateParams):
    rules: DataFrame
    ruleCol = "_rule"

    @keyword_only
    def __init__(self, *, groupCols=None, predictionCol="prediction"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault("groupCols")
        out = df.join(self.rules, g, "left")
        return out.withColumn(self.getOrDefault("predictionCol"), F.coalesce(F.col("_rule"), F.lit(0)).cast("double")).drop("_rule")


class _CentroidParams(HasLabelCol, HasInputCol):
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(predictionCol="prediction", inputCol="x")


class CentroidClassifier(Estimator, _CentroidParams, DefaultParamsReadable, DefaultParamsWritable):
    """Nearest class mean over an array<double> column; null labels or vectors are not read.

    With rows of one class only, every row is predicted to be of that class; a table
    without any row is an error.
    """

    @keyword_only
    def __init__(self, *, inputCol="x", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "CentroidModel":
        x, y = F.col(self.getInputCol()), F.col(self.getLabelCol())
        rows = df.where(x.isNotNull() & y.isNotNull()).select(y.alias("y"), x.alias("x"))
        first = rows.select(F.size("x").alias("d")).first()  # one scalar
        if first is None:
            raise ValueError("A centroid needs at least one row")
        means = rows.groupBy("y").agg(F.array(*[F.avg(F.col("x")[i]) for i in range(first["d"])]).alias("m"))
        found = {int(r["y"]): r["m"] for r in means.collect()}  # one row per class
        return CentroidModel(
            inputCol=self.getInputCol(), labelCol=self.getLabelCol(), predictionCol=self.getOrDefault("predictionCol"),
            negativeMean=found.get(0, []), positiveMean=found.get(1, []),
        )


class CentroidModel(Model, _CentroidParams, DefaultParamsReadable, DefaultParamsWritable):
    negativeMean = Param(Params._dummy(), "negativeMean", "mean vector of class 0 (empty: none seen)", TypeConverters.toListFloat)
    positiveMean = Param(Params._dummy(), "positiveMean", "mean vector of class 1 (empty: none seen)", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol="x", labelCol="label", predictionCol="prediction", negativeMean=None, positiveMean=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        neg, pos = self.getOrDefault("negativeMean"), self.getOrDefault("positiveMean")
        if not neg or not pos:
            return df.withColumn(self.getOrDefault("predictionCol"), F.lit(1.0 if pos else 0.0))
        x = F.col(self.getInputCol())
        # one sum over the components, left to right: no array of differences is built
        apart = lambda mean: sum(((x[i] - F.lit(m)) * (x[i] - F.lit(m)) for i, m in enumerate(mean)), F.lit(0.0))
        return df.withColumn(self.getOrDefault("predictionCol"), F.when(apart(pos) < apart(neg), 1.0).otherwise(0.0))


class BoundedFit(Estimator):
    """Fits ``estimator`` on about ``max_rows`` rows of its table, chosen by a hash of their key; on all rows if that is None.

    Only fitting is bounded: folds and validation scores cover every row, and
    train scores cover ``fitted_rows``.  The choice is a filter on a hash, so it
    is the same for any partitioning.
    """

    def __init__(self, estimator: Estimator, max_rows: int | None, key: str = "row_id", seed: int = 42):
        super().__init__()
        self.estimator, self.max_rows, self.key, self.seed = estimator, max_rows, key, seed

    def fitted_rows(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` that ``fit`` reads."""
        if self.max_rows is None:
            return df
        n = df.count()
        if n > self.max_rows:
            keys = [F.col(c) for c in (self.key, "syn_j") if c in df.columns]
            df = df.where(hash_unit(self.seed, F.lit("fit"), *keys) < self.max_rows / n)
        return df

    def _fit(self, df: DataFrame):
        return self.estimator.fit(self.fitted_rows(df))


def forest(label: str, vec: str = "x", trees: int = 200, depth: int = 15, min_leaf: int = 1, balanced: bool = True, seed: int = 42, memory_mb: int = 1024) -> Pipeline:
    """Random forest on an array<double> feature column (sqrt feature subsets).

    ``depth=None`` (unlimited) means Spark's limit of 30; a larger number is an error.
    """
    if depth is not None and depth > 30:
        raise ValueError(f"Spark trees have at most 30 levels, {depth} were asked for")
    stages = [ArrayToVector(inputCol=vec, outputCol="features")]
    kw = {}
    if balanced:
        stages.append(BalancedWeights(labelCol=label, outputCol="weight"))
        kw["weightCol"] = "weight"
    stages.append(
        RandomForestClassifier(
            labelCol=label,
            featuresCol="features",
            numTrees=trees,
            maxDepth=30 if depth is None else depth,
            minInstancesPerNode=min_leaf,
            featureSubsetStrategy="sqrt",
            cacheNodeIds=True,  # else every pass ships the trees grown so far to the tasks
            checkpointInterval=-1,  # the cached ids of a fit are few; a lost one is computed again
            maxMemoryInMB=memory_mb,  # node statistics gathered at once: fewer passes over the rows
            seed=seed,
            **kw,
        )
    )
    return Pipeline(stages=stages)


def logistic(label: str, vec: str = "x", C: float = 1.0, balanced: bool = True, max_iter: int = 2000) -> Pipeline:
    """L2 logistic regression on an array<double> feature column."""
    stages = [ArrayToVector(inputCol=vec, outputCol="features")]
    if balanced:
        stages.append(BalancedWeights(labelCol=label, outputCol="weight"))
    return Pipeline(stages=[*stages, LogisticByC(label, C, "weight" if balanced else None, max_iter)])


FLAT_NODES = 1_000_000  # nodes of a forest that tasks take along as arrays (44 bytes each)
ROWS_AT_ONCE = 4096


def flat_trees(spark, model: RandomForestClassificationModel) -> list[tuple]:
    """(levels, feature, threshold, next, votes) of each tree; a leaf leads to itself.

    Places are even numbers, two for a node: ``next`` has its right child at the
    first, its left child at the second.  ``votes`` are a leaf's class shares.
    """
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.impurityStats", "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"), F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).toArrow()  # the nodes of one model
    col = {c: rows[c].to_numpy() for c in rows.column_names if c != "impurityStats"}
    order = np.lexsort((col["id"], col["treeID"]))
    col = {c: v[order] for c, v in col.items()}
    stats = rows["impurityStats"].combine_chunks().flatten().to_numpy().reshape(len(order), -1)[order]
    trees = []
    starts = np.flatnonzero(np.r_[True, np.diff(col["treeID"]) != 0])
    for a, b in zip(starts, [*starts[1:], len(order)], strict=True):
        n = b - a
        left, right = col["leftChild"][a:b].astype(np.int64), col["rightChild"][a:b].astype(np.int64)
        leaf = left < 0
        follow = np.empty(2 * n, np.int64)
        follow[0::2], follow[1::2] = (2 * np.where(leaf, np.arange(n), x) for x in (right, left))
        total = stats[a:b].sum(1, keepdims=True)
        votes = np.divide(stats[a:b], total, out=np.zeros_like(stats[a:b]), where=total != 0)
        levels, at = 0, np.zeros(1, np.int64)
        while len(at := at[~leaf[at]]):
            levels, at = levels + 1, np.concatenate([left[at], right[at]])
        trees.append((levels, np.repeat(np.where(leaf, 0, col["feature"][a:b]).astype(np.int64), 2), np.repeat(np.where(leaf, np.inf, col["threshold"][a:b]), 2), follow, np.repeat(votes, 2, axis=0)))
    return trees


def forest_classes(trees: list[tuple], x: np.ndarray) -> np.ndarray:
    """The class with most votes of each row (the first of equals); votes add up in the order of the trees."""
    out = np.empty(len(x))
    for begin in range(0, len(x), ROWS_AT_ONCE):
        some = np.ascontiguousarray(x[begin : begin + ROWS_AT_ONCE])
        values, base = some.ravel(), np.arange(len(some)) * some.shape[1]
        votes = np.zeros((len(some), trees[0][4].shape[1]))
        for levels, feature, threshold, follow, share in trees:
            at = np.zeros(len(some), np.int64)
            for _ in range(levels):
                at = follow.take(at + (values.take(base + feature.take(at)) <= threshold.take(at)))
            votes += share[at]
        out[begin : begin + len(some)] = votes.argmax(1)
    return out


def predicted(model: Model, df: DataFrame) -> DataFrame:
    """``df`` with the column ``prediction`` that ``model.transform`` gives.

    Spark follows each row through all trees, which drops one tree after the other
    from the processor's cache; here a tree stays there for ``ROWS_AT_ONCE`` rows.
    """
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    last = stages[-1]
    if not isinstance(last, RandomForestClassificationModel) or not isinstance(stages[0], ArrayToVector) or last.isDefined(last.thresholds) or last.totalNumNodes > FLAT_NODES:
        return model.transform(df)
    if not hasattr(model, "_flat"):  # train and validation rows share them
        model._flat = flat_trees(df.sparkSession, last)
    trees = model._flat

    @F.arrow_udf("double")
    def classes(x: pa.Array) -> pa.Array:
        return pa.array(forest_classes(trees, x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)) if len(x) else [], pa.float64())

    return df.withColumn("prediction", classes(F.col(stages[0].getInputCol())))
