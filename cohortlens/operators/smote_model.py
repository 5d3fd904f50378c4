"""An estimator that oversamples inside ``fit`` only.

``SmoteEstimator(inner, ...)`` resamples the fit table with SMOTE (over the
whole table, or inside one cohort when ``cohort_column`` is given) and fits
``inner`` on the result.  The returned model is the inner model itself, so
scoring never augments and the model persists with Spark ML's writer.  The
resampling sizes of the last fit are kept in ``last_stats``.

``RawSmoteEstimator`` does all of it from raw rows: cleaning, preparation, cohort mask and
SMOTE run inside ``fit``, and both the estimator (with the two it holds) and its
model can be saved and loaded.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.param.shared import HasInputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import resample as RS
from cohortlens.operators.profile import drop_redundant
from cohortlens.operators.validate import require_columns, validate


class SmoteEstimator(Estimator):
    def __init__(
        self,
        inner: Estimator,
        target: str,
        vec: str = "x",
        cohort_column: str | None = None,
        cohort_value=None,
        k: int = 5,
        seed: int = 42,
        key: str = "row_id",
        carry: list[str] | None = None,
        needs_vectors: bool = True,
    ):
        super().__init__()
        self.inner = inner
        self.target, self.vec, self.key = target, vec, key
        self.cohort_column, self.cohort_value = cohort_column, cohort_value
        self.k, self.seed = k, seed
        self.carry = list(carry or [])
        self.needs_vectors = needs_vectors
        self.last_stats: dict | None = None

    def resample(self, df: DataFrame) -> tuple[DataFrame, dict]:
        carry = list(dict.fromkeys([*self.carry, *([self.cohort_column] if self.cohort_column else [])]))
        if self.cohort_column is None:
            return RS.smote(df, self.target, self.vec, self.k, self.seed, self.key, carry, self.needs_vectors)
        in_cohort = F.col(self.cohort_column).eqNullSafe(F.lit(self.cohort_value))
        return RS.smote_cohort(df, self.target, in_cohort, self.vec, self.k, self.seed, self.key, carry, self.needs_vectors)

    def _fit(self, df: DataFrame):
        rows, stats = self.resample(df)
        self.last_stats = stats
        return self.inner.fit(rows.drop("neighbour_id"))


class DropColumns(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Drops those of ``inputCols`` that a table has."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return drop_redundant(df, self.getInputCols())


class _HeldWriter(MLWriter):
    """Metadata of an estimator, and the estimators it holds in folders beside it."""

    def __init__(self, instance: "RawSmoteEstimator"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        held = {"preparer": self.instance.preparer, "inner": self.instance.inner}
        for name, stage in held.items():
            if not isinstance(stage, MLWritable) and not hasattr(stage, "write"):
                raise ValueError(f"The {name} estimator {type(stage).__name__} cannot be saved")
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for name, stage in held.items():
            stage.write().save(f"{path}/{name}")


class _HeldReader(DefaultParamsReader):
    def load(self, path: str) -> "RawSmoteEstimator":
        out = super().load(path)
        out.preparer = DefaultParamsReader.loadParamsInstance(f"{path}/preparer", self.sparkSession)
        out.inner = DefaultParamsReader.loadParamsInstance(f"{path}/inner", self.sparkSession)
        return out


class RawSmoteEstimator(Estimator, MLReadable, MLWritable):
    """Raw labelled rows in, one model for raw rows out.

    ``fit`` drops the redundant columns, fits ``preparer`` on the real rows, marks the
    cohort (a null value is outside, unless the cohort is null itself: ``cohortValue`` absent), grows its smaller class with SMOTE on
    prepared vectors and fits ``inner`` on real and synthetic rows.  Without ``cohortCol`` the
    whole table is grown.  The model is a ``PipelineModel`` of cleaning, preparation and the inner
    model: scoring never augments and needs neither target nor redundant columns.
    ``preparer`` must keep the key, target and cohort columns and write ``vecCol``.
    """

    targetCol = Param(Params._dummy(), "targetCol", "binary target", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "row key", TypeConverters.toString)
    vecCol = Param(Params._dummy(), "vecCol", "array<double> column that the preparer writes", TypeConverters.toString)
    cohortCol = Param(Params._dummy(), "cohortCol", "cohort column (empty: whole table)", TypeConverters.toString)
    cohortValue = Param(Params._dummy(), "cohortValue", "cohort value as JSON", TypeConverters.toString)
    redundantCols = Param(Params._dummy(), "redundantCols", "columns that cleaning drops", TypeConverters.toListString)
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of draws", TypeConverters.toInt)

    def __init__(self, preparer: Estimator | None = None, inner: Estimator | None = None, cohort_value=None, **params):
        super().__init__()
        self.preparer, self.inner = preparer, inner
        self._setDefault(targetCol="label", keyCol="row_id", vecCol="x", cohortCol="", cohortValue="null", redundantCols=[], k=5, seed=42)
        if cohort_value is not None:
            params["cohortValue"] = json.dumps(cohort_value)
        self._set(**params)
        self.last_stats: dict | None = None

    def write(self) -> MLWriter:
        return _HeldWriter(self)

    @classmethod
    def read(cls) -> "_HeldReader":
        return _HeldReader(cls)

    def _fit(self, df: DataFrame) -> PipelineModel:
        of = self.getOrDefault
        target, key, vec, cohort = of("targetCol"), of("keyCol"), of("vecCol"), of("cohortCol")
        require_columns(df, {target, key, *([cohort] if cohort else [])})
        validate(df, target)
        clean = DropColumns(inputCols=of("redundantCols"))
        rows = clean.transform(df)
        prepared = self.preparer.fit(rows)
        smote = SmoteEstimator(self.inner, target, vec, cohort or None, json.loads(of("cohortValue")), of("k"), of("seed"), key)
        model = smote.fit(prepared.transform(rows))
        self.last_stats = smote.last_stats
        return PipelineModel([clean, prepared, *(model.stages if isinstance(model, PipelineModel) else [model])])
