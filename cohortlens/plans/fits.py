"""How models are fitted: tables of few partitions, concurrent jobs in fair pools, a store of models.

A tree or solver pass over a table is one Spark stage, so a fit is a chain of
many short stages.  What it costs beyond the arithmetic is the exchange between
partitions at every pass.  ``fit_table`` therefore stores the rows a model is
fitted on once, with a partition for each ``ROWS_PER_TASK`` rows, and independent
fits run at the same time, each in a fair scheduler pool of its own.

A fitted forest holds hundreds of thousands of nodes.  ``scored`` applies a model
and writes the rows at once, so that no plan keeps a model in the driver, and
``ModelStore`` keeps fitted models as files in the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from cohortlens.session import path_exists, scratch_path

FIT_THREADS = 8  # concurrent fits submitted from the driver
ROWS_PER_TASK = 20_000


def materialize(df: DataFrame, name: str, partition_by=None) -> DataFrame:
    """Write to a fresh path in the shared folder and read back (lineage cut)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def run_concurrently(tasks: list[Callable], threads: int = FIT_THREADS) -> list:
    """Run independent fits as concurrent Spark jobs; results keep task order.

    Each thread has its own pool: with fair scheduling the short stages of one fit
    do not wait for all tasks of another.
    """
    if threads <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    spark = SparkSession.active()
    inherit = inheritable_thread_target(spark)

    def one(job: tuple[int, Callable]):
        def run():
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{job[0] % threads}")
            return job[1]()

        return inherit(run)()

    with ThreadPoolExecutor(max_workers=threads) as pool:
        # jobs of the threads keep the caller's job group
        return list(pool.map(one, enumerate(tasks)))


def is_bounded(estimator: Estimator) -> bool:
    """Whether the estimator reads only a part of the table it is given."""
    return getattr(estimator, "max_rows", None) is not None


def fit_table(estimator: Estimator, rows: DataFrame, name: str = "fit-rows") -> tuple[Estimator, DataFrame]:
    """(estimator, table): the rows that ``estimator`` reads, stored once, and the estimator that reads them all."""
    if hasattr(estimator, "fitted_rows"):
        rows, estimator = estimator.fitted_rows(rows), estimator.estimator
    stored = materialize(rows, name)
    # as few partitions as the rows need, never more than they have
    return estimator, stored.coalesce(max(1, math.ceil(stored.count() / ROWS_PER_TASK)))


def scored(parts: list[DataFrame], name: str = "scored") -> DataFrame:
    """Union of scored rows, written at once: the plan that is handed on holds no model."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return materialize(out, name)


class ModelStore:
    """Fitted models as files below one folder (a fresh one in the shared folder if none is given)."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, (path or scratch_path(spark, "models")).rstrip("/")

    def where(self, name: str) -> str:
        return f"{self.path}/{name}"

    def save(self, name: str, model: PipelineModel) -> str:
        model.write().overwrite().save(self.where(name))
        return self.where(name)

    def load(self, name: str) -> PipelineModel:
        if name not in self:
            raise KeyError(f"The store at {self.path} has no model {name}")
        return PipelineModel.load(self.where(name))

    def __contains__(self, name: str) -> bool:
        return path_exists(self.spark, self.where(name))


__all__ = ["ModelStore", "fit_table", "is_bounded", "materialize", "run_concurrently", "scored"]
