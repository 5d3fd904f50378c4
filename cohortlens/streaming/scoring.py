"""Apply a fitted preparation + model to a streaming table.

A ``PipelineModel`` (and the toolkit's ``TablePreprocessorModel``) are
row-wise maps once fitted, so they run unchanged on a streaming DataFrame:
no state, no watermark.  Results go to a file sink; the caller names the
checkpoint folder, and a query restarted with it resumes exactly once.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def score_stream(model, stream: DataFrame, featurize=None, key: str = "row_id", target: str | None = None) -> DataFrame:
    """(key, prediction, probability of class 1) for every arriving row."""
    df = stream.drop(target) if target and target in stream.columns else stream
    if featurize is not None:
        df = featurize(df)
    out = model.transform(df)
    prob = vector_to_array("probability")[1] if "probability" in out.columns else F.lit(None).cast("double")
    return out.select(key, F.col("prediction").cast("int").alias("prediction"), prob.alias("probability"))


def start_scoring(scored: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Write scores as parquet; ``once`` processes what is available and stops."""
    w = scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if once else w
    return w.start()
