"""Fit-on-train feature preparation, applied to any table.

numeric: median imputation, then standard scaling with the *population*
std (a constant column keeps scale 1); strings: most-frequent imputation
(lowest value on ties), then one-hot over the sorted training vocabulary
(an unseen value encodes as all zeros).  Output: the prepared scalar
columns, numeric block first, plus an assembled ``features`` vector.

Statistics are computed with distributed aggregates.  The exact median never
gathers a column into one task: the range holding the middle rank is narrowed until it is small, and
only that range is ordered.
"""

from __future__ import annotations

import json
import math

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.profile import feature_groups

SCALE_EPS = 10 * 2.220446049250313e-16  # below this a std counts as zero


SMALL_RANGE = 100_000  # rows of a range that one task may order


def _narrow(x: DataFrame, ranges: dict[str, tuple], buckets: int) -> dict[str, list[tuple]]:
    """Value ranges of about equal row counts inside each column's range: (least, largest, rows), ascending.

    Two aggregates: approximate quantiles inside the ranges, then rows, least and largest value
    of every range between them.  Each quantile is a range of its own, so a hot value never shares one.
    """
    names = {c: i for i, c in enumerate(ranges)}
    probs = [i / buckets for i in range(1, buckets)]
    inside = x.select(*[F.when(F.col(c).between(lo, hi), F.col(c)).alias(c) for c, (lo, hi) in ranges.items()])
    head = inside.agg(*[F.percentile_approx(c, probs, 20 * buckets).alias(f"q_{i}") for c, i in names.items()]).first()
    splits = []
    for i in names.values():
        cuts = {float(v) for v in head[f"q_{i}"]}
        cuts |= {math.nextafter(v, math.inf) for v in cuts}
        splits.append([-math.inf] + sorted(v for v in cuts if math.isfinite(v)) + [math.inf])
    bz = Bucketizer(splitsArray=splits, inputCols=list(names), outputCols=[f"b_{i}" for i in names.values()], handleInvalid="keep")
    each = F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).alias("v"), F.col(f"b_{i}").alias("b")) for c, i in names.items()])
    long = bz.transform(inside).select(F.inline(each)).where(F.col("v").isNotNull())
    out: dict[str, list[tuple]] = {c: [] for c in names}
    for r in long.groupBy("f", "b").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():  # columns x ranges
        out[r["f"]].append((r["lo"], r["hi"], r["c"]))
    return {c: sorted(v) for c, v in out.items()}


def exact_medians(df: DataFrame, cols: list[str], buckets: int = 64, small: int = SMALL_RANGE) -> dict[str, float | None]:
    """Exact medians of several numeric columns by narrowing the range that holds the middle ranks.

    A round (``_narrow``) splits each column's range into about ``2 * buckets`` ranges
    and keeps the one with the middle rank, so rows fall by about that factor a
    round, whatever their number.  A range of one value, or two middle ranks in two ranges, is the answer
    itself; a range of at most ``small`` rows is grouped by value and ordered.  The driver
    sees ranges and counts only.  Null and NaN are not values; an even count takes the mean of
    the two middle values; a column without values has no median.
    """
    if not cols:
        return {}
    x = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in cols])
    head = x.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]).first()
    out: dict[str, float | None] = {c: None for c in cols}
    open_, last = {}, {}  # column -> (lo, hi, rows, first rank, second rank), ranks counted from the range's start
    for i, c in enumerate(cols):
        if n := head[f"n_{i}"]:
            open_[c] = (head[f"lo_{i}"], head[f"hi_{i}"], n, (n + 1) // 2, n // 2 + 1)
    while open_:
        for c, (lo, hi, n, _, _) in list(open_.items()):
            if lo == hi:
                out[c] = lo
                del open_[c]
            elif n <= small:
                last[c] = open_.pop(c)
        if not open_:
            break
        for c, found in _narrow(x, {c: r[:2] for c, r in open_.items()}, buckets).items():
            _, _, _, k1, k2 = open_[c]
            for at, (lo, hi, n) in enumerate(found):
                if k1 <= n:
                    break
                k1, k2 = k1 - n, k2 - n
            if k2 > n:  # the first middle rank ends this range, the second begins the next one
                out[c] = (hi + found[at + 1][0]) / 2.0
                del open_[c]
            else:
                open_[c] = (lo, hi, n, k1, k2)
    if last:
        each = F.array(*[F.struct(F.lit(c).alias("f"), F.when(F.col(c).between(r[0], r[1]), F.col(c)).alias("v")) for c, r in last.items()])
        some = x.select(F.inline(each)).where(F.col("v").isNotNull()).groupBy("f", "v").agg(F.count(F.lit(1)).alias("c"))
        upto = F.sum("c").over(Window.partitionBy("f").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        ranks = F.create_map(*[v for c, r in last.items() for v in (F.lit(c), F.array(F.lit(r[3]), F.lit(r[4])))])
        got = some.withColumn("upto", upto).withColumn("k", F.explode(ranks[F.col("f")])).where((F.col("upto") - F.col("c") < F.col("k")) & (F.col("upto") >= F.col("k")))
        vals: dict[str, list[float]] = {}
        for r in got.select("f", "v").collect():  # two rows per column
            vals.setdefault(r["f"], []).append(r["v"])
        for c, v in vals.items():
            out[c] = sum(v) / 2.0
    return out


def exact_median(df: DataFrame, col: str, buckets: int = 64, small: int = SMALL_RANGE) -> float | None:
    return exact_medians(df, [col], buckets, small)[col]


def category_counts(df: DataFrame, cols: list[str]) -> dict[str, list[tuple[str, int]]]:
    """(value, count) for several categorical columns in one job; size = vocabularies."""
    out: dict[str, list[tuple[str, int]]] = {c: [] for c in cols}
    if not cols:
        return out
    recs = F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).cast("string").alias("v")) for c in cols]))
    long = df.select(recs.alias("r")).select("r.*").where(F.col("v").isNotNull())
    for r in long.groupBy("f", "v").agg(F.count(F.lit(1)).alias("c")).collect():
        out[r["f"]].append((r["v"], r["c"]))
    return out


def fit_statistics(df: DataFrame, numeric: list[str], categorical: list[str]) -> dict:
    """median, mean and population std (after imputation); mode and vocabulary."""
    stats: dict = {"numeric": {}, "categorical": {}, "numeric_order": numeric, "categorical_order": categorical}
    medians = exact_medians(df, numeric)
    if numeric:
        aggs = []
        for c in numeric:
            med = medians[c]
            x = F.col(c).cast("double")
            imp = F.coalesce(x, F.lit(med if med is not None else 0.0))
            aggs += [F.avg(imp).alias(f"m_{c}"), F.stddev_pop(imp).alias(f"s_{c}")]
        row = df.agg(*aggs).first()
        for c in numeric:
            m, s = row[f"m_{c}"], row[f"s_{c}"]
            scale = 1.0 if s is None or s < SCALE_EPS else float(s)
            stats["numeric"][c] = {"median": medians[c], "mean": m, "std": s, "scale": scale}
    counts = category_counts(df, categorical)
    for c in categorical:
        vc = counts[c]
        mode = min(vc, key=lambda t: (-t[1], t[0]))[0] if vc else None
        stats["categorical"][c] = {"mode": mode, "vocabulary": sorted(v for v, _ in vc)}
    return stats


def fit_stats_table(spark, stats: dict) -> DataFrame:
    rows = []
    for c in stats["numeric_order"]:
        s = stats["numeric"][c]
        rows.append((c, "numeric", s["median"], s["mean"], s["std"], s["scale"], None, None))
    for c in stats["categorical_order"]:
        s = stats["categorical"][c]
        rows.append((c, "categorical", None, None, None, None, s["mode"], len(s["vocabulary"])))
    return spark.createDataFrame(
        rows,
        "feature string, kind string, median double, mean double, std double, scale double, mode string, n_categories int",
    )


def onehot_name(col: str, value: str) -> str:
    return f"{col}_{value}"


def prepared_columns(stats: dict, digits: int | None = None) -> list:
    """Column expressions: imputed+scaled numerics, then one-hot blocks."""
    out = []
    for c in stats["numeric_order"]:
        s = stats["numeric"][c]
        med = s["median"] if s["median"] is not None else 0.0
        x = (F.coalesce(F.col(c).cast("double"), F.lit(med)) - F.lit(s["mean"] or 0.0)) / F.lit(s["scale"])
        out.append((F.round(x, digits) if digits is not None else x).alias(c))
    for c in stats["categorical_order"]:
        s = stats["categorical"][c]
        filled = F.coalesce(F.col(c), F.lit(s["mode"])) if s["mode"] is not None else F.col(c)
        for v in s["vocabulary"]:
            out.append(F.when(filled == F.lit(v), 1.0).otherwise(0.0).alias(onehot_name(c, v)))
    return out


def output_names(stats: dict) -> list[str]:
    names = list(stats["numeric_order"])
    for c in stats["categorical_order"]:
        names += [onehot_name(c, v) for v in stats["categorical"][c]["vocabulary"]]
    return names


class _PrepParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric input columns", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "string input columns", TypeConverters.toListString)
    keepCols = Param(Params._dummy(), "keepCols", "columns passed through", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "assembled vector column", TypeConverters.toString)
    arrayCol = Param(Params._dummy(), "arrayCol", "optional array<double> copy", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], keepCols=[], outputCol="features", arrayCol="")


class TablePreprocessor(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator: fit imputation/scaling/one-hot statistics on a training table."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, keepCols=None, outputCol="features", arrayCol=""):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def from_table(cls, df: DataFrame, exclude=(), keep=(), **kw) -> "TablePreprocessor":
        g = feature_groups(df, exclude=set(exclude) | set(keep))
        return cls(numericCols=g.numeric, categoricalCols=g.categorical, keepCols=list(keep), **kw)

    def _fit(self, df: DataFrame) -> "TablePreprocessorModel":
        num, cat = self.getOrDefault("numericCols"), self.getOrDefault("categoricalCols")
        # several statistics jobs read the same columns: keep them for the fit only
        data = df.select(*num, *cat).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stats = fit_statistics(data, num, cat)
        finally:
            data.unpersist()
        m = TablePreprocessorModel(
            stats=json.dumps(stats),
            keepCols=self.getOrDefault("keepCols"),
            outputCol=self.getOrDefault("outputCol"),
            arrayCol=self.getOrDefault("arrayCol"),
        )
        return m


class TablePreprocessorModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    stats = Param(Params._dummy(), "stats", "fitted statistics (JSON)", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, stats=None, keepCols=None, outputCol="features", arrayCol=""):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def statistics(self) -> dict:
        return json.loads(self.getOrDefault("stats"))

    def feature_names(self) -> list[str]:
        return output_names(self.statistics)

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.statistics
        keep = [c for c in self.getOrDefault("keepCols") if c in df.columns]
        scalar = df.select(*keep, *prepared_columns(st))
        names = output_names(st)
        out = VectorAssembler(inputCols=names, outputCol=self.getOrDefault("outputCol")).transform(scalar)
        arr = self.getOrDefault("arrayCol")
        if arr:
            out = out.withColumn(arr, F.array(*[F.col(n) for n in names]))
        return out
