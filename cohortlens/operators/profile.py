"""Redundancy profiling: derivations, zero variance, correlations, dtypes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# np.allclose defaults (fixed values)
RTOL = 1e-05
ATOL = 1e-08

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType)


@dataclass(frozen=True)
class FeatureGroups:
    numeric: list[str]
    categorical: list[str]


def feature_groups(df: DataFrame, exclude=(), strict: bool = True) -> FeatureGroups:
    """Numeric (numbers, booleans) and categorical (strings) columns.

    ``strict`` raises on any other type; the loose form treats every
    non-string column as numeric.
    """
    numeric, categorical, other = [], [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
        elif isinstance(f.dataType, NUMERIC_TYPES) or not strict:
            numeric.append(f.name)
        else:
            other.append(f.name)
    if other:
        raise ValueError(f"Neither numbers nor strings: columns {sorted(other)}")
    return FeatureGroups(numeric=numeric, categorical=categorical)


def feature_groups_table(df: DataFrame, exclude=(), strict: bool = True) -> DataFrame:
    """Feature groups with what their columns hold: (feature, feature_group, n_null, n_distinct).

    Columns are unpivoted and grouped by (feature, value), so a value that most
    rows share is combined before it moves.
    """
    g = feature_groups(df, exclude, strict)
    kind = {c: "numeric" for c in g.numeric} | {c: "categorical" for c in g.categorical}
    text = df.select([F.col(c).cast("string").alias(c) for c in kind])
    values = text.unpivot([], list(kind), "feature", "value").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    out = values.groupBy("feature").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("n_null"), F.count("value").alias("n_distinct")
    )
    group = F.when(F.col("feature").isin(g.categorical), "categorical").otherwise("numeric")
    return out.select("feature", group.alias("feature_group"), "n_null", "n_distinct")


def drop_redundant(df: DataFrame, columns) -> DataFrame:
    """Drop those of ``columns`` that exist (absent ones are ignored)."""
    return df.drop(*[c for c in columns if c in df.columns])


def features_target(df: DataFrame, target: str, key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """(key and features, key and target as int); an absent target is an error, a null one stays null."""
    if target not in df.columns:
        raise ValueError(f"There is no target column {target}")
    return df.drop(target), df.select(key, F.col(target).cast("int").alias(target))


def allclose_expr(total: Column, parts: list[Column]) -> Column:
    """bool_and over rows of |total - sum(parts)| <= atol + rtol*|sum(parts)|.

    A null or NaN anywhere makes the check false; an empty table passes.
    """
    s = parts[0]
    for p in parts[1:]:
        s = s + p
    row_ok = F.coalesce(F.abs(total - s) <= F.lit(ATOL) + F.lit(RTOL) * F.abs(s), F.lit(False))
    return F.coalesce(F.bool_and(row_ok), F.lit(True))


def all_zero_expr(c: Column) -> Column:
    return F.coalesce(F.bool_and(F.coalesce(c == 0, F.lit(False))), F.lit(True))


def pair_corr_expr(x: Column, y: Column) -> Column:
    """Pearson r over rows where both are non-null; null for zero variance.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI for a constant column, so the
    ratio is taken with ``try_divide``.
    """
    both = x.isNotNull() & y.isNotNull()
    xs = F.when(both, x.cast("double"))
    ys = F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def redundancy_checks(df: DataFrame, sums: dict, zeros=(), pairs=(), digits: int = 6) -> DataFrame:
    """One aggregate over the table; returns rows (check, passed, value)."""
    aggs, meta = [], []
    for total, parts in sums.items():
        aggs.append(allclose_expr(F.col(total), [F.col(p) for p in parts]).alias(f"_s{len(aggs)}"))
        meta.append((f"{total} = {' + '.join(parts)}", "bool"))
    for z in zeros:
        aggs.append(all_zero_expr(F.col(z)).alias(f"_s{len(aggs)}"))
        meta.append((f"{z} all zero", "bool"))
    for a, b in pairs:
        aggs.append(pair_corr_expr(F.col(a), F.col(b)).alias(f"_s{len(aggs)}"))
        meta.append((f"corr({a}, {b})", "corr"))
    row = df.agg(*aggs)
    parts = []
    for i, (name, kind) in enumerate(meta):
        c = F.col(f"_s{i}")
        if kind == "bool":
            parts.append(F.struct(F.lit(name).alias("check"), c.alias("passed"), F.lit(None).cast("double").alias("value")))
        else:
            parts.append(F.struct(F.lit(name).alias("check"), F.lit(None).cast("boolean").alias("passed"), F.round(c, digits).alias("value")))
    return row.select(F.inline(F.array(*parts)))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if f.name not in exclude and isinstance(f.dataType, NUMERIC_TYPES) and not isinstance(f.dataType, T.BooleanType)
    ]


BLOCK_COLUMNS = 512  # columns whose moments are one matrix in a task
LEAST_VARIANCE = 1e-12  # a pair's variance below this share of its mean square is rounding of a constant


def _moments(df: DataFrame, left: list[str], right: list[str], numbers: dict[str, int], centre: dict[str, float]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) over rows where both columns have a value; i < j.

    A task keeps one matrix for each moment and multiplies batches of rows into them; it
    emits a row for each pair of columns, however many rows it read.
    """
    cols = list(dict.fromkeys([*left, *right]))
    shift = [centre[c] for c in cols]
    a, b = [cols.index(c) for c in left], [cols.index(c) for c in right]
    ids = [numbers[c] for c in left], [numbers[c] for c in right]
    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - shift
            held = np.isfinite(x)
            x, m = np.where(held, x, 0.0), held.astype(float)
            xa, ma, xb, mb = x[:, a], m[:, a], x[:, b], m[:, b]
            now = [ma.T @ mb, xa.T @ mb, ma.T @ xb, (xa * xa).T @ mb, ma.T @ (xb * xb), xa.T @ xb]
            total = now if total is None else [t + s for t, s in zip(total, now, strict=True)]
        if total is not None:
            i, j = np.meshgrid(*ids, indexing="ij")
            keep = (i < j) & (total[0] > 0)
            yield pa.RecordBatch.from_arrays([pa.array(i[keep].astype(np.int32)), pa.array(j[keep].astype(np.int32)), *[pa.array(t[keep]) for t in total]], ["i", "j", *names])

    table = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    return table.mapInArrow(run, "i int, j int, " + ", ".join(f"{n} double" for n in names))


def pairwise_correlations(df: DataFrame, cols: list[str], digits: int = 6, block: int = BLOCK_COLUMNS) -> DataFrame:
    """(feature_a, feature_b, r): Pearson r of every pair of columns over the rows where both have a value.

    Moments of all pairs come from one blocked matrix product a task, summed by pair;
    more than ``block`` columns are taken in pairs of blocks, each reading its own columns
    only.  Values are centred at their column's mean first.  A pair
    without rows in common, or with a column that is constant on them, has no r (null).  Infinite
    values and NaN count as missing.
    """
    numbers = {c: i for i, c in enumerate(cols)}
    value = lambda c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double"))
    stats = df.agg(*[f(value(c)).alias(f"{n}{i}") for c, i in numbers.items() for n, f in (("m", F.avg), ("lo", F.min), ("hi", F.max))]).first()
    live = [c for c, i in numbers.items() if stats[f"lo{i}"] is not None and stats[f"lo{i}"] < stats[f"hi{i}"]]
    centre = {c: stats[f"m{numbers[c]}"] for c in live}
    blocks = [live[i : i + block] for i in range(0, len(live), block)]
    spark = df.sparkSession
    parts = [_moments(df, p, q, numbers, centre) for i, p in enumerate(blocks) for q in blocks[i:]]
    if not parts:
        return spark.createDataFrame([], "feature_a string, feature_b string, r double")
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    s = every.groupBy("i", "j").agg(*[F.sum(n).alias(n) for n in names])
    n = F.col("n")
    vx, vy = n * F.col("sxx") - F.col("sx") * F.col("sx"), n * F.col("syy") - F.col("sy") * F.col("sy")
    varies = (vx > n * F.col("sxx") * LEAST_VARIANCE) & (vy > n * F.col("syy") * LEAST_VARIANCE)
    r = F.when(varies, (n * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.sqrt(vx) * F.sqrt(vy)))
    name = F.array(*[F.lit(c) for c in cols])
    return s.select(name[F.col("i")].alias("feature_a"), name[F.col("j")].alias("feature_b"), F.round(r, digits).alias("r"))


def high_correlations(df: DataFrame, exclude=(), threshold: float = 0.85, digits: int = 6) -> DataFrame:
    """Upper-triangle |r| above the threshold, strongest first.

    Pairs with an undefined r (zero variance) are left out, as pandas'
    ``stack`` drops NaN.
    """
    cols = numeric_columns(df, exclude)
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, correlation double")
    r = pairwise_correlations(df, cols, digits)
    out = r.select("feature_a", "feature_b", F.abs("r").alias("correlation"))
    return out.where(F.col("correlation").isNotNull() & (F.col("correlation") > threshold)).orderBy(
        F.col("correlation").desc(), "feature_a", "feature_b"
    )
