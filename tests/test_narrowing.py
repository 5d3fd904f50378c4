"""Order statistics by narrowing and blocked moments, against plain versions."""

import random
import statistics

import numpy as np
import pytest

from cohortlens.operators import prepare as PR
from cohortlens.operators import profile as PF


def rounds(monkeypatch):
    seen, plain = [], PR._narrow
    monkeypatch.setattr(PR, "_narrow", lambda x, ranges, buckets: seen.append(dict(ranges)) or plain(x, ranges, buckets))
    return seen


@pytest.mark.parametrize("n", [4000, 4001])
def test_median_takes_as_many_rounds_as_it_needs(spark, monkeypatch, n):
    rng = random.Random(n)
    vals = [rng.lognormvariate(0, 4) for _ in range(n)]
    seen = rounds(monkeypatch)
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(4)
    assert PR.exact_median(df, "x", buckets=4, small=20) == pytest.approx(statistics.median(vals), rel=1e-15)
    assert len(seen) >= 3


def test_medians_of_unlike_columns(spark, monkeypatch):
    inf = float("inf")
    rows = [(float(i % 3), 7.0, None, float("nan") if i % 2 else -inf, i) for i in range(300)] + [(1.0, 7.0, None, inf, 10**6)] * 300
    df = spark.createDataFrame(rows, "hot double, constant double, empty double, ends double, whole int").repartition(3)
    seen = rounds(monkeypatch)
    got = PR.exact_medians(df, df.columns, buckets=4, small=5)
    assert got == {"hot": 1.0, "constant": 7.0, "empty": None, "ends": inf, "whole": (299 + 10**6) / 2}
    assert seen


def test_median_between_two_hot_values(spark):
    df = spark.createDataFrame([(0.0,)] * 500 + [(1.0,)] * 500, "x double")
    assert PR.exact_median(df, "x", buckets=4, small=5) == 0.5
    assert PR.exact_medians(df.where("x > 1"), ["x"], small=5) == {"x": None}


@pytest.mark.parametrize("block", [512, 3])
def test_correlations_with_gaps(spark, block):
    rng = np.random.default_rng(1)
    n, p = 400, 7
    x = rng.normal(size=(n, p)) + 1e6
    x[:, 1] = 2 * x[:, 0] + rng.normal(size=n) * 0.1
    x[:, 2] = 5.0  # constant
    x[: n // 2, 3] = 9.25  # constant wherever column 4 has a value
    x[n // 2 :, 4] = np.nan
    x[rng.random((n, p)) < 0.1] = np.nan
    x[:, 6] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(p))).repartition(5)
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in PF.pairwise_correlations(df, df.columns, 6, block).collect() if r["r"] is not None}
    want = {}
    for i in range(p):
        for j in range(i + 1, p):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if both.sum() > 1 and np.ptp(x[both, i]) > 0 and np.ptp(x[both, j]) > 0:
                want[(f"c{i}", f"c{j}")] = np.corrcoef(x[both, i], x[both, j])[0, 1]
    assert got.keys() == want.keys()
    for key, r in want.items():
        assert got[key] == pytest.approx(r, abs=2e-6)


def test_a_thousand_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 1000))
    x[:, 999] = -x[:, 0]
    schema = ", ".join(f"c{i} double" for i in range(1000))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], schema).coalesce(2)
    got = PF.high_correlations(df, threshold=0.99).collect()
    assert [tuple(r) for r in got] == [("c0", "c999", 1.0)]
