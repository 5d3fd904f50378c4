import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import knn as KN
from cohortlens.operators import resample as RS


def brute_knn(points, k):
    """All-pairs reference on a small fixture: {id: [(neighbour, dist)]}."""
    ids = [p[0] for p in points]
    X = np.array([p[1] for p in points])
    out = {}
    for i, pid in enumerate(ids):
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        order = sorted((float(d[j]), ids[j]) for j in range(len(ids)) if j != i)
        out[pid] = [(q, dist) for dist, q in order[:k]]
    return out


@pytest.mark.parametrize("dim", [2, 5])
def test_knn_matches_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    pts = [(i, [float(v) for v in rng.normal(size=dim) * (1 + (i % 3))]) for i in range(300)]
    pts += [(1000 + i, pts[0][1]) for i in range(8)]  # a group of exact copies
    pts += [(2000 + i, [float(v) for v in rng.integers(0, 3, size=dim)]) for i in range(40)]  # ties
    df = spark.createDataFrame(pts, "row_id long, x array<double>")
    got = {}
    for r in KN.knn(df, 5).collect():
        got.setdefault(r["row_id"], []).append((r["nn_rank"], r["neighbour_id"], r["distance"]))
    want = brute_knn(pts, 5)
    assert set(got) == set(want)
    for pid, nn in want.items():
        g = sorted(got[pid])
        assert [q for _, q, _ in g] == [q for q, _ in nn]
        assert [d for _, _, d in g] == pytest.approx([d for _, d in nn])


@pytest.mark.parametrize("dim", [2, 4])
def test_knn_dense_cluster_starts_finer(spark, dim):
    """A third of the points are near copies in a tiny region: their cells are
    split until small, and the answer still equals brute force."""
    rng = np.random.default_rng(7 + dim)
    pts = [(i, [float(v) for v in rng.uniform(-10, 10, size=dim)]) for i in range(200)]
    pts += [(5000 + i, [float(v) for v in 1.0 + rng.normal(size=dim) * 1e-6]) for i in range(100)]
    df = spark.createDataFrame(pts, "row_id long, x array<double>")
    uniq = KN._first_ids(df.withColumnRenamed("x", "_x"), [], "row_id", "_x", 6)
    assert KN._start_levels(uniq, [], 1.0, [-10.0] * min(dim, 3), 16, 40) is not None
    got = {}
    for r in KN.knn(df, 5, dense_cell=16).collect():
        got.setdefault(r["row_id"], []).append((r["nn_rank"], r["neighbour_id"], r["distance"]))
    want = brute_knn(pts, 5)
    assert set(got) == set(want)
    for pid, nn in want.items():
        g = sorted(got[pid])
        assert [q for _, q, _ in g] == [q for q, _ in nn]
        assert [d for _, _, d in g] == pytest.approx([d for _, d in nn], rel=1e-9, abs=1e-12)


def test_knn_by_group(spark):
    pts = [(i, i % 2, [float(i), 0.0]) for i in range(20)]
    df = spark.createDataFrame(pts, "row_id long, g int, x array<double>")
    r = KN.knn(df, 1, by=["g"]).collect()
    assert all((row["row_id"] - row["neighbour_id"]) % 2 == 0 for row in r)


def pts_frame(spark, rows):
    return spark.createDataFrame(rows, "row_id long, y int, x array<double>")


def test_smote_parity_and_segments(spark):
    rows = [(i, 1 if i < 12 else 0, [float(i), float(i * i % 5)]) for i in range(40)]
    out, st = RS.smote(pts_frame(spark, rows), "y", "x", 5, 42)
    assert st["synthetic_n"] == 28 - 12 and st["resampled_n"] == 56
    res = out.collect()
    assert sum(1 for r in res if r["y"] == 1) == sum(1 for r in res if r["y"] == 0) == 28
    base = {r[0]: r[2] for r in rows}
    for r in res:
        if r["is_synthetic"]:
            b, q, x = np.array(base[r["row_id"]]), np.array(base[r["neighbour_id"]]), np.array(r["x"])
            t = (x - b) @ (q - b) / max((q - b) @ (q - b), 1e-12)
            assert -1e-9 <= t < 1 + 1e-9 and np.allclose(b + t * (q - b), x)


def test_smote_no_op_cases(spark):
    one_class = [(i, 1, [float(i)]) for i in range(5)]
    out, st = RS.smote(pts_frame(spark, one_class), "y", "x")
    assert st["synthetic_n"] == 0 and out.count() == 5
    minority_1 = [(0, 1, [0.0])] + [(i, 0, [float(i)]) for i in range(1, 6)]
    out, st = RS.smote(pts_frame(spark, minority_1), "y", "x")
    assert st["synthetic_n"] == 0 and out.count() == 6


def test_smote_small_minority_uses_k_two(spark):
    rows = [(0, 1, [0.0]), (1, 1, [1.0]), (2, 1, [2.0])] + [(i, 0, [float(i)]) for i in range(3, 13)]
    out, st = RS.smote(pts_frame(spark, rows), "y", "x", k=5)
    syn = out.where("is_synthetic").collect()
    assert len(syn) == 7
    assert all(r["neighbour_id"] in {0, 1, 2} - {r["row_id"]} for r in syn)


def test_smote_cohort_leaves_rest(spark):
    rows = [(i, 1 if i % 4 == 0 else 0, [float(i)], "c" if i < 20 else "r") for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, y int, x array<double>, seg string")
    out, st = RS.smote_cohort(df, "y", F.col("seg") == "c", "x", carry=["seg"])
    assert st["cohort_original_n"] == 20 and st["cohort_synthetic_n"] == 15 - 5
    assert out.where("seg = 'r'").count() == 20


def test_grouped_smote_equals_per_group(spark):
    rows = [(i, g, 1 if i % 3 == 0 else 0, [float(i % 11), float(i % 7)]) for g in (1, 2) for i in range(g * 100, g * 100 + 30)]
    df = spark.createDataFrame(rows, "row_id long, g int, y int, x array<double>")
    grouped, _ = RS.smote_grouped(df, "y", ["g"], "x", 3, 42)
    for g in (1, 2):
        single, _ = RS.smote(df.where(F.col("g") == g).drop("g"), "y", "x", 3, 42)
        a = sorted((r["row_id"], r["syn_j"], tuple(r["x"])) for r in grouped.where(F.col("g") == g).collect())
        b = sorted((r["row_id"], r["syn_j"], tuple(r["x"])) for r in single.collect())
        assert a == b


def test_smote_estimator_augments_in_fit_only(spark):
    from cohortlens.operators.estimators import GroupRateClassifier
    from cohortlens.operators.smote_model import SmoteEstimator

    rows = [(i, 1 if i % 7 == 0 else 0, "a" if i < 30 else "b", [float(i), float(i % 4)]) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, y int, seg string, x array<double>")
    inner = GroupRateClassifier(groupCols=["seg"], labelCol="y")
    est = SmoteEstimator(inner, "y", "x", cohort_column="seg", cohort_value="a", k=3)
    model = est.fit(df)
    st = est.last_stats
    assert st["cohort_original_n"] == 30 and st["cohort_synthetic_n"] == st["cohort_original_majority_n"] - st["cohort_original_minority_n"]
    direct = inner.fit(est.resample(df)[0].drop("neighbour_id"))
    got = {r["row_id"]: r["prediction"] for r in model.transform(df).collect()}
    want = {r["row_id"]: r["prediction"] for r in direct.transform(df).collect()}
    assert got == want and len(got) == 60  # scoring keeps the input rows, no synthetic ones


@pytest.mark.parametrize("wide", [False, True])
def test_knn_constant_and_huge_components(spark, wide):
    import math
    import random

    r = random.Random(4)
    rows = [(i, [5.0, r.uniform(0, 2e18) if wide else r.uniform(0, 3), 7.0, r.uniform(0, 1)]) for i in range(60)]
    got = {(x.row_id, x.nn_rank): x.neighbour_id for x in KN.knn(spark.createDataFrame(rows, "row_id bigint, x array<double>"), 3).collect()}
    for i, a in rows:
        near = sorted((math.sqrt(sum((u - v) ** 2 for u, v in zip(a, b, strict=True))), j) for j, b in rows if j != i)[:3]
        assert [got[i, n + 1] for n in range(3)] == [j for _, j in near]


def test_knn_rejects_ragged_vectors(spark):
    with pytest.raises(ValueError, match="one length"):
        KN.knn(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "row_id bigint, x array<double>"), 1)


@pytest.mark.parametrize("bad", [None, 2])
def test_target_must_be_binary(spark, bad):
    from cohortlens.operators import split as SP
    from cohortlens.operators.validate import ValidationError

    df = spark.createDataFrame([(i, i % 2, [float(i)]) for i in range(20)] + [(99, bad, [0.0])], "row_id bigint, y int, x array<double>")
    for call in (lambda: SP.stratified_split(df, "y"), lambda: SP.add_folds(df, "y"), lambda: RS.smote(df, "y"), lambda: RS.smote_grouped(df.selectExpr("*", "1 AS g"), "y", ["g"])):
        with pytest.raises(ValidationError):
            call()
