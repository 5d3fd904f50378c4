"""Grid kNN: no row for a pair of vectors, repeated keys, and bounded pieces in the pivot search."""

from __future__ import annotations

import random

from cohortlens.operators import balls
from cohortlens.operators import knn as KN
from tests.test_driver_traffic import plan


def brute(rows, k):
    """Each row meets all rows of other keys; the k nearest of a key, repeated rows counted."""
    out = {}
    for key, x in rows:
        out.setdefault(key, []).extend((sum((a - b) ** 2 for a, b in zip(x, y)) ** 0.5, other) for other, y in rows if other != key)
    return sorted((key, r, other, round(d, 9)) for key, found in out.items() for r, (d, other) in enumerate(sorted(found)[:k], 1))


def test_lists_of_vectors_whose_keys_repeat(spark):
    rng = random.Random(5)
    rows = [(i, [round(rng.random() * 50, 1), float(rng.randrange(4))]) for i in range(150)]
    rows += rows[::7]  # rows that come twice
    got = KN.knn(spark.createDataFrame(rows, "row_id long, x array<double>"), 4, target_per_cell=6.0, dense_cell=12)
    assert sorted((r.row_id, r.nn_rank, r.neighbour_id, round(r.distance, 9)) for r in got.collect()) == brute(rows, 4)


def test_no_join_of_points_with_their_candidates(spark, monkeypatch):
    rows = [(i, [float(i % 40), float(i // 40)]) for i in range(1200)]
    seen = []
    real = KN.cut
    monkeypatch.setattr(KN, "cut", lambda df, name: (seen.append((name, plan(df))), real(df, name))[1])
    assert KN.knn(spark.createDataFrame(rows, "row_id long, x array<double>"), 3).count() == 3600
    lists = [p for name, p in seen if name == "knn-lists"]
    assert lists and all("MapInArrow" in p and "Window" not in p for p in lists)


def test_visits_are_handed_on_in_bounded_pieces(spark, monkeypatch):
    monkeypatch.setattr(balls, "VISITS", 7)
    rng = random.Random(3)
    rows = [(i, [rng.random() for _ in range(6)]) for i in range(200)]
    got = KN.knn(spark.createDataFrame(rows, "row_id long, x array<double>"), 3)
    assert sorted((r.row_id, r.nn_rank, r.neighbour_id, round(r.distance, 9)) for r in got.collect()) == brute(rows, 3)
