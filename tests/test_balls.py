"""Pivot index: exact against brute force, and few pairs compared."""

import math
import random

import numpy as np
import pytest

from cohortlens.operators import balls
from cohortlens.operators import knn as KN


def distance(x, y):
    total = 0.0
    for a, b in zip(x, y):  # sum() would compensate rounding
        total += (a - b) * (a - b)
    return math.sqrt(total)


def brute(points, k):
    out = {}
    for i, x, g in points:
        best = sorted((distance(x, y), j) for j, y, h in points if j != i and h == g)[:k]
        for r, (dist, j) in enumerate(best, 1):
            out[g, i, r] = (j, dist)
    return out


def prepared_like(r, n):
    """Three scaled numbers and two one-hot blocks, with copies and ties."""
    rows = []
    for i in range(n):
        hot = [0.0] * 10
        hot[r.randrange(5)] = hot[5 + r.randrange(5)] = 1.0
        rows.append((i, [r.gauss(0, 1), r.gauss(0, 1), r.choice([0.0, 1.0, 2.5]), *hot], "a"))
    rows += [(n + i, rows[7][1], "a") for i in range(30)]
    return rows


@pytest.mark.parametrize("parts", [1, 50_000])
def test_balls_equal_brute_force(spark, parts, monkeypatch):
    monkeypatch.setattr(balls, "VISITORS", parts * 40 if parts == 1 else parts)
    r = random.Random(4)
    points = prepared_like(r, 300) + [(1000 + i, [float(r.randrange(3)) for _ in range(13)], "b") for i in range(120)] + [(2000, [0.0] * 13, "alone"), (2001, [1.0] * 13, "two"), (2002, [2.0] * 13, "two")]
    r.shuffle(points)
    df = spark.createDataFrame(points, "row_id bigint, x array<double>, g string").repartition(5)
    got = {(x.g, x.row_id, x.nn_rank): (x.neighbour_id, x.distance) for x in KN.knn(df, 4, by=["g"]).collect()}
    assert got == brute(points, 4)


def test_few_pairs_are_compared(spark, monkeypatch):
    monkeypatch.setattr(balls, "EXAMINED", [])
    r = random.Random(8)
    points = prepared_like(r, 4000)
    df = spark.createDataFrame(points, "row_id bigint, x array<double>, g string").repartition(8)
    assert KN.knn(df, 5).count() == 5 * len(points)
    n = len({tuple(x) for _, x, _ in points})
    assert balls.EXAMINED[0] < 0.2 * n * n


def test_string_keys_and_one_cluster(spark):
    """A third of all points within a tiny cluster, keys that are strings."""
    r = random.Random(3)
    points = [(f"k{i}", [r.gauss(0, 1e-6 if i % 3 == 0 else 5) for _ in range(6)], "g") for i in range(400)]
    df = spark.createDataFrame(points, "row_id string, x array<double>, g string").repartition(3)
    got = {("g", x.row_id, x.nn_rank): (x.neighbour_id, x.distance) for x in KN.knn(df, 3).collect()}
    assert got == brute(points, 3)


def test_within_keeps_what_plain_distances_give():
    """Few pairs are compared component by component; all were before."""
    r = np.random.default_rng(5)
    x, y = r.normal(size=(300, 13)) + 50, r.normal(size=(400, 13)) + 50
    y[:40] = x[:40]  # distances of 0 and equal distances
    y[40:80] = x[:40]
    plain = balls.distances(x, y)
    for limit in (np.full(300, np.inf), np.sort(plain, axis=1)[:, 7]):
        a, b, dist = balls.within(x, y, limit, 6)
        assert (dist == plain[a, b]).all() and (dist <= limit[a]).all()
        assert len(a) < plain.size / 20
        for i in range(300):
            want = np.sort(plain[i][plain[i] <= min(limit[i], np.sort(plain[i])[5])])
            assert (np.sort(dist[a == i])[: len(want)] == want).all()
    x[0, 0] = np.inf
    a, b, dist = balls.within(x, y, np.full(300, np.inf), 6)
    assert (dist[a == 0] == np.inf).sum() == 400


def test_first_balls_of_equal_distances():
    r = np.random.default_rng(6)
    for dist in (r.random((200, 50)), r.integers(0, 4, (200, 50)).astype(float), r.random((20, 3)), np.full((3, 9), np.nan)):
        assert (balls.first_balls(dist) == np.argsort(dist, axis=1, kind="stable")[:, : balls.FIRST]).all()


@pytest.mark.parametrize("size", [25, 8_192])
def test_a_vector_is_sent_to_a_block_once(spark, size, monkeypatch):
    """Points without structure meet most balls; one visit a block carries their vector."""
    sent, compared = [], balls.compared

    def spy(members, visitors, k, d):
        sent.append((visitors.count(), members.select("block").distinct().count()))
        return compared(members, visitors, k, d)

    monkeypatch.setattr(balls, "compared", spy)
    monkeypatch.setattr(balls, "BLOCK_MEMBERS", size)
    r = random.Random(2)
    points = [(i, [r.gauss(0, 1) for _ in range(8)], "ab"[i % 2]) for i in range(500)]
    df = spark.createDataFrame(points, "row_id bigint, x array<double>, g string").repartition(4)
    got = {(x.g, x.row_id, x.nn_rank): (x.neighbour_id, x.distance) for x in KN.knn(df, 4, by=["g"]).collect()}
    assert got == brute(points, 4)
    for visits, blocks in sent:
        assert visits <= 500 * blocks // 2
    if size > 500:
        assert [n for _, n in sent] == [2, 2]
