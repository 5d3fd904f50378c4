"""Exact k nearest neighbours by pivots and balls, for vectors of many components.

1. Pivots are a hashed sample of the distinct vectors, ``6 sqrt(n)`` of each
   group, so dense regions have proportionally many; their bytes are bounded.
2. Every vector goes to its nearest pivot.  A ball has a pivot, its members and
   a radius.
3. Round one: each vector meets the members of the balls whose pivots are nearest,
   its own among them.  The distance of its k-th neighbour there, or of the k-th pivot if that is nearer, bounds the
   distance of its true k-th neighbour.
4. Round two: by the triangle inequality a member of another ball is at least
   ``d(q, pivot) - radius`` away, and at least half of ``d(q, pivot) - d(q, own
   pivot)``, since it is nearer to its own pivot.  A vector visits only the balls
   where neither exceeds its bound.  All components enter these distances, so
   the index does not weaken as components are added to a grid of a few.

Neighbouring balls form blocks of bounded size, and a vector is sent to a block once,
with the list of balls it meets there.  Members of a block come first in a partition,
then its visitors stream past them.  A block with many visitors is dealt to several
parts, each with the members, so no task depends on the size of a group.  Distances are plain sums
over the components in order, the same in any engine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.hashing import hash_unit
from cohortlens.operators.joins import broadcast_if_small

PIVOT_BYTES = 32 << 20  # of all pivots together
PIVOTS_PER_ROOT = 6.0
FIRST = 4  # balls a vector meets in round one
VISITORS = 50_000  # of one part of a ball
CELLS = 2_000_000  # distances held at once
VISITS = 8_192  # visits of one piece handed on, each with its vector
BLOCK_MEMBERS = 8_192  # of the balls in one block: a vector is sent to a block once, whatever balls it meets there
EXAMINED: list | None = None  # tests: set to a list to record the pairs a search has compared


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of ``x`` to each of ``y``; squares are added in the order of the components."""
    out = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d = x[:, j, None] - y[None, :, j]
        out += d * d
    return np.sqrt(out)


def within(x: np.ndarray, y: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance): pairs within the row's limit, among them the k nearest of each row.

    One matrix product gives all squares up to a rounding error that is bounded by ``slack``;
    ``distances`` is formed only of pairs that the error leaves in doubt.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        a, b = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
        slack = 8 * (x.shape[1] + 8) * np.finfo(float).eps * (a.max(initial=0.0) + b.max(initial=0.0))
    if np.isfinite(slack):
        squares = x @ y.T
        squares *= -2
        squares += a[:, None]
        squares += b[None, :]
        top = limit * limit * (1 + 1e-12) + slack
        near = squares <= top[:, None]
        if len(y) > k and np.count_nonzero(near) > 4 * k * len(x):
            top = np.minimum(top, np.partition(squares, k - 1, axis=1)[:, k - 1] * (1 + 1e-12) + 2 * slack)
            near = squares <= top[:, None]
        r, c = np.nonzero(near)
    else:  # components that are not finite, or whose squares are not
        r, c = (i.ravel() for i in np.indices((len(x), len(y))))
    dist = np.zeros(len(r))
    for j in range(x.shape[1]):  # as in ``distances``
        d = x[r, j] - y[c, j]
        dist += d * d
    dist = np.sqrt(dist)
    keep = dist <= limit[r]
    return r[keep], c[keep], dist[keep]


def first_balls(dist: np.ndarray) -> np.ndarray:
    """Positions of the nearest pivots of each row, the smaller position first where distances are equal."""
    if dist.shape[1] <= FIRST:
        return np.argsort(dist, axis=1, kind="stable")
    least = np.sort(np.argpartition(dist, FIRST - 1, axis=1)[:, :FIRST], axis=1)
    d = np.take_along_axis(dist, least, axis=1)
    least = np.take_along_axis(least, np.argsort(d, axis=1, kind="stable"), axis=1)
    tied = np.count_nonzero(dist <= d.max(1)[:, None], axis=1) != FIRST  # equal distances at the border, or no numbers
    if tied.any():
        least[tied] = np.argsort(dist[tied], axis=1, kind="stable")[:, :FIRST]
    return least


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _pivots(rows: DataFrame, by: list[str], d: int):
    """Per group: numbers and vectors of its pivots (one at least)."""
    n = broadcast_if_small(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_q").alias("_q0"))) if by else None
    if n is None:
        total, first = rows.agg(F.count(F.lit(1)), F.min("_q")).first()
        tagged = rows.withColumn("_n", F.lit(total)).withColumn("_q0", F.lit(first))
    else:
        tagged = rows.join(n, by)
        total = rows.count()
    most = PIVOT_BYTES // (8 * d + 64)
    rate = F.least(F.lit(PIVOTS_PER_ROOT) / F.sqrt("_n"), F.lit(most / max(total, 1)))
    found = tagged.filter((hash_unit("pivot", F.col("_q")) < rate) | (F.col("_q") == F.col("_q0")))
    groups: dict[tuple, list] = {}
    for number, r in enumerate(found.select(*by, "_x").collect()):  # bounded by PIVOT_BYTES and one for each group
        groups.setdefault(tuple(r[c] for c in by), []).append((number, r["_x"]))
    return {g: (np.array([p for p, _ in v]), np.array([x for _, x in v], float)) for g, v in groups.items()}


def _by_group(batch: pa.RecordBatch, by: list[str], pivots: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, pivot numbers, pivot vectors) of a batch, a bounded number of distances at a time."""
    keys = list(zip(*(batch.column(c).to_pylist() for c in by), strict=True)) if by else [()] * batch.num_rows
    at: dict[tuple, list[int]] = {}
    for i, key in enumerate(keys):
        at.setdefault(key, []).append(i)
    for key, rows in at.items():
        numbers, vectors = pivots[key]
        step = max(1, CELLS // len(numbers))
        for a in range(0, len(rows), step):
            yield np.array(rows[a : a + step]), numbers, vectors


def _changes(column: pa.Array) -> np.ndarray:
    """Whether a row's value differs from the row before; true for the first."""
    n = len(column)
    return np.concatenate([[True], pa.compute.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)])[:n]


def _within_balls(x: np.ndarray, vectors: np.ndarray, limit: np.ndarray, k: int, ball: np.ndarray, asked: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``within`` of each row of ``x`` and the vectors of the balls it asks for."""
    number = asked.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(x)), pa.compute.list_value_length(asked).to_numpy(zero_copy_only=False))
    turn, place = np.argsort(ball, kind="stable"), np.argsort(number, kind="stable")
    number, row, own = number[place], row[place], ball[turn]
    starts = np.flatnonzero(np.diff(number, prepend=-1))
    found = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(number)], strict=True):
        some, rows = turn[slice(*np.searchsorted(own, (number[a], number[a] + 1)))], row[a:b]
        r, c, dist = within(x[rows], vectors[some], limit[rows], k)
        found.append((rows[r], some[c], dist))
    return tuple(np.concatenate([f[j] for f in found]) for j in range(3)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _blocks(pivots: dict, count: dict[int, int]) -> dict[int, int]:
    """Block of each ball: balls whose pivots are near one another, with about ``BLOCK_MEMBERS`` members in all."""
    out: dict[int, int] = {}
    block = 0
    for numbers, vectors in pivots.values():
        size = np.array([count.get(p, 0) for p in numbers.tolist()])
        heads = vectors[: max(1, -(-int(size.sum()) // BLOCK_MEMBERS))]
        near = np.concatenate([distances(vectors[a : a + 1024], heads).argmin(1) for a in range(0, len(vectors), 1024)])
        held = 0
        for i in np.argsort(near, kind="stable").tolist():
            if held and held + size[i] > BLOCK_MEMBERS:
                block, held = block + 1, 0
            out[int(numbers[i])], held = block, held + int(size[i])
        block += 1
    return out


def compared(members: DataFrame, visitors: DataFrame, k: int, d: int) -> DataFrame:
    """(_q, distance, id): the k nearest ids for each visitor (block, q, x, bound) among the members (block, x, ids) of its block, within its bound.

    Members of a block come first in a partition, then its visitors stream past them.
    If members have a ``ball``, visitors list the ``balls`` of the block that they meet.
    """
    balls = "ball" in members.columns
    id_kind = members.schema["ids"].dataType.elementType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members of a block, then its visitors: the k nearest ids of the block for each visitor, within its bound."""
        now, held, ready = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column("block")
            part, turn = (batch.column(c).to_numpy() for c in ("part", "turn"))
            cuts = np.flatnonzero(_changes(block) | (np.diff(part, prepend=-1) != 0) | (np.diff(turn, prepend=-1) != 0))
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                some = batch.slice(a, b - a)
                if (block[a].as_py(), part[a]) != now:
                    now, held, ready = (block[a].as_py(), part[a]), [], None
                x = matrix(some.column("x"), d)
                if turn[a] == 0:
                    held.append((x, some.column("ids"), some.column("ball").to_numpy() if balls else None))
                    continue
                if ready is None:
                    ids = pa.concat_arrays([i.flatten() for _, i, _ in held])
                    owner = np.repeat(np.arange(sum(len(m) for m, _, _ in held)), np.concatenate([pa.compute.list_value_length(i).to_numpy() for _, i, _ in held]))
                    _, order = np.unique(np.array(ids.to_pylist()), return_inverse=True)
                    ready = np.concatenate([m for m, _, _ in held]), ids, owner, order, np.concatenate([m for _, _, m in held]) if balls else None
                    held = []
                vectors, ids, owner, order, ball = ready
                q, bound = some.column("q").to_numpy(), some.column("bound").to_numpy()
                step = max(1, CELLS // len(vectors))
                sizes = np.bincount(owner, minlength=len(vectors))
                first_id = np.cumsum(sizes) - sizes
                for i in range(0, len(x), step):
                    if balls:
                        r, v, dist = _within_balls(x[i : i + step], vectors, bound[i : i + step], k, ball, some.column("balls").slice(i, step))
                    else:
                        r, v, dist = within(x[i : i + step], vectors, bound[i : i + step], k)
                    n = sizes[v]  # every id of a near vector
                    c = np.repeat(first_id[v] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    r, dist = np.repeat(r, n), np.repeat(dist, n)
                    by_row = np.lexsort((order[c], dist, r))
                    r, c, dist = r[by_row], c[by_row], dist[by_row]
                    keep = np.arange(len(r)) - np.searchsorted(r, r) < k
                    r, c, dist = r[keep], c[keep], dist[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(q[i + r]), pa.array(dist), ids.take(pa.array(c))], ["_q", "distance", "id"])

    count = visitors.groupBy("block").agg(F.count(F.lit(1)).alias("n")).select("block", F.ceil(F.col("n") / VISITORS).cast("int").alias("parts"))
    # only blocks of more than one part need a row in the table that is joined
    count = broadcast_if_small(count.where("parts > 1"))
    parts = F.coalesce("parts", F.lit(1))
    home = members.join(count, "block", "left")
    asks = [F.lit(None).cast("bigint").alias("ball"), "balls"] if balls else []
    is_in = ["ball", F.lit(None).cast("array<bigint>").alias("balls")] if balls else []
    first = home.select("block", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("turn"), F.lit(0).cast("bigint").alias("q"), "x", "ids", F.lit(0.0).alias("bound"), *is_in)
    then = visitors.join(count, "block", "left").select("block", F.pmod(F.xxhash64("q"), parts).cast("int").alias("part"), F.lit(1).alias("turn"), "q", "x", F.lit(None).cast(f"array<{id_kind}>").alias("ids"), "bound", *asks)
    both = first.union(then).repartition("block", "part").sortWithinPartitions("block", "part", "turn")
    return both.mapInArrow(compare, f"_q bigint, distance double, id {id_kind}")


def expand(points: DataFrame, lists: DataFrame, by: list[str], key: str, k: int) -> DataFrame:
    """(by..., key, nn_rank, neighbour_id, distance) of every point, from the lists ``_nn`` of its vector without its own id."""
    mine = points.join(lists, [*by, "_x"]).select(*by, key, F.slice(F.filter("_nn", lambda n: n["id"] != F.col(key)), 1, k).alias("_nn"))
    out = mine.select(*by, key, F.posexplode("_nn").alias("_p", "_c"))
    return out.select(*by, key, (F.col("_p") + 1).cast("int").alias("nn_rank"), F.col("_c.id").alias("neighbour_id"), F.col("_c.distance").alias("distance"))


def nearest(uniq: DataFrame, by: list[str], k: int, d: int) -> DataFrame:
    """``uniq`` (by..., _x, _ids) with ``_nn``: the k smallest (distance, id) over all ids of the group, its own included."""
    spark = uniq.sparkSession
    rows = uniq.withColumn("_q", F.monotonically_increasing_id()).checkpoint(eager=True)  # row numbers are fixed from here on
    pivots = spark.sparkContext.broadcast(_pivots(rows, by, d))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("_x"), d)
            ball, radius, near = np.zeros(len(x), np.int64), np.zeros(len(x)), [None] * len(x)
            for at, numbers, vectors in _by_group(batch, by, pivots.value):
                dist = distances(x[at], vectors)
                own = dist.argmin(1)
                ball[at], radius[at] = numbers[own], dist[np.arange(len(at)), own]
                for i, some in zip(at.tolist(), numbers[first_balls(dist)], strict=True):
                    near[i] = some
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ball), pa.array(radius), pa.array(near, pa.list_(pa.int64()))], [*batch.schema.names, "_ball", "_r", "_near"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    members = rows.mapInArrow(assign, f"{types}, _ball bigint, _r double, _near array<bigint>").checkpoint(eager=True)
    per_ball = members.groupBy("_ball").agg(F.max("_r").alias("r"), F.count(F.lit(1)).alias("n")).collect()  # one row for each pivot
    radii = spark.sparkContext.broadcast({r["_ball"]: r["r"] for r in per_ball})
    block_of = spark.sparkContext.broadcast(_blocks(pivots.value, {r["_ball"]: r["n"] for r in per_ball}))

    def visits(rows: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
        """(rows, blocks, balls): the balls ``numbers`` that rows meet, one visit for each block of a row."""
        block = np.array([block_of.value[p] for p in numbers.tolist()], np.int64)
        order = np.lexsort((numbers, block, rows))
        rows, block, numbers = rows[order], block[order], numbers[order]
        starts = np.flatnonzero((np.diff(rows, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
        ends = np.append(starts[1:], len(rows))
        for a in range(0, len(starts), VISITS):  # a visit carries its vector: all of a chunk at once would be CELLS vectors
            some = slice(a, a + VISITS)
            offsets = np.append(starts[some], ends[some][-1])
            yield rows[starts[some]], block[starts[some]], pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(numbers[offsets[0] : offsets[-1]]))

    def called(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Round one: every vector meets the balls of its nearest pivots."""
        for batch in batches:
            if not batch.num_rows:
                continue
            near = batch.column("_near")
            rows = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(near).to_numpy(zero_copy_only=False))
            for at, block, asked in visits(rows, near.flatten().to_numpy(zero_copy_only=False)):
                yield pa.RecordBatch.from_arrays([pa.array(block), batch.column("_q").take(pa.array(at)), batch.column("_x").take(pa.array(at)), pa.array(np.full(len(at), np.inf)), asked], ["block", "q", "x", "bound", "balls"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ball = batch.column("_ball")
            yield pa.RecordBatch.from_arrays([pa.array([block_of.value[p] for p in ball.to_pylist()], pa.int64()), batch.column("_x"), batch.column("_ids"), ball], ["block", "x", "ids", "ball"])

    id_kind = members.schema["_ids"].dataType.simpleString()
    visit_type = "block bigint, q bigint, x array<double>, bound double, balls array<bigint>"
    home = members.select("_x", "_ids", "_ball").mapInArrow(placed, f"block bigint, x array<double>, ids {id_kind}, ball bigint")
    own = members.select("_q", "_x", "_near").mapInArrow(called, visit_type)

    def met(visitors: DataFrame) -> DataFrame:
        return compared(home, visitors, k, d)

    near = met(own).checkpoint(eager=True)
    bound = near.groupBy("_q").agg(F.coalesce(F.get(F.sort_array(F.collect_list("distance")), F.lit(k - 1)), F.lit(float("inf"))).alias("_bound"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, q, limit = matrix(batch.column("_x"), d), batch.column("_q").to_numpy(), batch.column("_bound").to_numpy()
            for at, numbers, vectors in _by_group(batch, by, pivots.value):
                dist = distances(x[at], vectors)
                r = np.array([radii.value.get(p, 0.0) for p in numbers.tolist()])
                most = limit[at]
                if dist.shape[1] >= k:  # pivots are points of the table
                    most = np.minimum(most, np.partition(dist, k - 1, axis=1)[:, k - 1])
                most = most[:, None]
                slack = 1e-9 * (1 + dist)
                go = (dist - r - slack <= most) & ((dist - dist.min(1)[:, None]) / 2 - slack <= most)
                np.put_along_axis(go, first_balls(dist), False, axis=1)  # met in round one
                i, p = np.nonzero(go)
                del dist, go
                for some, block, asked in visits(i, numbers[p]):
                    yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(q[at[some]]), batch.column("_x").take(pa.array(at[some])), pa.array(most[some, 0]), asked], ["block", "q", "x", "bound", "balls"])

    asked = members.drop("_ids", "_r", "_near").join(bound, "_q").mapInArrow(visit, visit_type).checkpoint(eager=True)
    if EXAMINED is not None:
        size = members.groupBy(F.col("_ball").alias("ball")).agg(F.count(F.lit(1)).alias("m"))
        EXAMINED.append(asked.unionByName(own).select(F.explode("balls").alias("ball")).join(size, "ball").agg(F.sum("m")).first()[0])
    every = near.unionByName(met(asked))
    order = Window.partitionBy("_q").orderBy("distance", "id")
    best = every.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
    lists = best.groupBy("_q").agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("_nn"))
    return rows.join(lists, "_q").drop("_q")


def knn(points: DataFrame, uniq: DataFrame, by: list[str], key: str, k: int, d: int) -> DataFrame:
    """(by..., key, nn_rank, neighbour_id, distance) of every point of ``points`` (by..., key, _x)."""
    lists = nearest(uniq, by, k + 1, d).drop("_ids").checkpoint(eager=True)
    return expand(points, lists, by, key, k)
