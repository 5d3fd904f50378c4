"""Exact k nearest neighbours (Euclidean) without an all-pairs join.

Vectors with more than three components that vary are searched by pivots
(``operators.balls``), others on a grid, as follows.

1. Identical vectors are collapsed: each distinct vector keeps its copy
   count and only its k+1 smallest keys (the most any query point can use
   from one vector: k neighbours plus itself).  A hot group of copies
   therefore costs k+1 candidates, not its size.
2. Distinct vectors are binned into blocks of a grid over (up to) the first three
   components that vary (a projected distance is a lower bound of the true one).
   A vector is a member of its own block and of every block from which it is at most
   ``MARGIN`` of a width away, so it moves to one or a few blocks and no pair of
   vectors is ever a row.  Each vector visits its own block, where a task compares it with the
   members; its list is final when the last distance is below the margin: any vector
   outside is at least that far away.  The lists of distinct vectors are joined back to the points.
3. Vectors without that certificate go to a coarser level: one that
   already has its candidates within distance D jumps straight to the first
   level whose margin exceeds D (its block there holds those, so the
   certificate must hold); one with fewer candidates quadruples the width.
   At the level where one block spans the whole range it holds every
   vector, so the result is exact by construction.
4. Dense regions start finer.  A cell holding more than ``dense_cell``
   distinct vectors (a cluster of near copies) is split by halving the
   width, repeatedly, and its vectors start at the coarsest level where
   their home cell is small again.  So the pairs a point examines stay
   bounded by its neighbourhood at its own scale, never by the size of a
   hot cluster; the certificate is unchanged, so results stay exact.
   By default a cell counts as dense above three times the target
   occupancy of the start width.

Ties are broken by neighbour key, so the result is deterministic and equals
the brute-force ``row_number() over (partition by p order by dist, q)``.
"""

from __future__ import annotations

import math
import time

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators import balls
from cohortlens.operators.joins import MAX_BROADCAST_BYTES, broadcast_if_small
from cohortlens.session import scratch_path, shared_dir

GRID_DIMS = 3
MARGIN = 0.25  # of the width of a block: vectors so near to it are its members too
ID_BUCKETS = 1024
DENSE_FACTOR = 3  # a cell is split above DENSE_FACTOR x the target occupancy
MAX_REFINE = 30  # halvings of the start width, so that cell numbers stay below 2^62 (where cells start does not touch results)
TRACE: list | None = None  # tests/diagnostics: set to a list to record (step, levels, resolved, pending)


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as compressed columns and read back: later plans start there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _first_ids(points: DataFrame, by: list[str], key: str, vec: str, keep: int) -> DataFrame:
    """Distinct vectors with their copy count and ``keep`` smallest keys."""
    b = F.pmod(F.xxhash64(F.col(key)), F.lit(ID_BUCKETS))
    w = Window.partitionBy(*by, vec, "_ib").orderBy(key)
    t = points.withColumn("_ib", b).withColumn("_ir", F.row_number().over(w))
    small = t.where(F.col("_ir") <= keep)
    return small.groupBy(*by, vec).agg(F.slice(F.array_sort(F.collect_list(key)), 1, keep).alias("_ids"))


def _width(w0: float, level: Column) -> Column:
    return F.lit(w0) * F.pow(F.lit(2.0), level.cast("double"))


def _cell(col: str, width: Column, lo: list[float], dims: list[int] | None = None) -> Column:
    """Cell numbers in the grid components ``dims`` (the first ones if not given)."""
    return F.array(*[F.floor((F.col(col)[j] - F.lit(x)) / width).cast("long") for j, x in zip(dims or range(len(lo)), lo)])


def _start_levels(uniq: DataFrame, by: list[str], w0: float, lo: list[float], dense_cell: int, max_refine: int, dims: list[int] | None = None):
    """(by..., _x, _lvl): the coarsest level <= 0 whose home cell holds at most
    ``dense_cell`` distinct vectors; None when no cell at level 0 is dense.

    Each round counts vectors per cell among the vectors of the dense cells
    of the round before (cells nest, since widths halve from one origin);
    the hot-cell table has at most (vectors / dense_cell) rows.
    """
    cur = uniq.select(*by, "_x")
    calm: list[DataFrame] = []
    level = 0
    while True:
        tagged = cur.withColumn("_c", _cell("_x", F.lit(w0 * 2.0**level), lo, dims))
        hot = tagged.groupBy(*by, "_c").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > dense_cell).select(*by, "_c")
        hot = cut(hot, "knn-dense")
        n_hot = hot.count()  # at most (vectors / dense_cell) rows
        if n_hot == 0 or level <= -max_refine:
            if level == 0:
                return None
            calm.append(cur.withColumn("_lvl", F.lit(level)))
            break
        if n_hot * 100 <= MAX_BROADCAST_BYTES:  # bytes of a cell row, at most
            hot = F.broadcast(hot)  # keeps the many rows of a hot cell out of one join partition
        calm.append(tagged.join(hot, [*by, "_c"], "left_anti").select(*by, "_x", F.lit(level).alias("_lvl")))
        cur = cut(tagged.join(hot, [*by, "_c"], "left_semi").select(*by, "_x"), "knn-refined")
        level -= 1
    out = calm[0]
    for c in calm[1:]:
        out = out.unionByName(c)
    return cut(out, "knn-levels")


def _mark(label):
    if TRACE is not None:
        TRACE.append((label, round(time.time(), 2)))


def knn(
    df: DataFrame,
    k: int,
    key: str = "row_id",
    vec: str = "x",
    by: list[str] | None = None,
    target_per_cell: float | None = None,
    dense_cell: int | None = None,
) -> DataFrame:
    """(by..., key, nn_rank, neighbour_id, distance) for the k nearest other points."""
    by = list(by or [])
    spark = df.sparkSession
    shared_dir(spark)
    points = pts = df.select(*by, key, F.col(vec).cast("array<double>").alias("_x")).persist(StorageLevel.MEMORY_AND_DISK)
    out_schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by), f"`{key}` {df.schema[key].dataType.simpleString()}", "nn_rank int", "neighbour_id " + df.schema[key].dataType.simpleString(), "distance double"])
    head = pts.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_x")).alias("d"), F.min(F.size("_x")).alias("d_min"), F.count_if(F.exists("_x", lambda v: v.isNull())).alias("holes")).first()
    if not head["n"] or k <= 0:
        pts.unpersist()
        return spark.createDataFrame([], out_schema)
    _mark("head")
    d = int(head["d"])
    if d != int(head["d_min"]):
        pts.unpersist()
        raise ValueError(f"Vectors of column {vec} have {head['d_min']} to {d} components; one length is needed")
    rng = pts.agg(*[F.min(F.col("_x")[j]).alias(f"lo{j}") for j in range(d)], *[F.max(F.col("_x")[j]).alias(f"hi{j}") for j in range(d)]).first()
    # the first components that vary; a constant one would only narrow the cells
    dims = [j for j in range(d) if rng[f"hi{j}"] > rng[f"lo{j}"]][:GRID_DIMS] or [0]
    g = len(dims)
    lo = [float(rng[f"lo{j}"]) for j in dims]
    _mark("rng")
    span = [(float(rng[f"hi{j}"]) - x) or 1.0 for j, x in zip(dims, lo)]
    uniq = cut(_first_ids(pts, by, key, "_x", k + 1), "knn-distinct")
    _mark("uniq")
    n_uniq = uniq.count()
    if sum(rng[f"hi{j}"] > rng[f"lo{j}"] for j in range(d)) > GRID_DIMS:
        # a grid of three components says little about more: balls around pivots bound by all of them
        out = balls.knn(pts, uniq, by, key, k, d).checkpoint(eager=True)
        pts.unpersist()
        return out
    if target_per_cell is None:
        target_per_cell = float((32, 128, 256)[g - 1])
    w0 = (math.prod(span) * target_per_cell / max(n_uniq, 1)) ** (1.0 / g)
    w0 = max(min(w0, max(span)), max(span) * 2.0**-30)
    if dense_cell is None:
        dense_cell = int(max(32, DENSE_FACTOR * target_per_cell))
    top = max(span)
    # a vector with a null component is at no distance from any other: it has a list of its own kind
    pts = pts.where(~F.exists("_x", lambda v: v.isNull()))
    # a key that comes several times fills as many places of its own list
    copies = pts.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    want = k + copies
    if copies > 1:
        uniq = _first_ids(pts, by, key, "_x", want)
    rows = cut(uniq.where(~F.exists("_x", lambda v: v.isNull())).withColumn("_q", F.monotonically_increasing_id()), "knn-vectors")  # row numbers are fixed from here on

    levels = _start_levels(rows, by, w0, lo, dense_cell, MAX_REFINE, dims)
    _mark("levels")
    pending = rows.select(*by, "_x", "_q", F.lit(0).alias("_lvl")) if levels is None else rows.select(*by, "_x", "_q").join(levels, [*by, "_x"], "inner")
    found: list[DataFrame] = []
    n_pending = n_rows = rows.count()
    step = 0
    while n_pending:
        present = sorted(r[0] for r in pending.select("_lvl").distinct().collect())  # <= MAX_REFINE + 1 values at the start
        visitors = pending.withColumn("_w", _width(w0, F.col("_lvl"))).withColumn("_cell", _cell("_x", F.col("_w"), lo, dims))
        visitors = visitors.select(_block(by).alias("block"), F.col("_q").alias("q"), F.col("_x").alias("x"), F.lit(float("inf")).alias("bound"))
        members = rows.withColumn("_lvl", F.explode(F.array(*[F.lit(v) for v in present]))).withColumn("_w", _width(w0, F.col("_lvl")))
        for i, (j, x) in enumerate(zip(dims, lo)):
            at = lambda side: F.floor((F.col("_x")[j] - F.lit(x) + F.lit(side * MARGIN) * F.col("_w")) / F.col("_w")).cast("long")  # noqa: B023, E731
            members = members.withColumn(f"_c{i}", F.explode(F.sequence(at(-1), at(1))))
        members = members.withColumn("_cell", F.array(*[F.col(f"_c{i}") for i in range(g)]))
        members = members.select(_block(by).alias("block"), F.col("_x").alias("x"), F.col("_ids").alias("ids"))
        if len(present) > 1 or n_pending < n_rows:  # blocks without visitors stay where they are
            members = members.join(broadcast_if_small(visitors.select("block").distinct()), "block", "left_semi")
        near = balls.compared(members, visitors, want, d)
        lists = near.groupBy("_q").agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("_nn"))
        per = lists.join(pending.select("_q", "_lvl"), "_q").withColumn("_cnt", F.size("_nn")).withColumn("_kth", F.col("_nn")[F.col("_cnt") - 1]["distance"])
        reach = _width(w0, F.col("_lvl")) * F.lit(MARGIN * (1 - 1e-9))  # all vectors so near are members of the block
        ok = (_width(w0, F.col("_lvl")) > F.lit(top)) | ((F.col("_cnt") == want) & (F.col("_kth") < reach))
        per = cut(per.withColumn("_ok", ok), "knn-lists")
        _mark("per")
        found.append(per.where("_ok").select("_q", "_nn"))
        n_ok = per.where("_ok").count()
        if TRACE is not None:
            TRACE.append((step, present, n_ok, n_pending - n_ok))
        if n_ok == n_pending:
            break
        # enough candidates within _kth: the first level whose margin is wider certifies them
        jump = F.floor(F.log2(F.col("_kth") / F.lit(w0 * MARGIN))).cast("int") + 1
        # fewer candidates: the block is sparse, quadruple the width
        nxt_lvl = F.when((F.col("_cnt") == want) & (F.col("_kth") > 0), F.greatest(F.col("_lvl") + 1, jump)).otherwise(F.col("_lvl") + 2)
        moves = per.where(~F.col("_ok")).select("_q", nxt_lvl.alias("_lvl"))
        pending = cut(pending.drop("_lvl").join(moves, "_q"), "knn-pending")
        n_pending -= n_ok
        step += 1
    _mark("loop")
    out = spark.createDataFrame([], out_schema)
    if found:
        lists = found[0]
        for f in found[1:]:
            lists = lists.unionByName(f)
        out = balls.expand(pts, rows.select(*by, "_x", "_q").join(lists, "_q").drop("_q"), by, key, k)
    if head["holes"]:
        out = out.unionByName(_without_distance(points, by, key, k, want, dims))
    if copies > 1:  # rows of one key share one list
        nearest = Window.partitionBy(*by, key).orderBy("distance", "neighbour_id")
        out = out.withColumn("nn_rank", F.row_number().over(nearest)).where(F.col("nn_rank") <= k)
    out = cut(out, "knn")
    points.unpersist()
    return out


def _without_distance(points: DataFrame, by: list[str], key: str, k: int, want: int, dims: list[int]) -> DataFrame:
    """Lists of vectors with null components: the smallest keys among vectors that lack the same grid components, at distance null.

    Each key takes three places for every component that is missing.
    """
    holes = F.array(*[F.col("_x")[j].isNull() for j in dims])
    rows = points.where(F.exists("_x", lambda v: v.isNull())).select(*by, key, holes.alias("_z"))
    places = F.pow(F.lit(3), F.size(F.filter("_z", lambda z: z))).cast("int")
    others = F.filter("_ids", lambda i: i != F.col(key))
    lists = rows.join(broadcast_if_small(_first_ids(rows, by, key, "_z", want)), [*by, "_z"])
    lists = lists.select(*by, key, F.posexplode(F.slice(F.flatten(F.transform(others, lambda i: F.array_repeat(i, places))), 1, k)).alias("_p", "neighbour_id"))
    return lists.select(*by, key, (F.col("_p") + 1).cast("int").alias("nn_rank"), "neighbour_id", F.lit(None).cast("double").alias("distance"))


def _block(by: list[str]) -> Column:
    """Name of the block of a row (by..., _lvl, _cell)."""
    group = [F.to_json(F.struct(*by))] if by else []
    return F.concat_ws("|", *group, F.col("_lvl").cast("string"), F.concat_ws(",", F.col("_cell").cast("array<string>")))
