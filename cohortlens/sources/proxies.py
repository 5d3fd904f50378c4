"""Labelled proxy views over the driver tables (TPC-H-ish parquet).

The driver's tables are not a labelled reservation log, so the toolkit is
exercised on views derived from them.  Every view is a plain DataFrame plan
over the whole input tables; no row caps, no samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.hashing import portable_hash

# Fixed values of the proxy definition.
SEED = 42
FOCUS_COLUMN = "segment"
FOCUS_VALUE = "HOUSEHOLD"
PRICE_RULE = 350000.0  # y_pred = total_price > PRICE_RULE
NOISE_PCT = 15  # % of y_pred flipped to make y_learn
FOCUS_NOISE_PCT = 40  # % flipped inside the focus segment
EXTRA_FROM = "2001-01-01"  # focus orders from this date on form the extra rows
EXTRA_KEY_SHIFT = 1_000_000_000
COHORT_COLUMNS = ["segment", "priority", "nation", "line_flag"]
REDUNDANT_COLUMNS = ["part_total", "week", "zero"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order quantity parts and most frequent return flag, from one row per order and flag.

    The most frequent flag is the lowest of equals, nulls ignored.  Lines are
    counted and summed per order and flag first, in fixed-width buffers that
    combine map-side, so a hot order is reduced before anything moves; no order
    carries a table of its flags.  The output is partitioned by order key, so
    the join with orders shuffles only the orders side.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", F.col("l_quantity").cast("double").alias("q"))
    flags = li.groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"))
    flag, q = F.col("l_returnflag"), F.col("q")
    return flags.groupBy("l_orderkey").agg(
        F.sum(F.when(flag == "R", q).otherwise(F.lit(0.0))).alias("part_a"),
        F.sum(F.when(flag == "R", F.lit(0.0)).otherwise(q)).alias("part_b"),
        F.sum(q).alias("part_total"),
        F.min(F.when(flag.isNotNull(), F.struct((-F.col("n")).alias("n"), flag.alias("flag"))))["flag"].alias("line_flag"),
    )


def labelled_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with a target, a rule prediction and cohort columns."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = order_lines(spark, sf_dir)
    j = (
        o.join(c, o.o_custkey == c.c_custkey, "inner")
        .join(n, c.c_nationkey == n.n_nationkey, "inner")
        .join(lines, o.o_orderkey == lines.l_orderkey, "left")
    )
    y_pred = (F.col("o_totalprice") > F.lit(PRICE_RULE)).cast("int")
    noise = portable_hash(SEED, F.col("o_orderkey")) % 100
    limit = F.when(F.col("c_mktsegment") == FOCUS_VALUE, FOCUS_NOISE_PCT).otherwise(NOISE_PCT)
    y_learn = F.when(noise < limit, 1 - y_pred).otherwise(y_pred)
    return j.select(
        F.col("o_orderkey").alias("row_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y_true"),
        y_pred.alias("y_pred"),
        y_learn.cast("int").alias("y_learn"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_orderpriority").alias("priority"),
        F.col("n_name").alias("nation"),
        F.col("o_totalprice").alias("total_price"),
        F.col("c_acctbal").alias("acctbal"),
        "part_a",
        "part_b",
        "part_total",
        F.month("o_orderdate").cast("int").alias("month"),
        F.weekofyear("o_orderdate").cast("int").alias("week"),
        F.lit(0).alias("zero"),
        "line_flag",
        F.col("o_orderdate").alias("order_date"),
    )


def _is_extra() -> Column:
    return (F.col(FOCUS_COLUMN) == FOCUS_VALUE) & (F.col("order_date") >= F.lit(EXTRA_FROM).cast("timestamp_ntz"))


def labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table: all orders but those set aside as extra rows."""
    return labelled_all(spark, sf_dir).filter(~F.coalesce(_is_extra(), F.lit(False)))


def extra_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra real rows for the focus cohort: its latest orders, keys shifted.

    None of them is in the labelled table, so none can be in a train or test split.
    """
    return labelled_all(spark, sf_dir).filter(_is_extra()).withColumn("row_id", F.col("row_id") + F.lit(EXTRA_KEY_SHIFT))


def events_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a rare positive class (purchases) and two numeric features."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    return e.select(
        F.col("event_id").alias("row_id"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        F.col("event_type").alias("event_type"),
        F.col("value").cast("double").alias("x1"),
        F.hour("ts").cast("double").alias("x2"),
    )


def document_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their optional quality label (null when unlabelled)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left").withColumnRenamed("doc_id", "row_id")


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as (row_id, label, features array<double>)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("row_id"),
        "label",
        F.transform("embedding", lambda v: v.cast("double")).alias("features"),
    )
