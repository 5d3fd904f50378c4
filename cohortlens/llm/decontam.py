"""Benchmark decontamination by winnowed fingerprints, in DataFrame operations only.

A window is ``window`` consecutive words of a benchmark item; an item of fewer
words is one window as a whole.  Words are runs of digits, letters a-z (after
lower-casing A-Z) and characters beyond ASCII.

1. Winnowing: every run of ``window - gram + 1`` word grams has one fingerprint,
   its smallest gram hash.  A shared span of ``window`` words has the same run
   of grams on both sides, so the same fingerprint: no shared window is missed.
2. The distinct fingerprints of each document meet those of the benchmark.
   Items shorter than a window are met by the hash of all their words, in every
   length that occurs (at most ``window - 1`` lengths).
3. Hits are extended: in documents with hits, the words of each window start
   whose fingerprint hit are compared with the benchmark's windows themselves.
4. Items with the same windows share one item set; the list of a document's
   items is formed once for every distinct combination of sets.

Defined results: null or empty text has no words, is never hit and as an item
has no window; null item ids are left out of the lists; rows that share id and
text are judged alike, and every input row comes back; an empty benchmark hits
nothing; columns other than the named ones are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import is_small, keyed, stored, without

#: Benchmark fingerprints are broadcast only if their table is at most this large.
BROADCAST_BYTES = 32 << 20

BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), BREAKS), lambda w: w != "")


def runs(words: Column, n: int, make) -> Column:
    """``make(start)`` for each 1-based start of ``n`` consecutive words; none if there are fewer."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), make)).otherwise(F.array())


def gram_hashes(words: Column, n: int) -> Column:
    return runs(words, n, lambda i: F.xxhash64(F.lit(n), F.slice(words, i, n)))


def winnowed(grams: Column, span: int) -> Column:
    """Fingerprint of each run of ``span`` grams."""
    return runs(grams, span, lambda i: F.array_min(F.slice(grams, i, span)))


def hit_rows(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(z, d, t, n_hit, item_sets) of the rows that hold a benchmark window, and the (item_set, list) of all windows."""
    span = window - gram + 1
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(item_text).cast("string")).alias("w")).filter(F.size("w") > 0)
    whole = items.filter(F.size("w") >= window).select("item", F.explode(runs(F.col("w"), window, lambda i: F.slice("w", i, window))).alias("w"))
    windows = stored(whole.union(items.filter(F.size("w") < window)).distinct(), "windows")
    of_window = windows.groupBy("w").agg(F.sort_array(F.collect_set("item")).alias("list"))
    of_window = stored(of_window.withColumn("item_set", F.sha2(F.to_json("list"), 256)), "window_items")
    sets = of_window.select("item_set", "list").distinct()
    known = of_window.select(F.size("w").alias("n"), F.when(F.size("w") == window, F.array_min(gram_hashes(F.col("w"), gram))).otherwise(F.xxhash64(F.size("w"), F.col("w"))).alias("f"))
    known = stored(known.distinct(), "fingerprints")
    short = sorted(r.n for r in known.filter(F.col("n") < window).select("n").distinct().collect())

    rows = keyed(docs, doc_id, text).withColumn("w", words_of(F.col("text")))
    grams = rows.withColumn("g", gram_hashes(F.col("w"), gram))
    prints = F.array_distinct(winnowed(F.col("g"), span))
    for n in short:
        prints = F.concat(prints, F.array_distinct(gram_hashes(F.col("w"), n)))
    small = is_small(known, BROADCAST_BYTES)
    f = known.select("f").distinct()
    hits = grams.select("z", "d", "t", F.explode(prints).alias("f")).join(F.broadcast(f) if small else f, "f")
    hits = stored(hits.groupBy("z", "d", "t").agg(F.collect_set("f").alias("hits")), "hits")

    met = keyed(docs, doc_id, text).join(hits, ["z", "d", "t"]).withColumn("w", words_of(F.col("text"))).withColumn("g", gram_hashes(F.col("w"), gram))
    # each start whose fingerprint hit, with the words of its window
    here = lambda n, of: F.transform(
        F.filter(F.transform(of, lambda f, i: F.struct((i + 1).alias("i"), f.alias("f"))), lambda s: F.array_contains("hits", s["f"])),
        lambda s: F.struct(s["i"].alias("i"), F.lit(n).alias("n"), F.slice("w", s["i"], n).alias("w")),
    )
    places = here(window, winnowed(F.col("g"), span))
    for n in short:
        places = F.concat(places, here(n, gram_hashes(F.col("w"), n)))
    found = met.select("z", "d", "t", F.explode(places).alias("s")).select("z", "d", "t", "s.i", "s.n", "s.w")
    found = found.join(of_window.select("w", "item_set"), "w").groupBy("z", "d", "t").agg(
        F.sort_array(F.collect_set(F.struct("i", "n"))).alias("at"), F.sort_array(F.collect_set("item_set")).alias("item_sets")
    )
    covered = F.aggregate(
        "at", F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["i"] + s["n"]).cast("long").alias("end"),
            (a["hit"] + F.greatest(F.lit(0), s["i"] + s["n"] - F.greatest(a["end"], s["i"]))).cast("long").alias("hit"),
        ),
    )["hit"]
    return stored(found.select("z", "d", "t", covered.alias("n_hit"), "item_sets"), "found"), sets


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items (sorted as strings, comma-joined)."""
    found, sets = hit_rows(docs, benchmark, window, gram, doc_id, text, item_id, item_text)
    lists = found.select("item_sets").distinct().select("item_sets", F.explode("item_sets").alias("item_set")).join(sets, "item_set")
    lists = lists.groupBy("item_sets").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("list")))).alias("items"))
    lists = lists.select("item_sets", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items"))
    found = found.join(lists, "item_sets").select("z", "d", "t", "n_hit", "n_items", "items")
    count = keyed(docs, doc_id, text).select("id", "z", "d", "t", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    return count.join(found, ["z", "d", "t"], "left").select(
        F.col("id").alias(doc_id), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.lit("")).alias("items"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id has no benchmark window in any row (nulls count as one id); see ``clean_rows``."""
    judged = contamination(docs, benchmark, doc_id=doc_id, text=text, **how)
    gone = judged.filter("n_hit > 0").select(F.col(doc_id).alias("_gone")).distinct()
    return docs.join(gone, docs[doc_id].eqNullSafe(gone["_gone"]), "left_anti")


def clean_rows(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, each judged by its own text."""
    found, _ = hit_rows(docs, benchmark, doc_id=doc_id, text=text, **how)
    return without(docs, found, doc_id, text)
