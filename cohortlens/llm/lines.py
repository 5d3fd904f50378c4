"""Line dedup: repeated runs of lines, found with a suffix array over line ids.

Lines get ids by content.  A suffix is a document's lines from one position on;
suffixes are ranked by prefix doubling: rank 0 orders single lines, and each
round ranks (rank of the first 2^k lines, rank of the next 2^k) by one sort of
the distinct pairs, spread over all tasks.  Suffixes alone in their rank are
settled and leave (they can be in no repeated run of that length).  The last
step combines two overlapping prefixes, so the depth is exactly ``min_lines``.
Suffixes that share a rank then form the longest-common-prefix intervals of
depth ``min_lines`` or more; the first of an interval, by document order and
position, is the original, and the others start a later copy.  Neighbouring
later copies join to maximal runs, whose lines are deleted.

Groups are counted before anything is joined back, so a line or run that a third
of all documents hold costs one row per task there; joins on ranks are plain
equi-joins that adaptive execution splits when they are skewed.

Defined results: null text stays null and has no run; an empty text is one empty
line; runs need ``min_lines`` lines; null ids come last in the order, rows that
share an id are ordered by a hash of their text, and rows that share both are
one document.  Other columns, whatever they are called, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import forget, keyed, stored

BLANK = r"[\x20\x09-\x0D]+"


def ranked(keys: DataFrame, columns: list[str]) -> DataFrame:
    """``keys`` with an order-preserving ``rank``: one sort over all tasks, written before use."""
    n = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return stored(keys.repartitionByRange(n, *columns).sortWithinPartitions(*columns).withColumn("rank", F.monotonically_increasing_id()), "ranks")


def repeated(at: DataFrame, columns: list[str]) -> DataFrame:
    """The keys that two or more positions share, with the first of these positions."""
    place = F.struct("z", "d", "t", "pos")
    return at.groupBy(*columns).agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last").drop("last")


def suffixes(rows: DataFrame, min_lines: int, least_words: int = 0) -> DataFrame:
    """(z, d, t, pos, rank, first) of every suffix whose first ``min_lines`` lines (of ``least_words`` words each) occur again."""
    lines = rows.select("z", "d", "t", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    if least_words:
        lines = lines.filter(F.size(F.filter(F.split("line", BLANK), lambda w: w != "")) >= least_words)
    lines = lines.select("z", "d", "t", "pos", F.unhex(F.md5("line")).alias("line"))
    ranks = ranked(repeated(lines, ["line"]), ["line"])
    at = stored(lines.join(ranks.select("line", "rank", "first"), "line").select("z", "d", "t", "pos", "rank", "first").distinct(), "suffixes")
    depth = 1
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        ahead = at.select("z", "d", "t", (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"))
        pairs = stored(at.select("z", "d", "t", "pos", "rank").join(ahead, ["z", "d", "t", "pos"]), "pairs")
        ranks = ranked(repeated(pairs, ["rank", "next"]).withColumnRenamed("rank", "was"), ["was", "next"])
        at = stored(pairs.withColumnRenamed("rank", "was").join(ranks, ["was", "next"]).select("z", "d", "t", "pos", "rank", "first"), "suffixes")
        depth += step
    return at


def later_copies(rows: DataFrame, min_lines: int, least_words: int = 0) -> DataFrame:
    """Per document, the sorted starts of later copies."""
    at = suffixes(rows, min_lines, least_words).filter(F.struct("z", "d", "t", "pos") != F.col("first"))
    return at.groupBy("z", "d", "t").agg(F.sort_array(F.collect_list("pos")).alias("starts"))


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = 2) -> DataFrame:
    """Maximal runs of later copies: id, start line, number of lines."""
    rows = keyed(docs.filter(F.col(text).isNotNull()), doc_id, text)
    spread = F.aggregate(
        "starts", F.array().cast("array<struct<start:int,lines:int>>"),
        lambda a, p: F.when(
            (F.size(a) > 0) & (F.get(a, F.size(a) - 1)["start"] + F.get(a, F.size(a) - 1)["lines"] >= p),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.get(a, F.size(a) - 1)["start"].alias("start"), (p + min_lines - F.get(a, F.size(a) - 1)["start"]).alias("lines")))),
        ).otherwise(F.concat(a, F.array(F.struct(p.alias("start"), F.lit(min_lines).alias("lines"))))),
    )
    return later_copies(rows, min_lines).select(F.when(F.col("z") == 0, F.col("d")).alias(doc_id), F.inline(spread))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = 2, least_words: int = 0) -> DataFrame:
    """``docs`` with the lines of later copies deleted from ``text``.

    With ``least_words``, only lines of so many words are compared; ``min_lines=1``
    then deletes single long lines whatever their neighbours are.
    Two columns follow: ``_n_lines`` and ``_n_deleted``, counts of the row's lines before.
    """
    rows = keyed(docs.filter(F.col(text).isNotNull()), doc_id, text)
    copies = later_copies(rows, min_lines, least_words).select(F.col("z").alias("_z"), F.col("d").alias("_d"), F.col("t").alias("_t"), F.col("starts").alias("_starts"))
    c = docs[doc_id]
    zero = F.lit(0).cast(docs.schema[doc_id].dataType)
    same = (F.when(c.isNull(), 1).otherwise(0) == copies["_z"]) & (F.coalesce(c, zero) == copies["_d"]) & (F.xxhash64(docs[text].cast("string")) == copies["_t"])
    joined = docs.join(copies, same, "left").drop("_z", "_d", "_t")
    at, starts = docs.columns.index(text), len(docs.columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", _n_lines bigint, _n_deleted bigint"

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts, total, gone = [], [], []
            for body, first in zip(batch.column(at), batch.column(starts), strict=True):
                body = body.as_py()
                parts = body.split("\n") if body is not None else []
                total.append(len(parts))
                gone.append(0)
                if first.is_valid:
                    keep = bytearray(b"\1") * len(parts)
                    for p in first.as_py():
                        keep[p : p + min_lines] = bytes(min_lines)
                    gone[-1] = len(parts) - sum(keep)
                    body = "\n".join(x for x, k in zip(parts, keep, strict=True) if k)
                texts.append(body)
            columns = list(batch.columns[:starts])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())], [*batch.schema.names[:starts], "_n_lines", "_n_deleted"])

    return joined.mapInArrow(delete, schema)
