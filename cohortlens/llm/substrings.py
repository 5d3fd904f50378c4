"""Substring dedup: remove words covered by a window of words that starts earlier elsewhere.

Two passes.  The first sketches the count of every window (``sketch``).  The
second fingerprints windows again and groups only those estimated repeated, by
a 96-bit fingerprint of their words; the earliest start of each is kept.  A
window estimated repeated that is not such a first start is a later copy, and
the words it covers go.

Defined results: null or empty text has no words; a text shorter than a window
keeps all its words; null ids come last in the order, rows that share an id are
ordered by a hash of their text, and repeated rows (same id, same text) are one
document, so they are judged alike and do not remove each other.  An empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import sketch
from cohortlens.llm.common import BASE_A, BASE_B, forget, keyed, mixed, rolled, slices, text_rows, word_hashes


def window_keys(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit and an independent 32-bit fingerprint of each window."""
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    h = word_hashes(words)
    return mixed(rolled(h, window, BASE_A)), (mixed(rolled(mixed(h, 5), window, BASE_B)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20, cells_per_window: float = 2.0) -> DataFrame:
    """One row per row of ``docs``: its id, n_words, n_removed and the text that is left."""
    rows = keyed(docs, doc_id, text)
    spark = docs.sparkSession
    facts = (
        rows.groupBy("z", "d").agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.max(F.octet_length("text")).alias("most"), F.sum(F.octet_length("text")).alias("size"))
        .agg(F.max("z").alias("nulls"), F.max(F.col("t0") != F.col("t1")).alias("shared"), F.min("d").alias("low"), F.max("d").alias("high"), F.max("most").alias("most"), F.sum("size").alias("size"))
        .first()
    )
    size = facts["size"] or 0
    bits = sketch.log2_cells(size // 6, cells_per_window)
    # one long holds (document, start) where ids are distinct and their range leaves room
    shift = max(1, int(facts["most"] or 1).bit_length())
    plain = isinstance(facts["low"], int) and not facts["nulls"] and not facts["shared"]
    plain = plain and (facts["high"] - facts["low"]).bit_length() + shift < 63

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, body in text_rows(batch, 0):
            a, _ = window_keys(body.encode().split(), window)
            if len(a):
                yield a

    seen = spark.sparkContext.broadcast(sketch.build(rows.select("text"), keys_of, bits, (2,))[0])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, 3):
            held = []
            for i, body in text_rows(batch, 3):
                a, b = window_keys(body.encode().split(), window)
                if len(a):
                    at = np.flatnonzero(sketch.at_least(seen.value, a, bits))
                    a, b = a[at], b[at]
                    # within one document only the first start of a window can be the first of all
                    order = np.lexsort((at, b, a))
                    new = np.ones(len(at), bool)
                    new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
                    keep = order[new]
                    held.append((a[keep], b[keep], np.full(len(keep), i), at[keep]))
            if not held:
                continue
            a, b, row, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b), *(batch.column(c).take(pa.array(row)) for c in range(3)), pa.array(pos.astype(np.int32))],
                ["a", "b", "z", "d", "t", "p"],
            )

    kind = rows.schema["d"].dataType.simpleString()
    found = rows.select("z", "d", "t", "text").mapInArrow(candidates, f"a bigint, b int, z int, d {kind}, t bigint, p int")
    if plain:
        low = facts["low"]
        place = F.shiftleft(F.col("d").cast("bigint") - F.lit(low), shift).bitwiseOR(F.col("p").cast("bigint"))
        firsts = found.groupBy("a", "b").agg(F.min(place).alias("o")).select(
            F.lit(0).alias("z"), (F.shiftright("o", shift) + F.lit(low)).cast(kind).alias("d"), F.lit(0).cast("bigint").alias("t"),
            F.col("o").bitwiseAND(F.lit((1 << shift) - 1)).cast("int").alias("p"),
        )
        rows = rows.withColumn("t", F.lit(0).cast("bigint"))
    else:
        firsts = found.groupBy("a", "b").agg(F.min(F.struct("z", "d", "t", "p")).alias("o")).select("o.*")
    starts = firsts.groupBy("z", "d", "t").agg(F.collect_list("p").alias("first_starts"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            total, gone, left = [], [], []
            for i, body in text_rows(batch, 1):
                words = body.encode().split()
                a, _ = window_keys(words, window)
                later = sketch.at_least(seen.value, a, bits) if len(a) else np.zeros(0, bool)
                first = batch.column(2)[i]
                if first.is_valid:
                    later[first.values.to_numpy(zero_copy_only=False)] = False
                step = np.zeros(len(words) + 1, np.int64)
                at = np.flatnonzero(later)
                step[at] += 1
                step[at + window] -= 1
                cut = np.cumsum(step)[:-1] > 0
                total.append(len(words))
                gone.append(int(cut.sum()))
                left.append(b" ".join(words if not gone[-1] else [w for w, c in zip(words, cut.tolist(), strict=True) if not c]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(left, pa.string())], [doc_id, "n_words", "n_removed", "text"])

    joined = rows.join(starts, ["z", "d", "t"], "left").select("id", "text", "first_starts")
    return joined.mapInArrow(remove, f"`{doc_id}` {rows.schema['id'].dataType.simpleString()}, n_words bigint, n_removed bigint, text string")
