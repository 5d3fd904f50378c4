"""Phrase collocations, mined by SON partitioning and scored with exact integers.

Words are runs without blank and tab, after A-Z became a-z, within pieces that
end at ``. , ; : ! ?`` and line breaks.  Everything is counted per language.

1. Mining.  The input's partitions are dealt to ``shards`` shards.  A phrase
   that occurs ``support`` times occurs ``support / shards`` times in one of them
   at least, so each shard is mined completely at that lowered support (rounded
   up).  A shard is as large as the input over ``shards``: the distinct phrases of
   each slice, known by a 64-bit hash, meet by range of hashes and are added up
   there.  Hashes that agree by chance only raise a count, so no phrase is lost.
2. Union.  The locally frequent hashes of all shards set bits in one bitmap
   (about ``BITS_EACH`` for each, ``MAX_LOG2_BITS`` at most).
3. Counting.  A second pass counts the phrases whose bit is set by their words,
   globally and exactly, and drops those below ``support``.  A full bitmap lets
   more phrases into this count; it never loses one.
4. Scoring.  Candidates are cut into parts whose counts are joined to them (a
   part is at least as frequent, so it is among the counted phrases).

Defined results: null text reads as empty and counts nothing; a null language is
``und``; repeated rows count as often as they occur; an empty table gives an
empty result; columns other than the named ones are not looked at.  Texts are
read whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import BASE_A, forget, mixed, slices, stored, text_rows, word_hashes

SHARDS = 4
SLICE = 8_000_000  # bytes of text whose distinct phrases are counted together
BITS_EACH = 16
MAX_LOG2_BITS = 29  # a bitmap of 64 MB
BLOCK = 16  # log2 of the bits in a row of the bitmap
CHUNK = 4_000_000  # hashes added up at once
RANK_PARTS = 64

STOP = b"."
#: A-Z become a-z, all that ends a piece becomes a full stop.
TABLE = bytes(46 if c in b".,;:!?\n\v\f\r" else c for c in range(256)).lower()


def distinct_windows(texts: list[str], longest: int) -> tuple[list[bytes], list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Words of the texts (with stops), for each length (a position, count) of every distinct window, hash of each word.

    A window is told apart by a number: that of the window without its last word,
    paired with the last word's.  So equal numbers are equal windows.
    """
    words = STOP.join([t.encode() for t in texts]).translate(TABLE).replace(STOP, b" . ").split()
    vocabulary = dict.fromkeys(words)
    for i, w in enumerate(vocabulary):
        vocabulary[w] = i
    ids = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
    hashes = word_hashes(list(vocabulary))[ids] if len(ids) else np.zeros(0, np.uint64)
    inside = ids != vocabulary.get(STOP, -1)
    run, valid, out = ids, inside, []
    for n in range(1, longest + 1):
        if n > 1:
            valid = valid[:-1] & inside[n - 1 :]
        at = np.flatnonzero(valid)
        key = run[at] if n == 1 else run[at] * len(vocabulary) + ids[at + n - 1]
        _, first, number, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        out.append((at[first], count))
        run = np.zeros(len(ids), np.int64)
        run[at] = number
    return words, out, hashes


def window_hash(hashes: np.ndarray, at: np.ndarray, n: int, lang: str) -> np.ndarray:
    h = np.full(len(at), xxhash.xxh3_64_intdigest(lang.encode(), n), np.uint64)
    for i in range(n):
        h = h * np.uint64(BASE_A) + hashes[at + i]
    return mixed(h)


def by_lang(batch: pa.RecordBatch) -> dict[str, list[str]]:
    texts: dict[str, list[str]] = {}
    langs = batch.column(0).to_pylist()
    for i, body in text_rows(batch, 1):
        texts.setdefault(langs[i], []).append(body)
    return texts


def summed(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, rising, and the sum of their counts."""
    order = np.argsort(h)
    h, c = h[order], c[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    at = np.flatnonzero(new)
    return h[at], np.add.reduceat(c, at) if len(at) else c


def frequent(rows: DataFrame, support: int, longest: int, shards: int) -> DataFrame:
    """Hashes of the phrases that are frequent in a shard, at the support lowered to its share.

    Hashes travel in blocks: one for each slice and range of hashes, with twice as
    many ranges as shuffle partitions.
    """
    partitions = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranges = 2 * partitions

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shard = TaskContext.get().partitionId() % shards
        for batch in slices(batches, 1, SLICE):
            held_h, held_c = [], []
            for lang, texts in by_lang(batch).items():
                _, levels, hashes = distinct_windows(texts, longest)
                for n, (at, count) in enumerate(levels, 1):
                    held_h.append(window_hash(hashes, at, n, lang))
                    held_c.append(count)
            h, c = summed(np.concatenate(held_h), np.concatenate(held_c))
            cut = np.searchsorted((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1))
            blocks = [(r, h[i:j].tobytes(), c[i:j].astype(np.uint32).tobytes()) for r, (i, j) in enumerate(zip(cut, cut[1:], strict=False)) if j > i]
            if blocks:
                r, x, y = zip(*blocks, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(r), pa.int32()), pa.array(r, pa.int32()), pa.array(x, pa.binary()), pa.array(y, pa.binary())], ["shard", "range", "h", "c"])

    least = -(-support // shards)

    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds up one (shard, range) after another; the input is sorted by them."""
        forget()
        key, held, n = None, [], 0

        def out() -> pa.RecordBatch:
            h, c = summed(*map(np.concatenate, zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(h[c >= least].view(np.int64))], ["h"])

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                if (row[0].as_py(), row[1].as_py()) != key:
                    if held:
                        yield out()
                    key, held, n = (row[0].as_py(), row[1].as_py()), [], 0
                held.append((np.frombuffer(row[2].as_py(), np.uint64), np.frombuffer(row[3].as_py(), np.uint32).astype(np.int64)))
                n += len(held[-1][0])
                if n > CHUNK:  # copies fall together before more is read
                    held = [summed(*map(np.concatenate, zip(*held, strict=True)))]
                    n = len(held[0][0]) // 2
        if held:
            yield out()

    blocks = rows.mapInArrow(local, "shard int, range int, h binary, c binary")
    return blocks.repartition(partitions, "shard", "range").sortWithinPartitions("shard", "range").mapInArrow(mined, "h bigint")


def bitmap(candidates: DataFrame) -> tuple[bytes, int]:
    """(bits, log2 of their number): the candidates' hashes, by their leading bits; bounded."""
    n = candidates.count()
    bits = max(16, min(MAX_LOG2_BITS, int(np.ceil(np.log2(max(2, n * BITS_EACH))))))
    width = min(BLOCK, bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, np.zeros(1 << width, bool)
        out = lambda: pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())], ["block", "bits"])
        for batch in batches:
            blocks, cells = (c.to_numpy() for c in batch.columns)
            starts = np.flatnonzero(np.diff(blocks, prepend=-1))
            for a, b in zip(starts, np.append(starts[1:], len(blocks)), strict=True):
                if blocks[a] != block:
                    if block is not None:
                        yield out()
                    block, held[:] = int(blocks[a]), False
                held[cells[a:b]] = True
        if block is not None:
            yield out()

    cell = F.shiftrightunsigned("h", 64 - bits)
    cells = candidates.select(F.shiftright(cell, width).cast("int").alias("block"), cell.bitwiseAND(F.lit((1 << width) - 1)).cast("int").alias("cell"))
    rows = cells.repartition("block").sortWithinPartitions("block").mapInArrow(fill, "block int, bits binary")
    out = bytearray((1 << bits) // 8)
    for batch in rows.toArrow().to_batches():  # 64 MB at most
        for block, data in zip(*batch.columns, strict=True):
            at = block.as_py() * len(data.as_py())
            out[at : at + len(data.as_py())] = data.as_py()
    return bytes(out), bits


def counts(docs: DataFrame, support: int = 10, longest: int = 3, shards: int = SHARDS, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, words, phrase, f): exact counts of all phrases of 1 to ``longest`` words that occur ``support`` times.

    A row with 0 words and no phrase has the number of all words of the language.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    bits, size = bitmap(stored(frequent(rows, support, longest, shards), "locally_frequent"))
    seen = docs.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held = np.frombuffer(seen.value, np.uint8)
        for batch in slices(batches, 1, SLICE):
            for tongue, texts in by_lang(batch).items():
                words, levels, hashes = distinct_windows(texts, longest)
                for n, (at, c) in enumerate(levels, 1):
                    cell = window_hash(hashes, at, n, tongue) >> np.uint64(64 - size)
                    keep = (held[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    said = [b" ".join(words[p : p + n]).decode() for p in at[keep].tolist()]
                    found, total = c[keep].tolist(), int(c.sum())
                    if n == 1:
                        said, found = [*said, None], [*found, total]
                    length = [0 if s is None else n for s in said]
                    yield pa.RecordBatch.from_arrays([pa.array([tongue] * len(said), pa.string()), pa.array(length, pa.int32()), pa.array(said, pa.string()), pa.array(found, pa.int64())], ["lang", "words", "phrase", "c"])

    every = rows.mapInArrow(count, "lang string, words int, phrase string, c bigint").groupBy("lang", "words", "phrase").agg(F.sum("c").alias("f"))
    return stored(every.filter((F.col("f") >= support) | (F.col("words") == 0)), "phrases")


def collocations(
    docs: DataFrame, top: int = 2000, support: int = 10, longest: int = 3, covered: int = 50, shards: int = SHARDS,
    lang: str = "lang", text: str = "text",
) -> DataFrame:
    """The ``top`` best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase goes if a longer candidate holds it and has ``covered`` percent of its count.
    """
    counted = counts(docs, support, longest, shards, lang, text)
    known = counted.filter("words > 0").select("lang", F.col("phrase").alias("part"), "f")
    w = F.split("phrase", " ")
    parts = [
        F.struct(F.lit(start).alias("start"), F.lit(size).alias("size"), F.array_join(F.slice(w, start + 1, size), " ").alias("part"), F.lit(n).alias("of"))
        for n in range(2, longest + 1) for size in range(1, n) for start in range(n - size + 1)
        if size > 1 or start in (0, n - size)
    ]
    cut = counted.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.filter(F.array(*parts), lambda p: p["of"] == F.col("words"))).alias("p"))
    cut = cut.select("lang", "phrase", "words", "a", "p.start", "p.size", "p.part").join(known, ["lang", "part"])
    cut = stored(cut, "phrase_parts")  # read twice

    inner = cut.filter((F.col("size") > 1) & (F.col("a") * 100 >= F.col("f") * covered)).select("lang", F.col("part").alias("phrase")).distinct()
    sides = []
    for k in range(1, longest):
        sides.append(F.max(F.when((F.col("start") == 0) & (F.col("size") == k), F.col("f"))).alias(f"l{k}"))
        sides.append(F.max(F.when((F.col("start") == k) & (F.col("size") == F.col("words") - k), F.col("f"))).alias(f"r{k}"))
    whole = cut.groupBy("lang", "phrase", "words", "a").agg(*sides)
    big = lambda c: f"cast({c} as decimal(18,0))"  # noqa: E731  products of counts need more than 64 bits
    cuts = [
        F.when(F.col("words") > k, F.struct(F.expr(f"(1000000BD * {big('a')} * {big('a')}) div ({big(f'l{k}')} * {big(f'r{k}')})").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        for k in range(1, longest)
    ]
    scored = whole.select("lang", "phrase", "a", F.array_min(F.array(*cuts)).alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    scored = scored.join(inner, ["lang", "phrase"], "left_anti")

    # each part of a language is cut to its best before the parts meet
    order = [F.desc("score"), F.desc("a"), "phrase"]
    scored = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    scored = scored.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("_r") <= top)
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    totals = counted.filter("words = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
