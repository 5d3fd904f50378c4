"""Toxicity by compression distance: two zstandard dictionaries, one text window after another.

Fitting reads a bounded sample of labelled rows (``MAX_TOXIC`` and
``MAX_ORDINARY`` rows of smallest id hash, none above ``MAX_CHARS``
characters).  Two thirds of it train the dictionaries: the ordinary one holds the
words that most ordinary documents use; the toxic one holds the same, then the
words that toxic documents use far more often, in many different contexts (so
that copies of one document teach nothing).  The two differ in nothing else, so
a window that compresses shorter with the toxic one has toxic content, and
ordinary content cancels out.  The other third calibrates a logistic function of
a document's window gains; its output is the score.

Scoring covers every window of every whole text.  It is a map over documents:
nothing moves, and the model is a few dozen kilobytes.

Defined results: null and empty text have no window and get the score of "no
gain"; rows without a label are scored alike; ids that are null are never
learned from; several labels of one id count as toxic if one is; without toxic
or without ordinary training rows every score is the share of toxic ones; repeated
rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import forget, keyed, slices, text_rows, without

MAX_TOXIC, MAX_ORDINARY, MAX_CHARS = 2000, 6000, 20_000
WINDOW_BYTES = 56
COMMON_WORDS = 5000
LEAST_LOG_ODDS = 3.0
TOXIC_WEIGHT = 2.0
THRESHOLD = 0.7

WORDS = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def windows(text: str) -> list[bytes]:
    """Consecutive words, lower-cased, as windows of ``WINDOW_BYTES`` bytes or a little more."""
    out, at, size = [], [], 0
    for w in text.encode().lower().split():
        at.append(w)
        size += len(w) + 1
        if size >= WINDOW_BYTES:
            out.append(b" " + b" ".join(at) + b" ")
            at, size = [], 0
    if at:
        out.append(b" " + b" ".join(at) + b" ")
    return out


def compressor(content: bytes) -> Callable[[bytes], bytes]:
    params = zstd.ZstdCompressionParameters(
        strategy=zstd.STRATEGY_FAST, min_match=6, hash_log=16, chain_log=16, window_log=16,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    return zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT), compression_params=params).compress


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary."""
    contexts: dict[bytes, set] = defaultdict(set)
    of_toxic: Counter = Counter()
    of_ordinary: Counter = Counter()
    for text in toxic:
        words = WORDS.findall(text.encode().lower())
        of_toxic.update(set(words))
        for before, w, after in zip([b"", *words], words, [*words[1:], b""], strict=False):
            contexts[w].add((before, after))
    for text in ordinary:
        of_ordinary.update(set(WORDS.findall(text.encode().lower())))
    odds = lambda n, of: math.log((n + 0.5) / (of + 1))
    least = max(3, round(0.005 * len(toxic)))
    typical = sorted((len(c), w) for w, c in contexts.items() if len(c) >= least and odds(of_toxic[w], len(toxic)) - odds(of_ordinary[w], len(ordinary)) >= LEAST_LOG_ODDS)
    common = sorted(of_ordinary.items(), key=lambda x: (-x[1], x[0]))[:COMMON_WORDS]
    base = b" " + b" ".join(w for w, _ in reversed(common)) + b" "
    return base, base + b" ".join(w for _, w in typical) + b" "


def features(text: str, ordinary: Callable, toxic: Callable) -> np.ndarray:
    """What the window gains (bytes saved by the toxic dictionary) of a text amount to."""
    gains = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)], float)
    if not len(gains):
        return np.zeros(8)
    top = np.concatenate([np.sort(gains)[::-1][:8], np.zeros(8)])
    root = math.sqrt(len(gains))
    return np.array([top[0], top[1], top[2], top[4], np.maximum(gains - 2, 0).sum() / root, (gains >= 3).sum() / root, math.log1p(len(gains)), gains.mean()])


def logistic(x: np.ndarray, y: np.ndarray) -> dict:
    """Weighted ridge logistic regression by Newton steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    weight = np.where(y > 0, TOXIC_WEIGHT, 1.0)
    weight /= weight.sum()
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(len(w))
        w -= np.linalg.solve(curve, z.T @ (weight * (p - y)) + 1e-3 * w)
    return {"mean": mean, "scale": scale, "w": w}


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> dict:
    """The model, from the labelled rows that ``labels`` has (at most the stated sample)."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_label"))
    chosen = known.filter("_label = 1").orderBy(F.xxhash64("_id"), "_id").limit(MAX_TOXIC).union(known.filter("_label = 0").orderBy(F.xxhash64("_id"), "_id").limit(MAX_ORDINARY))
    # at most MAX_TOXIC + MAX_ORDINARY pairs of numbers
    body = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text")).filter(F.length("_text") <= MAX_CHARS)
    rows = body.join(F.broadcast(chosen), "_id").orderBy(F.xxhash64("_id"), "_id", "_text").limit(MAX_TOXIC + MAX_ORDINARY).select("_text", "_label").toArrow().to_pylist()
    parts: dict[tuple[int, int], list[str]] = defaultdict(list)
    count = [0, 0]
    for r in rows:
        y = r["_label"]
        parts[y, int(count[y] % 3 == 0)].append(r["_text"])
        count[y] += 1
    share = count[1] / max(1, sum(count))
    if min(len(parts[y, k]) for y in (0, 1) for k in (0, 1)) == 0:
        return {"share": share}
    base, with_toxic = dictionaries(parts[1, 0], parts[0, 0])
    c0, c1 = compressor(base), compressor(with_toxic)
    x = np.array([features(t, c0, c1) for y in (0, 1) for t in parts[y, 1]])
    y = np.array([y for y in (0, 1) for _ in parts[y, 1]], float)
    return {"share": share, "ordinary": base, "toxic": with_toxic} | logistic(x, y)


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and score (0 to 1) of each row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        ready = "w" in model
        c0, c1 = (compressor(model["ordinary"]), compressor(model["toxic"])) if ready else (None, None)
        for batch in slices(batches, 1):
            if ready:
                x = np.array([features(body, c0, c1) for _, body in text_rows(batch, 1)])
                z = np.c_[(x - model["mean"]) / model["scale"], np.ones(len(x))] @ model["w"]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            else:
                p = np.full(batch.num_rows, model["share"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], [doc_id, "score"])

    return docs.select(doc_id, F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{doc_id}` {kind}, score double")


def held_out(doc_id: str = "doc_id"):
    """Rows the model never learns from: crc32(id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    rows = keyed(docs, doc_id, text).select(F.struct("z", "d", "t").alias("key"), "text")
    judged = score(rows, fit(docs, labels.filter(~held_out(doc_id)), doc_id, text), "key", "text")
    return without(docs, judged.filter(F.col("score") >= THRESHOLD).select("key.*"), doc_id, text)
