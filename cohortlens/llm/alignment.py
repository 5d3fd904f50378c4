"""Cross-tokenizer alignment: which tokens of one tokenizer cover the bytes of another's.

A document is tokenised whole by both: A, a byte-level BPE, reads blank + text; B,
a SentencePiece model, adds the blank itself.  Neither joins anything across a
single blank between two characters that are no white space, so a text's ids are
those of its stretches between such blanks, which are tokenised once and
remembered.  (For vocabularies of another build the whole text is one stretch.)

Every token stands for bytes.  Documents whose joined bytes are not those of
blank + text are left without tokens; this is verified for each stretch on either
side, so the end of a stretch is a shared end, and both sides go on with a token
that a blank marks.  These anchors cut a document into windows of token ids.  A
window's alignment (groups between shared ends, links between overlapping tokens)
is a function of its two id tuples alone: it is worked out once for each pair of
tuples and remembered by them.

``link_statistics`` adds what depends on the corpus: the number of documents that
hold an id pair linked.

Defined results: null and empty texts have no tokens; repeated rows are documents
of their own; an empty table gives an empty result; other columns are not looked
at.  Texts are tokenised whole, whatever their length.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.bpe import byte_letters
from cohortlens.llm.common import forget, slices, stored, text_rows, worker_cache

SLICE = 4_000_000  # bytes of text tokenised at once
REMEMBERED, REMEMBERED_CHARS = 300_000, 10_000_000  # stretches a worker remembers from slice to slice
BROADCAST_PAIRS = 2_000_000  # rows of (pair, count, best), about 100 MB as a hash table


#: A single blank that neither tokenizer joins anything across, and where a blank is not of this kind.
BLANK = re.compile("(?<=[^\\s\u180e])\x20(?=[^\\s\u180e])")
OTHER = re.compile("\x20[\\s\u180e]|[\\s\u180e]\x20|\x20$")

LATIN = re.compile("[!-~\u00a1-\u024f]+")  # classed alike by all Unicode versions, no white space

#: Fixed pattern of this kind of byte-level vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Of a window: groups as text, links as packed integers, numbers of A tokens, B tokens and groups.
Aligned = tuple[str, bytes, int, int, int]


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the stretches and windows met so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = {letter: i for i, letter in enumerate(byte_letters())}
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(map(byte.__getitem__, token)) if all(c in byte for c in token) else token.encode()
        pieces = list(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
        self.size = self.a_size, self.b_size = tuple(np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = ([np.array([f"{i}{end}" for i in range(len(x))], object) for end in ends] for x, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")))
        before = spec["pre_tokenizer"]
        known = spec["normalizer"] is None and before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        self.parted = known and not any("\u2581" in p.lstrip("\u2581") for p in pieces)
        self.a_width, self.b_width = (np.array([len(t) for t in x[0]], np.int64) for x in (self.a_text, self.b_text))
        self.again: set[str] = set()
        # ids that follow the order of the merges are ranks, and plain Latin text is then split and merged faster
        ordered = [vocab.get("".join(m), -1) for m in spec["model"]["merges"]]
        special = {t["content"] for t in spec["added_tokens"]}
        self.fast = None
        if self.parted and ordered == sorted(set(ordered)) and ordered[0] >= 0:
            ranks = {self.a_bytes[i]: i for token, i in vocab.items() if token not in special}
            self.fast = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.windows: dict[tuple[tuple, tuple], Aligned] = {}
        self.stretches: dict[str, Aligned | None] = {}

    def parts(self, text: str) -> list[str]:
        """The stretches of a text."""
        if not self.parted:
            return [text]
        return BLANK.split(text) if OTHER.search(" " + text) else text.split(" ")

    def ids_of(self, parts: list[str]) -> tuple[list[tuple[int, ...]], list[tuple[int, ...]]]:
        """Ids of both sides for each stretch."""
        theirs = list(map(tuple, self.b.encode(parts, num_threads=1)))
        whole = lambda some: [tuple(x.ids) for x in self.a.encode_batch_fast([" " + p for p in some], add_special_tokens=False)]
        if self.fast is None:
            return whole(parts), theirs
        plain = [p.isascii() and p.isprintable() and " " not in p and p != "" or bool(LATIN.fullmatch(p)) for p in parts]
        joined = [p for p, ok in zip(parts, plain, strict=True) if ok]
        # one text of them all: blanks keep them apart
        ids = self.fast.encode_ordinary(" " + " ".join(joined)) if joined else []
        ends = np.cumsum(self.a_size[ids]) if ids else np.zeros(0, np.int64)
        cut = (np.searchsorted(ends, np.cumsum([len(p.encode()) + 1 for p in joined])) + 1).tolist()
        fast = iter([tuple(ids[i:j]) for i, j in zip([0, *cut], cut, strict=False)])
        rest = iter(whole([p for p, ok in zip(parts, plain, strict=True) if not ok]))
        return [next(fast) if ok else next(rest) for ok in plain], theirs

    def align(self, windows: list[tuple[tuple, tuple]]) -> list[Aligned]:
        """The alignment of each window (ids of A, ids of B), all in one step.

        The tokens' ends cut the bytes; each cut piece lies in one token of either
        side, and these two are linked.
        """
        n_a, n_b = (np.array([len(w[k]) for w in windows]) for k in (0, 1))
        a, b = (np.array(list(chain.from_iterable([w[k] for w in windows]))) for k in (0, 1))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.union1d(a_end, b_end)
        links = a[np.searchsorted(a_end, ends)] << 32 | b[np.searchsorted(b_end, ends)]
        shared = a_end[np.isin(a_end, b_end, assume_unique=True)]
        # tokens in the order of the groups' text: those of A, then those of B
        a_group, b_group = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        a_last, b_last = np.append(a_group[1:] != a_group[:-1], True), np.append(b_group[1:] != b_group[:-1], True)
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        text = "".join(np.concatenate([np.where(a_last, self.a_text[1][a], self.a_text[0][a]), np.where(b_last, self.b_text[1][b], self.b_text[0][b])])[order].tolist())
        last_a, last_b = np.cumsum(n_a) - 1, np.cumsum(n_b) - 1
        cut = np.concatenate([[0], a_end[last_a]])  # where windows end: in bytes, in the groups' text, in links
        at = np.concatenate([[0], np.cumsum(self.a_width[a])[last_a] + np.cumsum(self.b_width[b])[last_b]]).tolist()
        pieces = (8 * np.searchsorted(ends, cut, side="right")).tolist()
        groups = np.diff(np.searchsorted(shared, cut, side="right")).tolist()
        raw = links.tobytes()
        return [
            (text[i : j - 1], raw[k:m], x, y, g)
            for i, j, k, m, x, y, g in zip(at, at[1:], pieces, pieces[1:], n_a.tolist(), n_b.tolist(), groups, strict=False)
        ]

    def verified(self, parts: list[str], windows: list[tuple[tuple, tuple]]) -> list[bool]:
        """Of each stretch, whether the joined bytes of either side are those of blank + stretch."""
        whole = [(" " + p).encode() for p in parts]
        joined, ends = b"".join(whole), np.cumsum(list(map(len, whole)))
        for k, spelled in ((0, self.a_bytes), (1, self.b_bytes)):
            flat = list(chain.from_iterable([w[k] for w in windows]))
            if not flat or b"".join([spelled[i] for i in flat]) != joined or (np.concatenate([[0], np.cumsum(self.size[k][flat])])[np.cumsum([len(w[k]) for w in windows])] != ends).any():
                break
        else:  # all at once
            return [True] * len(parts)
        return [b"".join([self.a_bytes[i] for i in a]) == x == b"".join([self.b_bytes[i] for i in b]) for x, (a, b) in zip(whole, windows, strict=True)]

    def learn(self, parts: set[str]) -> None:
        """Tokenise, verify and align the stretches not met before."""
        new = list(parts.difference(self.stretches))
        self.again |= parts.intersection(self.stretches)
        if len(self.stretches) + len(new) > REMEMBERED or sum(map(len, new)) > REMEMBERED_CHARS:
            # those of this slice stay, and those that more than one slice had
            keep = parts | (self.again if len(self.again) < REMEMBERED // 2 else set())
            self.stretches, self.windows = {p: self.stretches[p] for p in keep if p in self.stretches}, {}
            self.again &= keep
        collecting = gc.isenabled()
        gc.disable()  # the many small objects below hold no cycles
        for begin in range(0, len(new), 20_000):
            some = new[begin : begin + 20_000]
            windows = list(zip(*self.ids_of(some), strict=True))
            good = self.verified(some, windows)
            fresh = list(dict.fromkeys([w for w, ok in zip(windows, good, strict=True) if ok and w not in self.windows]))
            found = self.align(fresh) if fresh else []
            self.windows.update(zip(fresh, found, strict=True))
            if len(found) == len(some):  # all of them new
                self.stretches.update(zip(some, found, strict=True))
            else:
                self.stretches.update((p, self.windows[w] if ok else None) for p, w, ok in zip(some, windows, good, strict=True))
        if collecting:
            gc.enable()


def aligner(a_path: str, b_path: str) -> Aligner:
    held = worker_cache("aligner")
    if (a_path, b_path) not in held:
        forget()
        held[a_path, b_path] = Aligner(a_path, b_path)
    return held[a_path, b_path]


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``), and the distinct id pairs that are
    linked (A's id in the upper 32 bits), rising, with how often each is."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for batch in slices(batches, 1, SLICE):
            parts = [both.parts(body) if body else [] for _, body in text_rows(batch, 1)]
            both.learn(set().union(*parts))
            numbers, groups, pairs, times = [], [], [], []
            for names in parts:
                windows = list(map(both.stretches.__getitem__, names))
                if None in windows:  # the bytes of some stretch differ
                    windows = []
                said, packed, n_a, n_b, n = zip(*windows, strict=True) if windows else ((),) * 5
                links = np.frombuffer(b"".join(packed), np.int64)
                pair, count = np.unique(links, return_counts=True)
                numbers.append((sum(n_a), sum(n_b), sum(n), len(links)))
                groups.append(";".join(said))
                pairs.append(pair)
                times.append(count.astype(np.int32))
            counts = [pa.array(list(x), pa.int64()) for x in zip(*numbers, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(groups, pa.string()), pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))],
                [doc_id, "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
            )

    schema = f"`{doc_id}` {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<bigint>, times array<int>"
    return docs.select(doc_id, F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def link_statistics(aligned: DataFrame) -> DataFrame:
    """``aligned`` with n_best and count_sum in place of pairs and times.

    An id pair's count is the number of documents that hold it linked.  count_sum
    adds the counts of a document's links; n_best is the number of its links whose
    count is the highest of all pairs with the same A id (ties included).
    """
    rows = stored(aligned.withColumn("_row", F.monotonically_increasing_id()), "aligned")  # the row numbers are fixed from here on
    # a document names a pair once, so rows are documents; tasks add up before anything moves
    count = stored(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("c")), "pair_counts")
    token = F.shiftright("pair", 32).alias("token")
    most = count.groupBy(token).agg(F.max("c").alias("most"))
    judged = stored(count.withColumn("token", token).join(most, "token").select("pair", "c", (F.col("c") == F.col("most")).alias("best")), "pair_bests")
    if judged.count() <= BROADCAST_PAIRS:
        judged = F.broadcast(judged)
    links = rows.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("_row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    sums = links.join(judged, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("bigint").alias("n_best"), F.sum(F.col("times") * F.col("c")).cast("bigint").alias("count_sum")
    )
    out = rows.drop("pairs", "times").join(sums, "_row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return out.select(*[c for c in rows.columns if c not in ("_row", "pairs", "times")], zero("n_best"), zero("count_sum"))
