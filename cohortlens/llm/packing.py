"""Packing token ids into rows of fixed length, best fit decreasing.

Every task packs its own documents, group by group: documents are encoded (their distinct words
by the tokenizers library, each once while it is remembered), those longer than a row are split without loss into full rows and a rest, and the
rests of a group, longest first, go each into the open row with the least room
that still holds them.  Rows are looked up by room in a segment tree over room
sizes (a node knows how many open rows lie below it), so a placement costs
log2(length).  A group ends at ``GROUP_TOKENS``, which bounds memory; nothing
moves between tasks.

A packed row has the id matrix row (padded), the cumulative segment lengths
(0, l1, l1 + l2, ...), positions that restart at 0 in every segment, and of
each segment its document and its offset there, from which all documents can be
put together again.

Defined results: null and empty text have no tokens and no segment; repeated rows
are packed as often as they occur; an empty table gives no rows; ids of any type,
nulls among them, are listed as they are; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from cohortlens.llm.common import slices, text_rows, worker_cache

GROUP_TOKENS = 4_000_000

#: Words of a generation: a worker remembers two generations at most, or the words of one slice.
REMEMBERED = 300_000

#: Words given to the library at once (its encodings are large objects).
BATCH_WORDS = 4096


#: Letters below this one are classed alike by all Unicode versions.
LATIN_END = 0x250

#: Splitting of the vocabulary that is served: fixed value, checked when the file is loaded.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Words:
    """Token ids of texts, word by word; words are remembered in two generations.

    The older generation goes when the newer is full, and a word in use moves to
    the newer one, so a burst of rare words does not take the common ones along.
    Words of plain text (ASCII and Latin letters) are cut here, by the file's own
    pattern; other texts are cut at white space only and the library does the rest.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        # ASCII words that are lower-cased and cut already need the vocabulary's merges alone
        self.merges = Tokenizer(self.library.model)
        self.merges.pre_tokenizer = WhitespaceSplit()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        latin = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA1, LATIN_END)]]
        of_kind = lambda kind: "".join(re.escape(c) for c in latin if regex.fullmatch(kind, c))
        letters, digits = of_kind(r"\p{L}"), of_kind(r"\p{N}")
        assert any(p.get("pattern") == {"Regex": SPLIT} for p in spec["pre_tokenizer"]["pretokenizers"]), "another way of splitting words"
        self.plain = re.compile("[" + re.escape("".join(latin)) + "]*").fullmatch
        # what begins with a letter cannot begin another way, so letters may be tried first
        self.words = re.compile(rf"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{digits}]|[^\s{letters}{digits}]+").findall
        vocab = spec["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values()) + len(self.special) + 1, bool)  # tokens that end a word
        self.ends[[i for s, i in vocab.items() if s.endswith(spec["model"]["end_of_word_suffix"])]] = True
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def cut(self, text: str) -> list[str]:
        """Words whose ids, one after the other, are those of the text."""
        low = text.lower()
        if self.plain(low) and not any(t in text for t in self.special):
            return self.words(low)
        return [p.decode() for p in text.encode().split()]

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """A dictionary that has all of ``words``: packed little-endian ids."""
        missing = words.difference(self.newer)
        if len(self.newer) + len(missing) > REMEMBERED:
            self.older, self.newer = self.newer, {}
            missing = words
        new = []
        for word in missing:
            ids = self.older.get(word)
            if ids is None:
                new.append(word)
            else:
                self.newer[word] = ids
        simple, single = [], []
        for w in new:
            if w.isascii() and w == w.lower() and (w.isalpha() or self.alone(w)):
                simple.append(w)
            elif self.alone(w):
                single.append(w)
        for encoder, words in ((self.merges, simple), (self.library, single)):
            for at in range(0, len(words), BATCH_WORDS):
                self.learn_singles(encoder, words[at : at + BATCH_WORDS])
        rest = [w for w in new if w not in self.newer]
        for at in range(0, len(rest), BATCH_WORDS):
            some = rest[at : at + BATCH_WORDS]
            for word, e in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.newer[word] = array("I", e.ids).tobytes()
        return self.newer

    def ids(self, bodies: list[list[str]]) -> list[np.ndarray]:
        """Ids of each list of words: every distinct word is looked up once, its tokens are copied by its number."""
        words = pa.array(list(chain.from_iterable(bodies)), pa.string()).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        known = self.learn(set(distinct))
        packed = [known[w] for w in distinct]
        tokens = np.frombuffer(b"".join(packed), "<u4")
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        number = words.indices.to_numpy()
        n = size[number]
        ends = np.cumsum(n)
        out = tokens[np.repeat((np.cumsum(size) - size)[number] - (ends - n), n) + np.arange(n.sum())]
        last = np.cumsum([len(body) for body in bodies], dtype=np.int64)
        return np.split(out, np.concatenate([[0], ends])[last[:-1]])

    def alone(self, word: str) -> bool:
        """Whether the file's pattern leaves the word whole."""
        return self.plain(word) is not None and self.words(word) == [word]

    def learn_singles(self, encoder: Tokenizer, words: list[str]) -> None:
        """Encode single words as one text; its tokens are cut after those that end a word."""
        ids = np.array(encoder.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(ends) == len(words) and ends[-1] == len(ids):
            packed, begin = ids.tobytes(), 0
            for word, end in zip(words, ends, strict=True):
                self.newer[word] = packed[4 * begin : 4 * end]
                begin = end


def words_of(path: str) -> Words:
    """The worker's copy of a vocabulary."""
    held = worker_cache("packing")
    if path not in held:
        held[path] = Words(path)
    return held[path]


class Rooms:
    """Segment tree over room sizes 0..length: open rows by the room they have left."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def put(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The smallest room of at least ``least`` and a row that has it, removed."""
        node = least + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not self.count[2 * node])
        room = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.rows[room].pop()


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of indices into ``sizes``; each row's sizes add up to ``length`` at most."""
    rows: list[list[int]] = []
    rooms = Rooms(length)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = rooms.take(sizes[i])
        if found is None:
            rows.append([])
            found = length, len(rows) - 1
        room, row = found
        rows[row].append(i)
        rooms.put(room - sizes[i], row)
    return rows


def pack(docs: DataFrame, path: str, length: int = 2048, pad: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Packed rows: ids (length integers), n_tokens, cumulative, positions, doc_ids, offsets."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def packed(ids: list[np.ndarray], owners: list, of: pa.DataType) -> Iterator[pa.RecordBatch]:
        pieces = [(i, at) for i, x in enumerate(ids) for at in range(0, len(x), length)]
        sizes = [min(length, len(ids[i]) - at) for i, at in pieces]
        full = [[k] for k, size in enumerate(sizes) if size == length]
        rest = [k for k, size in enumerate(sizes) if size < length]
        rows = full + [[rest[j] for j in row] for row in best_fit([sizes[k] for k in rest], length)]
        for begin in range(0, len(rows), 256):
            some = rows[begin : begin + 256]
            matrix = np.full((len(some), length), pad, np.int32)
            place = np.zeros((len(some), length), np.int32)
            sums, docs_of, offsets = [], [], []
            for r, row in enumerate(some):
                at = [0]
                for k in row:
                    i, o = pieces[k]
                    a, b = at[-1], at[-1] + sizes[k]
                    matrix[r, a:b] = ids[i][o : o + sizes[k]]
                    place[r, a:b] = np.arange(sizes[k])
                    at.append(b)
                sums.append(at)
                docs_of.append([owners[pieces[k][0]] for k in row])
                offsets.append([pieces[k][1] for k in row])
            lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, length, dtype=np.int32)), pa.array(m.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [lists(matrix), pa.array([x[-1] for x in sums], pa.int32()), pa.array(sums, pa.list_(pa.int32())), lists(place), pa.array(docs_of, pa.list_(of)), pa.array(offsets, pa.list_(pa.int32()))],
                ["ids", "n_tokens", "cumulative", "positions", "doc_ids", "offsets"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = words_of(path)
        ids, owners, n, of = [], [], 0, pa.null()
        for batch in slices(batches, 1):
            of = batch.schema.field(0).type
            bodies = [vocabulary.cut(body) for _, body in text_rows(batch, 1)]
            for owner, x in zip(batch.column(0), vocabulary.ids(bodies), strict=True):
                if len(x):
                    ids.append(x)
                    owners.append(owner.as_py())
                    n += len(x)
                if n >= GROUP_TOKENS:
                    yield from packed(ids, owners, of)
                    ids, owners, n = [], [], 0
        if n:
            yield from packed(ids, owners, of)

    schema = f"ids array<int>, n_tokens int, cumulative array<int>, positions array<int>, doc_ids array<{kind}>, offsets array<int>"
    return docs.select(doc_id, F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
