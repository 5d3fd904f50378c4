"""BPE encoding and decoding with a public vocabulary file, over a prefix-sharing trie.

Each task takes its documents apart at white space, puts the distinct pieces it
has not met yet through normalisation and word splitting, and inserts the
distinct words into a trie: sorted, each word shares the path of its
predecessor up to their common prefix.  A depth-first walk carries, for every
prefix, the last token of its encoding.  The last token of a longer prefix is
the one vocabulary suffix whose pairing with the last token before it is itself
a valid encoding of the two, so a prefix shared by many words is encoded once,
and a word's ids are read back along these last tokens.  Which vocabulary suffixes
a prefix has is kept along the same path: the longest suffix that begins some
token leads to the next one letter by letter.

Defined results: null and empty text have no ids and decode to the empty text;
special tokens written out in a text become their own ids; repeated rows are
encoded alike; ids unknown to the vocabulary are skipped when decoding; other
columns, whatever they are called, are not looked at.  No row is dropped.
"""

from __future__ import annotations

import gc
import json
import math
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from tokenizers import Tokenizer

from cohortlens.llm.common import slices, text_rows, worker_cache

#: Pieces and words a worker remembers before it starts afresh (memory bound, no effect on results).
REMEMBERED = 250_000

#: New pieces that are split and encoded at once: what that takes is dropped before the next ones.
AT_ONCE = 20_000

#: Text whose distinct words share one trie.
TRIE_BYTES = 8_000_000

END = "</w>"

#: Steps between token beginnings that are remembered (memory bound, no effect on results).
STEPS = 200_000

#: Pairs of tokens whose border is remembered at once (memory bound, no effect on results).
PAIRS = 250_000

#: Letters below this one are classed alike by all Unicode versions.
LATIN_END = "\u0250"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordBpe:
    """One vocabulary: word splitting, the trie walk, decoding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        assert spec["model"]["end_of_word_suffix"] == END, "a vocabulary with word ends is expected"
        self.inner = {s: i for s, i in vocab.items() if not s.endswith(END)}
        self.final = {s[: -len(END)]: i for s, i in vocab.items() if s.endswith(END)}
        self.ranks = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(spec["model"]["merges"])}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"]).findall
        self.names = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for s, i in [*vocab.items(), *special.items()]:
            self.names[i] = s
        self.length = [len(s) for s in self.names]
        for s, i in self.final.items():
            self.length[i] = len(s)
        self.final_sizes = self.by_tail(self.final)
        self.begin = len(self.names)  # stands before the first token of a word
        self.library = Tokenizer.from_file(path)
        self.letters = dict(enumerate(byte_letters()))
        self.parts = {token: (a, b, rank) for (a, b), (rank, token) in self.ranks.items()}
        self.rights: dict[int, list] = {}
        self.lefts: dict[int, list] = {}
        self.pairs = [{} for _ in self.names]  # by token: whether it may follow the key
        self.more_pairs = PAIRS
        self.whole: dict[int, bool] = {}
        self.pieces: dict[bytes, bytes] = {}
        self.link_beginnings()

    @staticmethod
    def by_tail(tokens: Iterable[str]) -> dict[str, list[int]]:
        """Sizes (longest first) of the tokens that end in one or two given letters."""
        sizes: dict[str, set[int]] = {}
        for s in tokens:
            sizes.setdefault(s[-2:], set()).add(len(s))
        for s in list(sizes):
            if len(s) == 2:
                sizes[s] |= sizes.get(s[1], set())
        return {s: sorted(x, reverse=True) for s, x in sizes.items()}

    def link_beginnings(self) -> None:
        """The tree of all beginnings of inner tokens, each with its longest proper suffix in the tree.

        ``ends[node]`` has (size, token, its pairs) of the tokens that the node's
        letters end in, longest first.
        """
        self.steps: list[dict[str, int]] = [{}]
        self.shorter, self.ends, self.more_steps = [0], [()], STEPS
        steps, shorter, ends = self.steps, self.shorter, self.ends
        level = [(0, s) for s in self.inner if s]
        size = 0
        while level:  # all nodes of one depth after those of less
            size += 1
            below = []
            for up, s in level:
                c = s[size - 1]
                node = steps[up].get(c)
                if node is None:
                    node = steps[up][c] = len(steps)
                    steps.append({})
                    back = shorter[up]
                    while up and back and c not in steps[back]:
                        back = shorter[back]
                    shorter.append(steps[back].get(c, 0) if up else 0)
                    ends.append(ends[shorter[node]])
                if len(s) == size:
                    token = self.inner[s]
                    ends[node] = ((size, token, self.pairs[token]), *ends[node])
                else:
                    below.append((node, s))
            level = below

    def step(self, node: int, letter: str) -> int:
        """The longest beginning of a token that ``node`` and one more letter end in."""
        at = node
        while at and letter not in self.steps[at]:
            at = self.shorter[at]
        to = self.steps[at].get(letter, 0)
        if self.more_steps > 0:
            self.steps[node][letter] = to
            self.more_steps -= 1
        return to

    def symbols(self, token: int) -> list[int]:
        s = self.names[token]
        if self.final.get(s[: -len(END)]) == token and s.endswith(END):
            s = s[: -len(END)]
            return [self.inner[c] for c in s[:-1]] + [self.final[s[-1]]]
        return [self.inner[c] for c in s]

    def merged(self, ids: list[int]) -> list[int]:
        """Plain BPE: the merge of lowest rank first, the leftmost of equals."""
        ids = list(ids)
        while len(ids) > 1:
            best = min(((self.ranks[p][0], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.ranks), default=None)
            if best is None:
                break
            i = best[1]
            ids[i : i + 2] = [self.ranks[ids[i], ids[i + 1]][1]]
        return ids

    def alone(self, token: int) -> bool:
        ok = self.whole.get(token)
        if ok is None:
            ok = self.whole[token] = self.merged(self.symbols(token)) == [token]
        return ok

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The token, its outermost part on one side, that part's part ...: each with the rank of the merge that ends it."""
        out, ends = [], math.inf
        while True:
            out.append((token, ends))
            if token not in self.parts:
                return out
            ends, token = self.parts[token][2], self.parts[token][side]

    def together(self, a: int, b: int) -> bool:
        """Whether plain BPE keeps the border between the two tokens.

        A rule that uses a token ranks after the rule that makes it, so merges run
        in the order of rank.  A merge across the border happens if its rank comes
        before both sides' parts are used up (on equal rank the left place is first).
        """
        rights = self.rights.get(a)
        if rights is None:
            rights = self.rights[a] = self.spine(a, 1)
        lefts = self.lefts.get(b)
        if lefts is None:
            lefts = self.lefts[b] = self.spine(b, 0)
        ranks = self.ranks
        for x, x_ends in rights:
            for y, y_ends in lefts:
                rule = ranks.get((x, y))
                if rule is not None and rule[0] < x_ends and rule[0] <= y_ends:
                    return False
        return self.alone(a) and self.alone(b)

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (or begin a word); remembered."""
        ok = self.alone(token) if before == self.begin else self.together(before, token)
        if self.more_pairs == 0:
            self.more_pairs = PAIRS
            for known in self.pairs:
                known.clear()
        self.more_pairs -= 1
        self.pairs[token][before] = ok
        return ok

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each word (letters of bytes): depth-first over the trie of all of them.

        ``last[i]`` is the last token of the first ``i`` letters.  It is the suffix
        of them that fits behind the last token of what comes before it.
        """
        out: dict[str, list[int]] = {}
        last, path, before = [self.begin], [0], ""  # path: the node of each prefix
        length, none = self.length, -1
        steps, ends, step, fits, pairs = self.steps, self.ends, self.step, self.fits, self.pairs
        final, final_sizes = self.final.get, self.final_sizes.get
        for word in sorted(words):
            n = len(word)
            # the path shared with the word before (its last letter is not on it: it ends differently)
            i, most = 0, min(len(before), n) - 1
            while i < most and before[i] == word[i]:
                i += 1
            del last[i + 1 :], path[i + 1 :]
            node = path[i]
            for letter in word[i:-1]:
                i += 1
                to = steps[node].get(letter)
                node = step(node, letter) if to is None else to
                path.append(node)
                for size, t, ok in ends[node]:
                    p = last[i - size]
                    if p >= 0:
                        fit = ok.get(p)
                        if fit or (fit is None and fits(p, t)):
                            last.append(t)
                            break
                else:
                    last.append(none)
            before = word
            end, at = none, 0
            for size in final_sizes(word[-2:]) or (1,):
                at = n - size
                t = final(word[at:]) if at >= 0 else None
                if t is not None:
                    p = last[at]
                    if p >= 0:
                        fit = pairs[t].get(p)
                        if fit or (fit is None and fits(p, t)):
                            end = t
                            break
            ids = [end]
            while at > 0 and last[at] >= 0:
                ids.append(last[at])
                at -= length[last[at]]
            # a vocabulary whose merges are not of this form: merge the word itself
            out[word] = ids[::-1] if end >= 0 and at == 0 else self.merged([self.inner[c] for c in word[:-1]] + [self.final[word[-1]]])
        return out

    def split(self, piece: bytes) -> list[str | int]:
        """Words (as letters of bytes) and special ids of a piece without white space."""
        if piece.isalpha():  # letters a-z only: one word
            return [piece.lower().decode()]
        if piece[:-1].isalpha() and piece[-1:] in b".,;:!?":
            return [piece[:-1].lower().decode(), piece[-1:].decode()]
        out: list[str | int] = []
        text = piece.decode()
        for part in self.cut.split(text) if self.cut and "<" in text else (text,):
            if part in self.special:
                out.append(self.special[part])
                continue
            if part.isascii() and part.isprintable():
                out += self.words(part.lower())
            elif max(part) < LATIN_END:
                out += [w.encode().decode("latin-1").translate(self.letters) for w in self.words(unicodedata.normalize("NFC", part).lower())]
            else:  # elsewhere Unicode versions differ: the vocabulary's own rules decide
                out += [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))]
        return out

    def learn(self, pieces: set[bytes]) -> None:
        """Encode the pieces not met before, neighbours in sorted order in one trie."""
        new = pieces.difference(self.pieces)
        if len(self.pieces) + len(new) > REMEMBERED:
            # what this text uses stays: most of it is used again
            self.pieces = {p: self.pieces[p] for p in pieces - new} if len(pieces) <= REMEMBERED else {}
            new = pieces.difference(self.pieces)
        collecting = gc.isenabled()
        gc.disable()  # the many small lists below hold no cycles
        todo = sorted(new)
        for at in range(0, len(todo), AT_ONCE):
            self.learn_some(todo[at : at + AT_ONCE])
        if collecting:
            gc.enable()

    def learn_some(self, new: list[bytes]) -> None:
        parts = [self.split(p) for p in new]
        words = set().union(*parts)
        special = {w for w in words if isinstance(w, int)}
        packed = {w: array("I", ids).tobytes() for w, ids in self.encode_words(words - special).items()}
        packed |= {w: array("I", [w]).tobytes() for w in special}
        self.pieces.update((p, packed[x[0]] if len(x) == 1 else b"".join([packed[w] for w in x])) for p, x in zip(new, parts, strict=True))

    def decode(self, ids: bytes) -> str:
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist() if i < len(names) and names[i]])


def vocabulary(path: str) -> WordBpe:
    """The worker's copy of a vocabulary."""
    held = worker_cache("bpe")
    if path not in held:
        held[path] = WordBpe(path)
    return held[path]


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, n_tokens and ids (little-endian unsigned 32-bit integers, packed) of each row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in slices(batches, 1, TRIE_BYTES):
            bodies = [body.encode() for _, body in text_rows(batch, 1)]
            bpe.learn(set().union(*(body.split() for body in bodies)))
            ids = [b"".join(map(bpe.pieces.__getitem__, body.split())) for body in bodies]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], [doc_id, "n_tokens", "ids"])

    return docs.select(doc_id, F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{doc_id}` {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with the column ``decoded``: the tokens' strings, as the vocabulary's own decoder gives them."""
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in slices(batches, at):
            texts = [bpe.decode(v.as_py() or b"") for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one worker: two maps of one stage would hold the vocabulary twice in every task."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in slices(batches, 1, TRIE_BYTES // 4):
            bodies = [body.encode() for _, body in text_rows(batch, 1)]
            bpe.learn(set().union(*(body.split() for body in bodies)))
            ids = [b"".join(map(bpe.pieces.__getitem__, body.split())) for body in bodies]
            decoded = pa.array(map(bpe.decode, ids), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), decoded], [doc_id, "n_tokens", "ids", "decoded"])

    return docs.select(doc_id, F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{doc_id}` {kind}, n_tokens bigint, ids binary, decoded string")
