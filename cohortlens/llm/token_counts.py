"""Token counts under a unigram model, by dynamic programming over a shared trie.

A piece of the vocabulary has a score (log probability); a pre-token's
segmentation is the one of best total score, fewest tokens on ties.  The
forward score of a prefix is a property of the prefix alone, so distinct
pre-tokens go into a trie (sorted, with the path of the common prefix kept)
and each prefix is scored once; the count is stored at the terminal.

Vocabulary: a byte-level rank file; the piece of rank r has the score
-log(r + 2), so that frequent pieces are likely.  All 256 bytes are pieces,
so every text can be segmented.  Pre-tokens are runs of non-blank bytes with
the one blank before them, and runs of other white space.

Defined results: null and empty text count 0 tokens and 0 pre-tokens; repeated
rows count alike; an empty table gives an empty result; other columns are not
looked at.  Texts are counted whole.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import slices, text_rows, worker_cache

REMEMBERED = 400_000

PRE_TOKENS = re.compile(rb"\x20?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+?(?=\x20[^\x20\x09-\x0D])|[\x20\x09-\x0D]+")


class Unigram:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.score = {piece: -math.log(rank + 2) for piece, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.counts: dict[bytes, int] = {}

    def learn(self, tokens: Iterable[bytes]) -> None:
        """Terminal counts of the pre-tokens not met before, over one trie."""
        tokens = set(tokens)
        new = tokens.difference(self.counts)
        if len(self.counts) + len(new) > REMEMBERED:
            self.counts.clear()
            new = tokens
        score, longest = self.score, self.longest
        best, fewest, before = [0.0], [0], b""
        for word in sorted(new):
            common = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                common += 1
            del best[common + 1 :], fewest[common + 1 :]
            for i in range(common + 1, len(word) + 1):
                top, few = -math.inf, 0
                for j in range(max(0, i - longest), i):
                    s = score.get(word[j:i])
                    if s is not None:
                        s += best[j]
                        if s > top or s == top and fewest[j] + 1 < few:
                            top, few = s, fewest[j] + 1
                best.append(top)
                fewest.append(few)
            self.counts[word] = fewest[-1]
            before = word


def unigram(path: str) -> Unigram:
    held = worker_cache("unigram")
    if path not in held:
        held[path] = Unigram(path)
    return held[path]


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, n_pretokens and n_tokens of each row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram(path)
        for batch in slices(batches, 1):
            parts = [PRE_TOKENS.findall(body.encode()) for _, body in text_rows(batch, 1)]
            model.learn(set().union(*parts))
            totals = [sum(map(model.counts.__getitem__, x)) for x in parts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in parts], pa.int64()), pa.array(totals, pa.int64())], [doc_id, "n_pretokens", "n_tokens"])

    return docs.select(doc_id, F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{doc_id}` {kind}, n_pretokens bigint, n_tokens bigint")
