"""Each operator against a plain version, over nulls, empties, long texts, ties, copies and clashing columns."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from cohortlens.llm import bpe, decontam, jaccard, lines, packing, secrets, sketch, substrings, token_counts, topk, toxicity
from cohortlens.llm.queries import TOKENIZERS

WORD_BPE = f"{TOKENIZERS}/word_bpe_49k.json"
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def in_order(spark, rows):
    """Distinct rows in the operators' order: null ids last, equal ids by the hash of the text."""
    data = spark.createDataFrame([(i, t) for i, t in rows], "i bigint, t string").withColumn("h", F.xxhash64(F.coalesce("t", F.lit(""))))
    found = sorted({(r.i is None, r.i or 0, r.h, r.t or "") for r in data.collect()})
    return [(None if null else i, t) for null, i, _, t in found]


def pairs(rows):
    return Counter((i, t or "") for i, t in rows)


# 1 --------------------------------------------------------------------------


def test_bpe_equals_library(docs, rows):
    library = Tokenizer.from_file(WORD_BPE)
    got = bpe.decode(bpe.encode(docs, WORD_BPE), WORD_BPE).collect()
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got) == want


def test_bpe_odd_texts():
    import random

    library, mine, r = Tokenizer.from_file(WORD_BPE), bpe.WordBpe(WORD_BPE), random.Random(2)
    letters = [chr(c) for c in (*range(9, 127), 0xA0, 0xE9, 0x301, 0x3A3, 0x130, 0x1E9B, 0x85, 0x1C, 0x2028, 0xAC00, 0x1100, 0x1161, 0x1F600, 0x558, 0x1C89)]
    letters += ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "the", "ing"]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    texts += [chr(c) + "a" + chr(c) for c in range(0, 0x3000, 7) if not 0xD800 <= c < 0xE000]
    for t in texts:
        parts = t.encode().split()
        mine.learn(set(parts))
        ids = np.frombuffer(b"".join(map(mine.pieces.__getitem__, parts)), "<u4").tolist()
        assert ids == library.encode(t, add_special_tokens=False).ids, repr(t)
        assert mine.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_bpe_trie_equals_plain_merging():
    mine = bpe.WordBpe(WORD_BPE)
    words = ["a", "an", "and", "andes", "anders", "understanding", "understandable", "zzzzzzzz", "aaaaaaaaaaa", "x" * 500]
    for w, ids in mine.encode_words(words).items():
        assert ids == mine.merged([mine.inner[c] for c in w[:-1]] + [mine.final[w[-1]]])


# 2 --------------------------------------------------------------------------


def test_secrets(spark, tmp_path):
    texts = [
        'password = "hunter22" token: token : abcdefgh', "AKIA" + "A" * 16 + " AKIAAKIA1", "f" * 24 + "é" + "0" * 30 + " " + "a" * 23,
        'é "API_KEY":"abc123=" Paſsword=abcdefg secret:short', None, "", "secret" * 3000 + "=abcdef",
    ]
    rows = [(f"p{k}", t, "x") for k, t in enumerate(texts)] + [("p0", texts[0], "y"), ("copy", texts[1], None), (None, texts[2], "z")]
    versions = spark.createDataFrame(rows, "path string, content string, blob string")
    ledger = f"file://{tmp_path}/ledger"
    for more in (0, 1):
        got = secrets.scan(versions, ledger=ledger).collect()
        assert Counter((r.path, tuple(map(tuple, r.findings))) for r in got) == Counter((p, tuple(brute.secrets(t))) for p, t, _ in rows)
        scanned = spark.read.parquet(ledger)
        assert scanned.count() == scanned.select("blob").distinct().count() == len({t or "" for _, t, _ in rows}) + 0 * more
    # only the new blob is scanned, and a new rule version scans all again
    grown = versions.union(spark.createDataFrame([("new", "token=abcdefgh", "x")], versions.schema))
    before = spark.read.parquet(ledger).count()
    assert secrets.scan(grown, ledger=ledger).count() == len(rows) + 1
    assert spark.read.parquet(ledger).count() == before + 1
    secrets.scan(grown, ledger=ledger, rules_version="base-2").count()
    assert spark.read.parquet(ledger).groupBy("rules").count().count() == 2


# 3 --------------------------------------------------------------------------


@pytest.mark.parametrize("size", [1 << 13, 1 << 26])
def test_topk(docs, rows, size, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_BYTES", size)
    asked = docs.filter("doc_id % 7 = 0")
    got = defaultdict(list)
    for r in topk.search(docs, asked, k=5).collect():
        got[r.query_id].append((r.rank, r.score, r.doc_id))
    want = brute.bm25(rows, [(i, t) for i, t in rows if i is not None and i % 7 == 0], 5)
    for q, best in want.items():
        found = sorted(got.get(q, []))
        assert [x[2] for x in found] == [i for _, i in best], q
        assert np.allclose([x[1] for x in found], [s for s, _ in best], atol=1e-7)


# 4 and 5 ---------------------------------------------------------------------


@pytest.mark.parametrize("n", [2, 3, 5])
def test_lines(spark, docs, rows, n):
    got = lines.dedup(docs, min_lines=n).collect()
    order = in_order(spark, [x for x in rows if x[1] is not None])
    gone = brute.runs_removed([t.split("\n") for _, t in order], n)
    left = {(i, t): "\n".join(x for x, g in zip(t.split("\n"), gs, strict=True) if not g) for (i, t), gs in zip(order, gone, strict=True)}
    want = Counter((i, None if t is None else left[i, t]) for i, t in rows)
    assert Counter((r.doc_id, r.text) for r in got) == want
    assert sum(r.lines for r in lines.runs(docs, min_lines=n).collect()) == sum(map(sum, gone))
    assert got[0].__fields__[: len(docs.columns)] == docs.columns


@pytest.mark.parametrize("keep", [lambda i: True, lambda i: i is not None and i not in (10, 11)])
def test_substrings(spark, docs, rows, keep):
    """With repeated, shared and null ids, and without them (the packed order)."""
    some = [x for x in rows if keep(x[0])]
    ids = [i for i in {x[0] for x in some} if i is not None]
    chosen = docs.filter(F.col("doc_id").isin(ids) | F.lit(len(some) == len(rows)))
    got = substrings.dedup(chosen, window=8).collect()
    order = in_order(spark, some)
    words = [re.findall(brute.BLANK, t) for _, t in order]
    gone = brute.runs_removed(words, 8)
    left = {k: (len(w), sum(g), " ".join(x for x, y in zip(w, g, strict=True) if not y)) for k, w, g in zip(order, words, gone, strict=True)}
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in got) == Counter((i, *left[i, t or ""]) for i, t in some)


def test_sketch_never_underestimates(spark):
    keys = np.concatenate([np.arange(5000), np.arange(0, 5000, 7), np.repeat(np.arange(0, 5000, 100), 20)]).astype(np.uint64)
    data = spark.createDataFrame([(int(k),) for k in keys], "k bigint").repartition(7)
    for bits in (8, 14, 22):
        maps = sketch.build(data, lambda b: [b.column(0).to_numpy().astype(np.uint64)], bits, (2, 16))
        count = Counter(keys.tolist())
        for t, m in zip((2, 16), maps, strict=True):
            yes = sketch.at_least(m, np.arange(5000, dtype=np.uint64), bits)
            assert all(yes[k] for k, n in count.items() if n >= t)
        if bits == 22:
            assert yes.sum() < 200


# 6 --------------------------------------------------------------------------


def test_toxicity(spark, empty):
    import random

    r = random.Random(5)
    mean = ["worthless", "moronic", "pathetic", "disgusting"]
    say = lambda bad: " ".join("".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 6))) if not bad or r.random() > 0.06 else r.choice(mean) for _ in range(200))
    data = [(i, say(i % 5 == 0)) for i in range(600)] + [(None, say(True)), (601, None), (602, ""), (0, None)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(600)] + [(3, 1, None), (None, 1, 1), (5, 0, 0)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out()))
    got = toxicity.score(docs, model).withColumn("h", toxicity.held_out()).collect()
    assert len(got) == len(data)
    assert all(0 <= x.score <= 1 for x in got)
    held = [(x.score >= toxicity.THRESHOLD, x.doc_id % 5 == 0) for x in got if x.h and x.doc_id is not None and x.doc_id < 600]
    assert sum(p and y for p, y in held) >= 0.9 * sum(y for _, y in held)
    assert sum(p and not y for p, y in held) <= 0.02 * len(held)
    assert [x.score >= 0.7 for x in got if x.doc_id is None] == [True]
    assert all(x.score < 0.7 for x in got if x.doc_id in (601, 602))
    kept = {x.doc_id for x in toxicity.drop_toxic(docs, labels).collect()}
    assert {601, 602} <= kept and len([i for i in kept if i and i % 5 == 0]) < 15
    # no labels, no rows
    none = toxicity.fit(docs, labels.filter("false"))
    assert {x.score for x in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(empty, model).count() == 0


# 7 --------------------------------------------------------------------------


@pytest.mark.parametrize("small", [True, False])
def test_decontamination(spark, docs, rows, small, monkeypatch):
    if not small:
        monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    texts = [t for _, t in rows if t and len(t.split()) > 30]
    items = [(k, t[: 60 + 7 * k], "x") for k, t in enumerate(texts[:8])] + [(50, texts[0].upper()[:200], "x"), (51, None, "x"), (52, "", "x"), (53, "One", "x"), (54, "ab c d", None), (None, texts[1][:90], "x"), (3, texts[3], "x")]
    bench = spark.createDataFrame(items, "item_id bigint, text string, w string")
    got = decontam.contamination(docs, bench).collect()
    want = brute.contaminated([t for _, t in rows], [x[:2] for x in items], 10)
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"]) for r in got) == Counter((i, *w) for (i, _), w in zip(rows, want, strict=True))
    clean = Counter((r.doc_id, r.text) for r in decontam.clean(docs, bench).collect())
    bad = {i for (i, _), w in zip(rows, want, strict=True) if w[1]}
    assert clean == Counter((i, t) for i, t in rows if i not in bad)


def test_decontamination_without_items(docs, rows, empty):
    got = decontam.contamination(docs, empty, item_id="doc_id").collect()
    assert len(got) == len(rows) and not any(r.n_hit for r in got)


# 8 --------------------------------------------------------------------------


def test_packing(docs, rows):
    got = packing.pack(docs, WORD_BPE, length=64).collect()
    want = Counter()
    for r in bpe.encode(docs, WORD_BPE).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        for o in range(0, len(ids), 64):
            want[r.doc_id, o, tuple(ids[o : o + 64])] += 1
    found = Counter()
    for r in got:
        assert len(r.ids) == len(r.positions) == 64 and r.cumulative[0] == 0 and r.cumulative[-1] == r.n_tokens
        assert not any(r.ids[r.n_tokens :])
        for a, b, d, o in zip(r.cumulative, r.cumulative[1:], r.doc_ids, r.offsets, strict=False):
            found[d, o, tuple(r.ids[a:b])] += 1
            assert r.positions[a:b] == list(range(b - a))
    assert found == want


def test_best_fit():
    import random

    r = random.Random(1)
    for length in (1, 7, 64, 100):
        sizes = [r.randint(1, length) for _ in range(300)]
        got = packing.best_fit(sizes, length)
        assert sorted(i for row in got for i in row) == list(range(300))
        rooms = []  # plain search for the least room that holds the piece
        for size in sorted(sizes, reverse=True):
            fit = min((x for x in rooms if x >= size), default=None)
            if fit is None:
                rooms.append(length - size)
            else:
                rooms[rooms.index(fit)] -= size
        assert sorted(length - sum(sizes[i] for i in row) for row in got) == sorted(rooms)


# 9 --------------------------------------------------------------------------


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_jaccard(spark, docs, rows, k, percent):
    got = jaccard.join(docs, words=k, percent=percent).collect()
    order = in_order(spark, rows)
    sets = [brute.shingles(t, k) for _, t in order]
    first = brute.components(sets, percent)
    want = {key: (len(s), order[c][0]) for key, s, c in zip(order, sets, first, strict=True)}
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter((i, *want[i, t or ""]) for i, t in rows)


def test_jaccard_with_a_full_sketch(spark, docs, monkeypatch):
    plain = Counter(jaccard.join(docs).collect())
    monkeypatch.setattr(sketch, "log2_cells", lambda *_: 6)
    assert Counter(jaccard.join(docs).collect()) == plain


def test_groups(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(20)] + [(50, 40), (50, 45), (7, 7)], "a bigint, b bigint")
    got = {r.u: r.c for r in jaccard.groups(chain).collect()}
    assert got == {**{k: 0 for k in range(21)}, 40: 40, 45: 40, 50: 40}


# 10 -------------------------------------------------------------------------


def test_token_counts(docs, rows):
    model = token_counts.Unigram(RANKS)

    def plain(word):
        best = [(0.0, 0)] + [(-np.inf, 0)] * len(word)
        for i in range(1, len(word) + 1):
            for j in range(max(0, i - model.longest), i):
                s = model.score.get(word[j:i])
                if s is not None:
                    best[i] = max(best[i], (best[j][0] + s, best[j][1] - 1))
        return -best[-1][1]

    short = [(i, t) for i, t in rows if len(t or "") < 2000]
    got = token_counts.token_counts(docs.filter("coalesce(length(text), 0) < 2000"), RANKS).collect()
    want = Counter()
    for i, t in short:
        parts = token_counts.PRE_TOKENS.findall((t or "").encode())
        assert b"".join(parts) == (t or "").encode()
        want[i, len(parts), sum(map(plain, parts))] += 1
    assert Counter(tuple(r) for r in got) == want
    assert token_counts.token_counts(docs, RANKS).count() == len(rows)


# all -------------------------------------------------------------------------


def test_empty_tables(spark, empty):
    assert bpe.decode(bpe.encode(empty, WORD_BPE), WORD_BPE).count() == 0
    assert secrets.scan(empty, "doc_id", "text").count() == 0
    assert topk.search(empty, empty).count() == 0
    assert lines.dedup(empty).count() == lines.runs(empty).count() == 0
    assert substrings.dedup(empty).count() == 0
    assert decontam.contamination(empty, empty, item_id="doc_id").count() == 0
    assert packing.pack(empty, WORD_BPE).count() == 0
    assert jaccard.join(empty).count() == jaccard.first_of_group(empty).count() == 0
    assert token_counts.token_counts(empty, RANKS).count() == 0


def test_text_of_nulls(spark):
    nulls = spark.createDataFrame([(None, None), (None, None), (1, None)], "doc_id bigint, text string")
    assert {r.n_tokens for r in bpe.encode(nulls, WORD_BPE).collect()} == {0}
    assert [r.n_removed for r in substrings.dedup(nulls).collect()] == [0, 0, 0]
    assert Counter((r.n_shingles, r.component_id) for r in jaccard.join(nulls).collect()) == {(0, None): 2, (0, 1): 1}
    assert lines.dedup(nulls).count() == 3
    assert topk.search(nulls, nulls).count() == 0


def test_digests(spark, docs):
    from cohortlens.llm.common import hexdigest

    got = docs.filter("doc_id = 81").select(hexdigest(F.col("text")).alias("h")).first().h
    assert got == hashlib.sha256(b"").hexdigest()
