"""What the long-running workers hold at once, and how much of an index a search reads."""

import tracemalloc

import numpy as np

from cohortlens.llm import bpe, topk
from cohortlens.llm.queries import TOKENIZERS


def test_learning_many_pieces_drops_its_intermediates():
    vocabulary = bpe.WordBpe(f"{TOKENIZERS}/word_bpe_49k.json")
    vocabulary.learn({b"warm", b"up"})
    pieces = {b"%s%d." % (w, i) for i in range(25_000) for w in (b"alpha", b"beta", b"gamma")}
    tracemalloc.start()
    vocabulary.learn(pieces)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(vocabulary.pieces) == len(pieces) + 2
    assert peak - held < 12e6


def test_a_full_memory_keeps_what_the_text_uses(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    monkeypatch.setattr(bpe, "STEPS", 20)
    monkeypatch.setattr(bpe, "PAIRS", 10)
    vocabulary, plain = (bpe.WordBpe(f"{TOKENIZERS}/word_bpe_49k.json") for _ in range(2))
    split = []
    learn_some = vocabulary.learn_some
    monkeypatch.setattr(vocabulary, "learn_some", lambda new: split.extend(new) or learn_some(new))
    usual = {b"usual%s" % w for w in (b"ly", b"ness", b".", b"ity", "é".encode())}
    for i in range(30):
        seldom = {b"seldom%dx%d" % (i, j) for j in range(7)}
        vocabulary.learn(usual | seldom)
        assert len(vocabulary.pieces) <= 50
        for p in usual | seldom:
            (word, ids), *more = vocabulary.encode_words(w for w in plain.split(p)[:1]).items()
            assert not more and ids == plain.merged([plain.inner[c] for c in word[:-1]] + [plain.final[word[-1]]])
            assert vocabulary.pieces[p][: 4 * len(ids)] == np.array(ids, "<u4").tobytes()
    assert len(split) == len(usual) + 30 * 7


def test_the_path_of_a_prefix_has_all_its_suffixes_in_the_vocabulary():
    mine = bpe.WordBpe(f"{TOKENIZERS}/word_bpe_49k.json")
    for word in ("understandinganders", "zzaaaththing", "internationalization", "qqq\u0120x", "\u4e2dthe"):
        node = 0
        for i, letter in enumerate(word, 1):
            node = mine.step(node, letter)
            want = [(n, mine.inner[word[i - n : i]]) for n in range(i, 0, -1) if word[i - n : i] in mine.inner]
            assert [(n, t) for n, t, _ in mine.ends[node]] == want


def test_long_queries_read_whole_lists(monkeypatch):
    """Bounds prune nothing here: every posting is read about once, and no index is made for each of them."""
    rng = np.random.default_rng(5)
    shard = topk.Shard(60.0)
    for i in range(2000):
        shard.add(i, " ".join(f"w{x}" for x in rng.integers(0, 90, 60)))
    shard.seal()
    made, spread = [], topk.spread
    monkeypatch.setattr(topk, "spread", lambda a, b: made.append(int((b - a).sum())) or spread(a, b))
    got = shard.search(shard.terms, np.ones(len(shard.terms)), 10)
    total = np.bincount(shard.doc, shard.impact)
    assert [round(s, 9) for s, _ in got] == [round(s, 9) for s in np.sort(total)[::-1][:10]]
    assert sum(made) < len(shard.doc) / 4
