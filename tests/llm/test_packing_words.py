"""Words of the packing operator against the library on whole texts, ids of any type, forgetting."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortlens.llm import packing
from cohortlens.llm.queries import TOKENIZERS

WORD_BPE = f"{TOKENIZERS}/word_bpe_49k.json"
LIBRARY = Tokenizer.from_file(WORD_BPE)
WORDS = packing.Words(WORD_BPE)


def by_words(text, vocabulary=WORDS):
    words = vocabulary.cut(text)
    known = vocabulary.learn(set(words))
    return np.frombuffer(b"".join(known[w] for w in words), "<u4").tolist()


def whole(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_every_latin_character():
    for c in [*range(1, 0x260), 0x0307, 0x1E9E, 0x212A, 0x212B, 0x2126, 0x2C7E, 0x3000, 0x4E00, 0x1F600]:
        for text in (chr(c), f"ab{chr(c)}cd", f"1{chr(c)} 's{chr(c)}'ll", f"x {chr(c)}\n{chr(c)}{chr(c)}"):
            assert by_words(text) == whole(text), hex(c)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abZ 's'll'Re\n\t.,!<|>09é²½İßſ́  Å\x1c\x85жΩ漢") | st.characters(max_codepoint=0x24F, exclude_categories=["Cs"])))
def test_any_text(text):
    assert by_words(text) == whole(text)


def test_special_tokens_and_forgetting(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    fresh = packing.Words(WORD_BPE)
    for text in ("a <|endoftext|> b<|startoftext|>c", "don't we'll 12 ab", "some other words here", "don't some ab", "<|endof text|>", ""):
        assert by_words(text, fresh) == whole(text)
        assert len(fresh.newer) <= 8 and len(fresh.older) <= 8  # the words of one text at most


@pytest.mark.parametrize("kind, ids", [("int", [1, 2, None]), ("smallint", [1, 2, None]), ("string", [None, None, None]), ("string", ["a", "b", None])])
def test_id_types(spark, kind, ids):
    docs = spark.createDataFrame(list(zip(ids, ["some words " * 30, "others", "more"], strict=True)), f"doc_id {kind}, text string").coalesce(1)
    rows = packing.pack(docs, WORD_BPE, length=16).collect()
    assert sorted(map(str, {d for r in rows for d in r["doc_ids"]})) == sorted(map(str, set(ids)))
    assert sum(r["n_tokens"] for r in rows) == sum(len(whole(t)) for t in ("some words " * 30, "others", "more"))
    assert dict(packing.pack(docs, WORD_BPE).dtypes)["doc_ids"] == f"array<{kind}>"


def test_plain_words_need_the_merges_alone():
    """Normalising and cutting again words that are lower-cased and cut costs a third of their encoding."""
    fresh = packing.Words(WORD_BPE)
    asked = []

    class Library:
        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            return LIBRARY.encode_batch_fast(texts, **how)

    fresh.library = Library()
    text = "Some words, don't stop: (caf\u00e9) 3rd! {x} a_b <|ab|> Na\u00efve ++"
    assert by_words(text, fresh) == whole(text)
    assert sorted(" ".join(asked).split()) == ["caf\u00e9", "na\u00efve"]
