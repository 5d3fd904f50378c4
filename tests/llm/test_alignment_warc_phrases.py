"""Phrase collocations, cross-tokenizer alignment and WARC archives against plain versions."""

import base64
import gzip
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from cohortlens.llm import alignment, phrases, queries, warc
from cohortlens.llm.queries import TOKENIZERS

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"


# phrases -----------------------------------------------------------------------


def talk(r, n):
    return "".join(r.choice(["a", "b", "c", "D", "é", "f-g", "x\x00"]) + r.choice([" ", " ", "  ", "\t", ", ", ".\n", "; ", "\r", " "]) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    r = random.Random(5)
    rows = [(i, talk(r, r.randint(0, 60)), r.choice(["en", "de", None, "und"])) for i in range(300)]
    rows += [(i, "one fixed phrase", "en") for i in range(30)] + [(400, None, "en"), (401, "", None), (None, "a b " * 3000, "fr"), (402, "Only once", "zz")]
    r.shuffle(rows)
    schema = "doc_id bigint, body string, lang string, words int, phrase string, shard int, h bigint"
    return rows, spark.createDataFrame([(*x, 1, "p", 2, 3) for x in rows], schema).repartition(6)


@pytest.mark.parametrize(("support", "longest", "shards", "covered"), [(10, 3, 4, 50), (10, 4, 7, 30), (3, 2, 1, 50), (12, 3, 50, 90)])
def test_phrases(spoken, support, longest, shards, covered):
    rows, docs = spoken
    got = phrases.collocations(docs, top=25, support=support, longest=longest, covered=covered, shards=shards, text="body").collect()
    want = brute.collocations([(lang, t) for _, t, lang in rows], 25, support, longest, covered)
    assert sorted(map(tuple, got)) == sorted(want) and len({x[0] for x in want}) > 3


def test_phrases_with_a_full_bitmap_and_small_slices(spoken, monkeypatch):
    """More candidates than bits, chunks added up early: the same rows."""
    rows, docs = spoken
    monkeypatch.setattr(phrases, "BITS_EACH", 0)
    monkeypatch.setattr(phrases, "CHUNK", 50)
    monkeypatch.setattr(phrases, "SLICE", 500)
    got = phrases.collocations(docs, top=2000, text="body").collect()
    assert sorted(map(tuple, got)) == sorted(brute.collocations([(lang, t) for _, t, lang in rows], 2000, 10, 3, 50))


def test_phrases_empty(empty):
    assert phrases.collocations(empty).count() == 0


def test_scores_beyond_64_bits(spark):
    """1000000 * a * a passes 64 bits; the integer score stays exact."""
    a, left, right = 3_000_000_019, 4_000_000_007, 5_000_000_029
    df = spark.createDataFrame([(a, left, right)], "a bigint, l1 bigint, r1 bigint")
    big = lambda c: f"cast({c} as decimal(18,0))"
    assert df.select(F.expr(f"(1000000BD * {big('a')} * {big('a')}) div ({big('l1')} * {big('r1')})")).first()[0] == 1_000_000 * a * a // (left * right)


# alignment ---------------------------------------------------------------------


def odd_texts():
    r = random.Random(3)
    bits = ["the", " ", " ", "  ", "\n", "\t", "Übung", "ſ", " ", "▁", "　", "x\x00", "᠎", "日本", "😀", "é", "<|endoftext|>", "<s>", "<0x41>", "'s", "don't", "12", "\x85", "\x1c", "!?", "​", "﻿"]
    return ["".join(r.choice(bits) for _ in range(r.randint(1, 25))) for _ in range(1500)] + ["x" * 5000, "a " * 2000, " ", "\n", "word", " word ", "a▁b"]


def plain_alignment(texts):
    """Per text (n_a, n_b, groups, links) from tokens of the whole text."""
    import sentencepiece

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = {c: i for i, c in enumerate(alignment.byte_letters())}
    out = []
    for t in texts:
        x = a.encode(" " + t, add_special_tokens=False) if t else None
        ids = (x.ids, b.encode(t)) if t else ([], [])
        spelled = [bytes(letters[c] for c in w) for w in x.tokens] if t else []
        other = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids[1])]
        if not t or b"".join(spelled) != (" " + t).encode() or b"".join(other) != (" " + t).encode():
            out.append((0, 0, [], []))
            continue
        ends = [np.cumsum([len(w) for w in side]).tolist() for side in (spelled, other)]
        links = [(i, j) for i in range(len(ids[0])) for j in range(len(ids[1])) if max(ends[0][i] - len(spelled[i]), ends[1][j] - len(other[j])) < min(ends[0][i], ends[1][j])] if len(ids[0]) < 400 else None
        groups, i0, j0 = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            i, j = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(",".join(map(str, ids[0][i0:i])) + "|" + ",".join(map(str, ids[1][j0:j])))
            i0, j0 = i, j
        out.append((len(ids[0]), len(ids[1]), groups, None if links is None else [ids[0][i] << 32 | ids[1][j] for i, j in links]))
    return out


@pytest.mark.parametrize("remembered", [250_000, 5])
def test_alignment_equals_whole_texts(spark, remembered, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", remembered)
    monkeypatch.setattr(alignment, "SLICE", 20_000)
    texts = odd_texts()
    assert alignment.Aligner(A, B).parted
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, groups string").repartition(4)
    got = {r.doc_id: r for r in alignment.align(df, A, B).collect()}
    assert len(got) == len(texts)
    zero = 0
    for i, (n_a, n_b, groups, links) in enumerate(plain_alignment(texts)):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.groups) == (n_a, n_b, len(groups), ";".join(groups)), repr(texts[i])
        zero += n_a == 0
        if links is not None:
            assert dict(zip(r.pairs, r.times, strict=True)) == Counter(links) and r.n_links == len(links) and list(r.pairs) == sorted(r.pairs)
    assert 0 < zero < len(texts) // 2


@pytest.mark.parametrize("broadcast", [0, 2_000_000])
def test_link_statistics(docs, rows, broadcast, monkeypatch):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", broadcast)
    got = alignment.link_statistics(alignment.align(docs, A, B))
    per = alignment.align(docs, A, B).collect()
    count = Counter(p for r in per for p in r.pairs)
    most = defaultdict(int)
    for p, c in count.items():
        most[p >> 32] = max(most[p >> 32], c)
    want = Counter(
        (r.doc_id, r.n_a, r.n_links, sum(t for p, t in zip(r.pairs, r.times, strict=True) if count[p] == most[p >> 32]), sum(t * count[p] for p, t in zip(r.pairs, r.times, strict=True))) for r in per
    )
    assert Counter((r.doc_id, r.n_a, r.n_links, r.n_best, r.count_sum) for r in got.collect()) == want
    assert len(per) == len(rows)


def test_alignment_query_on_whole_table(spark, smoke_dir):
    got = {r.doc_id: r for r in queries.op12_alignment(spark, smoke_dir).collect()}
    table = spark.read.parquet(f"{smoke_dir}/documents.parquet").select("doc_id", "text").collect()
    plain = plain_alignment([r.text for r in table])
    for r, (n_a, n_b, groups, _) in zip(table, plain, strict=True):
        g = got.pop(r.doc_id)
        assert (g.n_a, g.n_b, g.n_groups) == (n_a, n_b, len(groups))
        assert g.groups_sha256 == (hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
    assert not got


def test_alignment_empty(empty):
    assert alignment.link_statistics(alignment.align(empty, A, B)).count() == 0


# WARC --------------------------------------------------------------------------


def sha(body):
    return base64.b32encode(hashlib.sha1(body).digest()).decode()


def crawl():
    r = random.Random(9)
    pool = [b"", b"\r\n", b"\r\n\r\n", b"\r\r\n\n", b"x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "é\x00ü".encode(), b"\r", b"a" * 300_000, b"tail\r\n"]
    pool += [bytes(r.choice(b"ab\r\n") for _ in range(r.randint(1, 40))) for _ in range(20)]
    rows = [(i, f"http://x/{i % 7} a", r.choice(pool), "p") for i in range(150)]
    rows += [rows[3], rows[3], rows[5], (None, "u", pool[7], None), (None, None, pool[7], None), (None, None, b"only without id", None), (-5, "v", None, None), (200, "\r\nWARC-Type: x", b"z", "")]
    return rows + [(300, "hot", b"hot page", "")] * 60


def resolved(rows, least=0):
    """Counter of (id, bytes, digest, type, refers_to)."""
    groups = defaultdict(list)
    for key, _, body, _ in rows:
        groups[body or b""].append(key)
    out = Counter()
    for body, keys in groups.items():
        if len(body) < least:
            out.update((k, len(body), sha(body), "response", None) for k in keys)
            continue
        keys.sort(key=lambda k: (k is not None, k or 0))
        out[keys[-1], len(body), sha(body), "response", None] += 1
        out.update((k, len(body), sha(body), "revisit", keys[-1]) for k in keys[:-1])
    return out


def shape(df):
    return Counter((r.source_id, r.bytes, r.digest, r.type, r.refers_to) for r in df.collect())


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(crawl(), "page_id bigint, url string, html binary, digest string").repartition(5)


@pytest.mark.parametrize("least", [0, 10])
def test_warc_round_trip(spark, pages, least):
    assert shape(warc.deduplicated(pages, least_bytes=least)) == resolved(crawl(), least)


def test_warc_files(spark, pages, tmp_path):
    """Records are whole WARC records: payloads come back byte by byte, and a plain parser reads them."""
    path = warc.write(pages, f"file://{tmp_path}/w")
    back = warc.read(spark, path, payloads=True).collect()
    responses = [r for r in back if r.type == "response"]
    assert Counter(bytes(r.payload) for r in responses) == Counter({b or b"" for _, _, b, _ in crawl()})
    assert len({r.record_id for r in back}) == len(back) == len(crawl())
    assert {r.refers_to for r in back if r.type == "revisit"} <= {r.record_id for r in responses}
    seen = 0
    for f in (tmp_path / "w").glob("*.gz"):
        data = gzip.decompress(f.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and set(fields) >= {b"WARC-Record-ID", b"WARC-Date", b"Content-Length", b"WARC-Target-URI"}
            n = int(fields[b"Content-Length"])
            assert rest[n : n + 4] == b"\r\n\r\n"
            data, seen = rest[n + 4 :], seen + 1
    assert seen == len(crawl())


def test_warc_rewrite(spark, pages, tmp_path):
    """An archive without revisits, and one with them, become the same deduplicated archive."""
    plain = warc.write(pages, f"file://{tmp_path}/plain", least_bytes=1 << 40)
    assert {r.type for r in warc.read(spark, plain).collect()} == {"response"}
    once = warc.rewrite(spark, plain, f"file://{tmp_path}/once", kind="bigint")
    twice = warc.rewrite(spark, once, f"file://{tmp_path}/twice", kind="bigint")
    for path in (once, twice):
        assert shape(warc.records(spark, path, "bigint")) == resolved(crawl())
    back = warc.rewrite(spark, twice, f"file://{tmp_path}/back", least_bytes=1 << 40, kind="bigint")
    assert shape(warc.records(spark, back, "bigint")) == resolved(crawl(), 1 << 40)


def test_warc_of_other_makers(spark, tmp_path):
    """A gzip member for each record, other record types, no HTTP block, a revisit known by its digest alone."""
    def rec(fields, block):
        head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
        return gzip.compress(f"WARC/1.0\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n")

    (tmp_path / "in").mkdir()
    with open(tmp_path / "in" / "a.warc.gz", "wb") as f:
        f.write(rec({"WARC-Type": "warcinfo", "WARC-Record-ID": "<i>"}, b"software: x\r\n"))
        f.write(rec({"WARC-Type": "response", "WARC-Record-ID": "<r>", "WARC-Target-URI": "u1", "X-Source-Id": "1"}, b"body\r\nof one"))
        f.write(rec({"warc-type": "revisit", "WARC-Record-ID": "<v>", "WARC-Target-URI": "u2", "X-Source-Id": "2", "WARC-Payload-Digest": "sha1:" + sha(b"body\r\nof one")}, b""))
    out = warc.rewrite(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out")
    assert shape(warc.records(spark, out)) == Counter([("2", 12, sha(b"body\r\nof one"), "response", None), ("1", 12, sha(b"body\r\nof one"), "revisit", "2")])


def test_warc_empty_and_string_ids(spark):
    none = spark.createDataFrame([], "page_id string, url string, html string")
    assert warc.deduplicated(none).count() == 0
    some = spark.createDataFrame([("a b:%\r\n", "u", "t"), ("", "u", "t"), (None, "u", "t"), ("ä", "u", "t")], none.schema)
    got = shape(warc.deduplicated(some))
    assert {x[0] for x in got} == {"a b:%\r\n", "", None, "ä"}
    assert {x[4] for x in got if x[3] == "revisit"} == {"ä"}
