"""Stages that drop rows judge each row by id and text, never by a null or shared id alone."""

import random
from collections import Counter

from conftest import prose

import corpus_pipeline
from cohortlens.llm import jaccard, toxicity

SCHEMA = "doc_id bigint, text string"


def rows_of(df):
    return Counter((x.doc_id, x.text) for x in df.collect())


def test_toxic_rows(spark):
    r = random.Random(5)
    mean = ["worthless", "moronic", "pathetic", "disgusting"]
    say = lambda bad: " ".join("".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 6))) if not bad or r.random() > 0.06 else r.choice(mean) for _ in range(200))
    data = [(i, say(i % 5 == 0)) for i in range(600)]
    more = [(None, say(True)), (None, say(False)), (None, None), (None, ""), (700, say(True)), (700, say(False))]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(600)], "doc_id bigint, quality int, toxic int")
    left = rows_of(toxicity.drop_toxic(spark.createDataFrame(data + more, SCHEMA).repartition(4), labels))
    assert [left[x] for x in more] == [0, 1, 1, 1, 0, 1]


def test_contaminated_rows(spark, tmp_path):
    r = random.Random(6)
    item = prose(r, 25)
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    bad = lambda: prose(r, 20) + " " + item + " " + prose(r, 20)
    data = [(None, bad()), (None, prose(r, 60)), (None, None), (1, bad()), (1, prose(r, 60)), (2, prose(r, 60))]
    left = rows_of(corpus_pipeline.decontamination(spark, spark.createDataFrame(data, SCHEMA), str(tmp_path)))
    assert left == Counter(data[k] for k in (1, 2, 4, 5))


def test_near_copies(spark):
    r = random.Random(8)
    base, named, twin = prose(r, 200), prose(r, 200), prose(r, 200)
    near = lambda t: t + " " + prose(r, 2)
    nulls = [(None, base), (None, base), (None, near(base)), (None, near(base)), (None, None), (None, None), (None, " ")]
    mixed = [(3, named), (None, near(named)), (None, prose(r, 100))]
    shared = [(5, twin), (5, near(twin)), (5, prose(r, 100)), (9, near(twin))]
    left = rows_of(jaccard.first_of_group(spark.createDataFrame(nulls + mixed + shared, SCHEMA).repartition(4)))
    assert sum(n for (_, t), n in left.items() if t and t.startswith(base)) == 1
    assert [n for (_, t), n in left.items() if t and t.startswith(twin)] == [1] and left[5, shared[2][1]] == 1
    assert left[None, None] == 2 and left[None, " "] == 1
    assert [k for k in left if k[1] and k[1].startswith(named)] == [(3, named)] and left[mixed[2]] == 1
    assert sum(left.values()) == 8


def test_item_ids_are_never_split(spark):
    """Ids with commas, empty ids, and an item whose only id is null."""
    from collections import Counter

    import brute
    from cohortlens.llm import decontam

    words = [" ".join(f"w{k}x{i}" for i in range(14)) for k in range(4)]
    items = [("x,y", words[0]), ("", words[1]), (None, words[2]), ("a", words[3]), ("x,y", words[3]), ("b,", words[3])]
    docs = [(k, f"before {w} after") for k, w in enumerate(words)] + [(9, " ".join(words)), (10, "clean text")]
    got = decontam.contamination(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id string, text string")).collect()
    want = brute.contaminated([t for _, t in docs], items, 10)
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"]) for r in got) == Counter((i, *w) for (i, _), w in zip(docs, want, strict=True))
    assert {r.doc_id: r.n_items for r in got} == {0: 1, 1: 1, 2: 0, 3: 3, 9: 4, 10: 0}


def test_a_ledger_that_holds_a_blob_twice(spark, tmp_path):
    from cohortlens.llm import secrets

    ledger = f"file://{tmp_path}/ledger"
    versions = spark.createDataFrame([("p", "token=abcdefgh"), ("q", "none")], "path string, content string")
    secrets.scan(versions, ledger=ledger).collect()
    spark.read.parquet(ledger).write.mode("append").parquet(ledger)
    assert sorted((r.path, len(r.findings)) for r in secrets.scan(versions, ledger=ledger).collect()) == [("p", 1), ("q", 0)]


def test_round_trip_in_one_worker(docs):
    from collections import Counter

    from cohortlens.llm import bpe
    from cohortlens.llm.queries import TOKENIZERS

    path = f"{TOKENIZERS}/word_bpe_49k.json"
    same = lambda df: Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in df.collect())
    assert same(bpe.round_trip(docs, path)) == same(bpe.decode(bpe.encode(docs, path), path))
