"""The pipeline's stages, each against a plain version of what it should keep."""

import random

import pytest
from conftest import prose

import brute
import corpus_pipeline
from cohortlens.llm import bpe, toxicity
from cohortlens.llm.common import stored

MEAN = ["worthless", "moronic", "pathetic", "disgusting"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(3)
    items = [prose(r, 25, "aeiounrst") for _ in range(4)]
    rows = [(i, "\n".join(prose(r, 40, "aeiounrst") for _ in range(4))) for i in range(300)]
    for i in range(0, 300, 6):
        w = rows[i][1].split(" ")
        for _ in range(9):
            w[r.randrange(len(w))] = r.choice(MEAN)
        rows[i] = (i, " ".join(w))
    base = rows[1][1].replace("\n", " ")
    rows += [(300 + k, base) for k in range(4)] + [(310 + k, base + " " + prose(r, 4)) for k in range(4)]
    rows += [(320 + k, prose(r, 30) + " " + items[k] + " " + prose(r, 30)) for k in range(4)]
    rows += [(330, rows[2][1]), (331, "kept line here\n" + rows[3][1] + "\nlast line"), (332, None), (333, ""), (None, None)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(300)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = stored(stage(spark, docs, folder), name)
        left = {(r.doc_id, r.text if "text" in after.columns else None) for r in after.collect()}
        ids = {i for i, _ in left}
        if name != "encoding":
            assert after.columns == columns
        if name == "toxicity":
            toxic = {i for i in range(0, 300, 6)}
            assert len(toxic - ids) >= 45 and {i for i, _ in before} - toxic <= ids
        elif name == "line_dedup":
            order = sorted((x for x in before if x[0] is not None and x[1] is not None))
            gone = brute.runs_removed([t.split("\n") for _, t in order], 2)
            want = {(i, "\n".join(x for x, g in zip(t.split("\n"), gs, strict=True) if not g)) for (i, t), gs in zip(order, gone, strict=True) if not all(gs)}
            assert left == want | {(332, None), (None, None)}
            assert all(r.n_chars == len(r.text or "") for r in after.collect())
        elif name == "near_duplicates":
            order = sorted((x for x in before if x[0] is not None))
            sets = [brute.shingles(t, 5) for _, t in order]
            first = brute.components(sets, 80)
            assert left == {x for k, x in enumerate(order) if first[k] == k} | {(None, None)}
            assert {1, 332, 333} <= ids and not {300, 301, 302, 303, 310} & ids
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            hit = brute.contaminated([t for _, t in before], items, 10)
            assert left == {x for x, h in zip(before, hit, strict=True) if not h[1]}
            assert not {320, 321, 322, 323} & ids
        else:
            assert sorted(map(str, ids)) == sorted(str(i) for i, _ in before)
            assert {r.doc_id: r.n_tokens for r in after.collect()} == {r.doc_id: r.n_tokens for r in bpe.encode(docs, f"{corpus_pipeline.TOKENIZERS}/word_bpe_49k.json").collect()}
        docs = after
    assert corpus_pipeline.run(spark, folder).count() == docs.count()


def test_stages_on_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs


def test_scores_learn_from_no_held_out_row(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "quality", "IF(crc32(CAST(doc_id AS STRING)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    a, b = (toxicity.fit(docs, x.filter(~toxicity.held_out())) for x in (labels, flipped))
    assert a["toxic"] == b["toxic"] and (a["w"] == b["w"]).all()


def test_encoding_is_one_map(spark, folder):
    """Two Python maps of one stage are two workers in every task, each with the vocabulary."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.encoding(spark, docs, folder)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    path = f"{corpus_pipeline.TOKENIZERS}/word_bpe_49k.json"
    apart = bpe.decode(bpe.encode(docs, path), path)
    assert out.columns == apart.columns
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(out) == plain(apart)
