"""Long single lines that repeat between different neighbours, in the pipeline."""

import random

from conftest import prose

import corpus_pipeline


def test_long_single_lines(spark, tmp_path):
    r = random.Random(11)
    passage, whole, short = prose(r, 60), prose(r, 168), prose(r, 20)
    other = lambda: prose(r, 400, "mnopqrst")
    rows = [(i, "\n".join([other(), passage, short, other()] if i % 2 else [other(), short, passage, other()])) for i in range(4)]
    rows += [(4, other() + "\n" + whole + "\n" + other()), (5, whole), (6, None), (7, ""), (8, other() + "\n" + prose(r, 60))]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id bigint, text string, n_chars bigint")
    after = corpus_pipeline.line_dedup(spark, docs, str(tmp_path))
    got = {x.doc_id: x for x in corpus_pipeline.near_duplicates(spark, after, str(tmp_path)).collect()}
    seen, want = set(), {}
    before = {x.doc_id: x.text for x in after.collect()}
    for i in sorted(before):
        kept = []
        for line in (before[i] or "").split("\n"):
            if len(line.split()) < corpus_pipeline.LONG_LINE_WORDS or line not in seen:
                kept.append(line)
            seen.add(line)
        if kept:
            want[i] = None if before[i] is None else "\n".join(kept)
    assert {i: x.text for i, x in got.items()} == want
    assert sum(passage in (x.text or "") for x in got.values()) == sum(whole in (x.text or "") for x in got.values()) == 1
    assert 5 not in got and sum(short in (x.text or "") for x in got.values()) > 1
    assert all(x.n_chars == len(x.text or "") for x in got.values())
