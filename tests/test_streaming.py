from cohortlens.plans import catalog as C
from cohortlens.session import scratch_path
from cohortlens.streaming import score_stream, start_scoring


def test_stream_scores_equal_batch_scores(spark, smoke_dir):
    train, test = C.split_tables(spark, smoke_dir)
    cols = ["row_id", "y_learn", "segment", "priority", *[c for c in C.NUMERIC_FEATURES + C.CATEGORICAL_FEATURES if c != "segment"]]
    src = scratch_path(spark, "stream-src")
    test.select(*cols).repartition(3).write.parquet(src)
    learner = C.rf_learner(trees=5, depth=3)
    f = learner.featurizer(train.select(*cols))
    model = learner.estimator.fit(f(train.select(*cols)))
    stream = spark.readStream.schema(test.select(*cols).schema).parquet(src)
    out = scratch_path(spark, "stream-out")
    q = start_scoring(score_stream(model, stream, f, target="y_learn"), out, scratch_path(spark, "stream-checkpoint"))
    q.awaitTermination(300)
    got = {r["row_id"]: r["prediction"] for r in spark.read.parquet(out).collect()}
    want = {r["row_id"]: r["prediction"] for r in score_stream(model, spark.read.parquet(src), f, target="y_learn").collect()}
    assert got == want and len(got) == test.count()
