from pyspark.sql import functions as F

from tablefit.operators import evaluate, features, models, split
from tablefit.session import scratch_path
from tablefit.plans.profile_queries import prepared_clients
from tablefit.streaming import read_stream, score_stream, start_confusion


def test_stream_scoring_matches_batch(spark, sf_small):
    df = split.with_split(prepared_clients(spark, sf_small), "id").withColumn("label", F.col("label").cast("double"))
    pipe = features.feature_pipeline(numeric=["limit_bal"], integer_categorical=["pay_1", "sex"],
                                     handle_invalid="keep")
    train = df.where("split = 'train'")
    fitted_features = features.fit_features(pipe, df, train=train)
    clf = models.estimator("logistic_regression").fit(fitted_features.transform(train))

    test = df.where("split = 'test'").drop("split")
    path = scratch_path(spark, "stream-src")
    test.repartition(3).write.parquet(path)  # three files -> several micro-batches

    stream = read_stream(spark, path, test.schema, max_files_per_trigger=1)
    scored = score_stream(clf, score_stream(fitted_features, stream))
    q = start_confusion(scored, "conf_test")
    try:
        q.processAllAvailable()
        got = {(r.label, r.prediction): r["count"] for r in spark.table("conf_test").collect()}
    finally:
        q.stop()
    batch = evaluate.confusion(clf.transform(fitted_features.transform(test)))
    want = {(r.label, r.prediction): r["count"] for r in batch.collect()}
    assert got == want


def test_stream_restart_from_checkpoint(spark, sf_small):
    """Stop the running confusion after part of the input, restart it on the
    same checkpoint: state resumes, nothing is counted twice or lost."""
    df = split.with_split(prepared_clients(spark, sf_small), "id").withColumn("label", F.col("label").cast("double"))
    pipe = features.feature_pipeline(numeric=["limit_bal"], integer_categorical=["pay_1"], handle_invalid="keep")
    fitted = features.fit_features(pipe, df, train=df.where("split = 'train'"))
    clf = models.estimator("logistic_regression").fit(fitted.transform(df.where("split = 'train'")))
    rows = df.drop("split")
    src = scratch_path(spark, "stream-restart-src")
    first, second = rows.where("id % 2 = 0"), rows.where("id % 2 = 1")
    first.write.parquet(src + "/a")

    ckpt = scratch_path(spark, "stream-restart-ckpt")

    def run(name):
        stream = read_stream(spark, src + "/*", rows.schema)
        q = start_confusion(score_stream(clf, score_stream(fitted, stream)), name, checkpoint=ckpt)
        q.processAllAvailable()
        q.stop()
        return {(r.label, r.prediction): r["count"] for r in spark.table(name).collect()}

    run("conf_restart_1")
    second.write.parquet(src + "/b")
    got = run("conf_restart_2")
    want = {(r.label, r.prediction): r["count"]
            for r in evaluate.confusion(clf.transform(fitted.transform(rows))).collect()}
    assert got == want
