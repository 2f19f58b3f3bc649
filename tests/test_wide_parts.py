"""Parts of wide frames, fits at once and parts of a replayed stream follow the rows."""

from pyspark.sql import functions as F

from tablefit import streaming
from tablefit.operators import tune
from tablefit.plans import model_queries
from tablefit.sources import load, spread_rows


def test_parts_follow_the_rows(spark):
    df = spark.range(0, 4000, 1, 2).select("id", (F.col("id") % 7).alias("k"))
    assert spread_rows(df, 4000) is df
    wide = spread_rows(df, 4000, 50)
    assert wide.rdd.getNumPartitions() == 80
    assert wide.orderBy("id").collect() == df.orderBy("id").collect()


def test_client_frames_have_parts_of_bounded_rows(spark, sf_small, monkeypatch):
    plain = [f.select("id", "label").orderBy("id").collect() for f in model_queries.client_frames(spark, sf_small)]
    rows = load(spark, sf_small, "orders").count()
    per_part = rows // (3 * spark.sparkContext.defaultParallelism)
    monkeypatch.setattr(spread_rows, "__defaults__", (per_part, None))
    train, test = model_queries.client_frames(spark, sf_small)
    assert train.rdd.getNumPartitions() == -(-rows // per_part)
    assert [f.select("id", "label").orderBy("id").collect() for f in (train, test)] == plain


def test_block_frames_are_dealt_over_the_cluster(spark, sf_small, monkeypatch):
    rows, cores = load(spark, sf_small, "orders").count(), spark.sparkContext.defaultParallelism
    plain = [f.select("block_id", "label").orderBy("block_id").collect() for f in model_queries._block_frames(spark, sf_small)]
    for per_part, least, parts in ((rows, rows // cores, cores), (rows // (2 * cores), 1, -(-rows // (rows // (2 * cores))))):
        monkeypatch.setattr(model_queries, "BLOCKS_PER_PART", per_part)
        monkeypatch.setattr(model_queries, "LEAST_BLOCKS", least)
        train, test = model_queries._block_frames(spark, sf_small)
        assert train.rdd.getNumPartitions() == parts
        assert [f.select("block_id", "label").orderBy("block_id").collect() for f in (train, test)] == plain


def test_fewer_fits_at_once_on_many_rows(spark, monkeypatch):
    train = spark.range(10)
    assert tune.at_once(train, 8) == 8
    monkeypatch.setattr(tune, "ROWS_AT_ONCE", 25)
    assert tune.at_once(train, 8) == 2
    monkeypatch.setattr(tune, "ROWS_AT_ONCE", 5)
    assert tune.at_once(train, 8) == 1


def test_a_replayed_stream_has_more_parts_a_batch_on_more_rows(spark, sf_small, monkeypatch):
    asked, read = [], streaming.read_stream

    def reading(spark, path, schema, max_files_per_trigger=None):
        asked.append((max_files_per_trigger, len(spark.read.parquet(path).inputFiles())))
        return read(spark, path, schema, max_files_per_trigger=max_files_per_trigger)

    monkeypatch.setattr(streaming, "read_stream", reading)
    want = {tuple(r) for r in model_queries.q_stream_confusion(spark, sf_small).collect()}
    monkeypatch.setattr(model_queries, "STREAM_ROWS", load(spark, sf_small, "orders").count() // 60)
    got = {tuple(r) for r in model_queries.q_stream_confusion(spark, sf_small).collect()}
    assert got == want and asked == [(1, 4), (3, 12)]
