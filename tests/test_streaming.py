"""Streams equal their batch twins, and a rerun adds nothing."""

from pyspark.sql import functions as F

from forumlens.operators import merge
from forumlens.session import fresh_path
from forumlens.streaming import incremental

SCHEMA = "post_id string, title string, at int"


def test_incremental_load_equals_the_merge(spark):
    source, sink, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "chk"))
    first = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("2", "c", 3)], SCHEMA)
    second = spark.createDataFrame([("2", "late", 0), ("3", "d", 1), ("3", "e", 0)], SCHEMA)
    merged = merge.merge_posts(merge.dedup_first(first, "post_id", ["at"]), second, "post_id", ["at"])
    for wave in (first, second):
        wave.write.mode("append").parquet(source)
        incremental.load_new_posts(spark, source, first.schema, sink, checkpoint, order=["at"])
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(spark.read.parquet(sink)) == rows(merged)
    incremental.load_new_posts(spark, source, first.schema, sink, checkpoint, order=["at"])
    # A lost checkpoint replays everything and still adds nothing.
    incremental.load_new_posts(spark, source, first.schema, sink, fresh_path(spark, "chk"), order=["at"])
    assert rows(spark.read.parquet(sink)) == rows(merged)


def test_window_counts_over_several_runs(spark):
    source, sink, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "chk"))
    day = lambda n: F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600 * n)
    waves = [spark.range(50).select(day(1).alias("ts"), F.lit("a").alias("kind")), spark.range(20).select(day(2).alias("ts"), F.lit("b").alias("kind"))]
    for wave in waves:
        wave.write.mode("append").parquet(source)
        stream = spark.readStream.schema(wave.schema).parquet(source)
        got = incremental.run_window_counts(incremental.posts_per_window(stream, "ts", ["kind"], delay="30 days"), sink, checkpoint)
    batch = incremental.posts_per_window(spark.read.parquet(source), "ts", ["kind"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
