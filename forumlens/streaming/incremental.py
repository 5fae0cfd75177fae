"""Incremental loads and windowed counts as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from forumlens.operators.merge import dedup_first, unseen
from forumlens.session import has_table


def load_new_posts(
    spark: SparkSession,
    source: str,
    schema: StructType,
    sink: str,
    checkpoint: str,
    *,
    key: str = "post_id",
    order: Sequence[str] = ("post_id",),
    partition_by: Sequence[str] = (),
) -> None:
    """Append every post whose id is not stored yet, then stop (``availableNow``).

    A batch is reduced to one row per id and anti-joined with the stored ids, so a batch that is
    replayed after a failure adds nothing, and no state grows with the stream.
    """

    def append(batch: DataFrame, _: int) -> None:
        first = dedup_first(batch, key, order)
        if has_table(spark, sink):
            first = unseen(first, spark.read.parquet(sink), key)
        first.write.mode("append").partitionBy(*partition_by).parquet(sink)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def posts_per_window(posts: DataFrame, ts: str, by: Sequence[str], width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Counts per time window; works on a batch or, with a watermark bounding the state, a stream."""
    posts = posts.withColumn(ts, F.col(ts).cast("timestamp"))
    timed = posts.withWatermark(ts, delay) if posts.isStreaming else posts
    counted = timed.groupBy(F.window(ts, width).alias("_w"), *by).agg(F.count("*").alias("n"))
    return counted.select(F.col("_w.start").alias("window_start"), *by, "n")


def run_window_counts(stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Run the counts over what has arrived and read them back.

    Each batch appends the windows it changed; counts only grow, so the largest one is current.
    """

    def append(batch: DataFrame, _: int) -> None:
        batch.write.mode("append").parquet(sink)

    (
        stream.writeStream.outputMode("update").foreachBatch(append)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    )
    stored = stream.sparkSession.read.schema(stream.schema).parquet(sink)
    return stored.groupBy(*[c for c in stored.columns if c != "n"]).agg(F.max("n").alias("n"))
