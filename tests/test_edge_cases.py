"""Inputs that the fixture tables do not hold: zero and equal vectors, null values, gaps, broken stores."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from forumlens.operators import clusters, conversation, retrieval, stats
from forumlens.plans import topicmodel
from forumlens.session import has_table
from forumlens.sources.posts import checkpointed
from forumlens.streaming.incremental import load_new_posts


def test_reranking_takes_zero_vectors(spark):
    hits = spark.createDataFrame(
        [(1, 10, "positive", 0.9, [0.0, 0.0]), (1, 11, "neutral", 0.8, [0.0, 0.0]), (1, 12, "neutral", 0.7, [1.0, 0.0])],
        "query_id long, passage_id long, sentiment string, score double, embedding array<double>",
    )
    assert [r["passage_id"] for r in retrieval.rerank_diverse(hits).orderBy("rank").collect()] == [10, 11, 12]


def test_silhouette_of_equal_vectors_is_zero(spark):
    docs = spark.createDataFrame([(t, [1.0, 0.0]) for t in (0, 0, 1, 1)], "topic int, embedding array<double>")
    got = clusters.silhouette_cosine(docs.withColumn("category", F.lit("c"))).collect()
    assert [r["silhouette"] for r in got] == [0.0]


def test_null_values_keep_their_rows_without_a_rank(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 2.0), (4, 5.0)], "id long, v double")
    assert {r["id"]: r["avg_rank"] for r in stats.average_ranks(df, "v").collect()} == {1: 1.5, 2: None, 3: 1.5, 4: 3.0}


def test_history_counts_messages_not_turn_numbers(spark):
    turns = [(1, t, "user" if i % 2 == 0 else "assistant", f"m{i}") for i, t in enumerate((0, 20, 40, 41, 9000))]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r["history"] for r in conversation.recent_history(df, pairs=1).collect()}
    assert got[0] == "" and got[20] == "user: m0" and got[9000] == "user: m2\nassistant: m3"
    summary = {r["turn"]: r["history_summary"] for r in conversation.history_summary(df, back=1).collect()}
    assert summary[9000].endswith("assistant: m3...")
    kept = {r["turn"]: r["n_before"] for r in conversation.kept_history(df, F.lit(0.0)).collect()}
    assert kept == {0: 0, 40: 2, 9000: 4}


@pytest.mark.parametrize("threshold", [0.5, 0.6])
def test_an_outlier_on_a_centroid_moves_among_twelve_topics(spark, threshold):
    unit = lambda i: [1.0 if j == i else 0.0 for j in range(12)]
    rows = [(i, i, unit(i)) for i in range(12)] + [(100 + i, -1, unit(i)) for i in range(12)] + [(200, -1, [0.3] * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, topic int, embedding array<double>").withColumn("category", F.lit("c"))
    likely = clusters.membership_probs(docs, clusters.centroids(docs, ["category", "topic"]))
    moved = {r["doc_id"]: r["new_topic"] for r in clusters.reassign_outliers(likely, threshold).where("topic = -1").collect()}
    assert moved == {**{100 + i: i for i in range(12)}, 200: -1}


@pytest.mark.parametrize("threshold", [0.5, 0.6])
def test_registered_reassignment_moves_documents(spark, threshold):
    moved = topicmodel.moved(spark, "/root/testdata/sf0.001", threshold)
    assert moved.where("topic <> new_topic").count() > 0


def test_radius_goes_on_past_the_ladder(spark):
    points = spark.createDataFrame([([float(100 * i), 0.0],) for i in range(20)], "reduced array<double>")
    assert clusters.choose_eps(points, [0.1, 0.2], 5, dims=2) > 100


def test_a_stored_table_without_the_key_is_an_error(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(3).select(F.col("id").cast("string").alias("post_id")).write.parquet(source)
    spark.range(3).toDF("other").write.parquet(sink)
    with pytest.raises(Exception, match="post_id"):
        load_new_posts(spark, source, spark.read.parquet(source).schema, sink, str(tmp_path / "cp"))
    assert spark.read.parquet(sink).columns == ["other"]


def test_only_finished_tables_are_read_again(spark, tmp_path):
    path = str(tmp_path / "stage")
    assert not has_table(spark, path)
    assert checkpointed(spark, path, lambda: spark.range(2)).count() == 2
    assert checkpointed(spark, path, lambda: spark.range(9)).count() == 2
    (tmp_path / "stage" / "_SUCCESS").unlink()
    assert checkpointed(spark, path, lambda: spark.range(9)).count() == 9

    def broken():
        return spark.range(1).select("missing")

    with pytest.raises(AnalysisException):
        checkpointed(spark, str(tmp_path / "other"), broken)
