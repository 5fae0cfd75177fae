"""The usual chains of operators: corpus, topics, subtopic graph."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.functions import text as tx
from forumlens.operators import clusters, coherence, conversation, embedding, graph, merge, retrieval, topics
from forumlens.session import staged


def build_corpus(posts: DataFrame, order: Sequence[str], *, min_words: int = 3, features: int = 256) -> DataFrame:
    """Raw posts of all tags -> one row per post with cleaned text and vector.

    First post per id wins, title and content are joined and cleaned, short texts dropped.
    """
    unique = merge.dedup_first(posts, "post_id", order)
    joined = unique.withColumn("combined_text", tx.combined(F.col("title"), F.col("content")))
    joined = joined.where(F.length("combined_text") > 0)
    cleaned = joined.withColumn("model_text", tx.light_clean(F.col("combined_text")))
    kept = cleaned.where(tx.word_count(F.col("model_text")) >= min_words)
    return embedding.tfidf_vectors(kept, "model_text", features)


def question_context(
    talk: DataFrame, hits: DataFrame, entities: DataFrame, *, keep: int = 5, limit: float = 0.85, budget: float = 8192.0
) -> DataFrame:
    """What a model is given for every user message of ``talk(query_id, conv_id, turn, role, text)``.

    ``hits(query_id, passage_id, content, sentiment, score, embedding)`` are re-ranked for variety, entity notes
    and passages joined, and earlier messages dropped in pairs until all of it fits the token budget:
    (query_id, history_summary, context, entity_notes, repetition_note, n_kept, history).
    """
    passages = retrieval.rerank_diverse(hits, keep, limit, carry=("content",))
    summary = conversation.history_summary(talk).select("conv_id", "turn", "history_summary")
    turns = conversation.repeat_counts(talk).select("query_id", "conv_id", "turn", "repeats").join(summary, ["conv_id", "turn"])
    # Read twice: for its size and for the result.
    context = staged(retrieval.assemble_context(turns, passages, entities), "context")
    given = tx.token_estimate(F.concat_ws(" ", "context", "entity_notes", "repetition_note"))
    sized = talk.join(context.select("query_id", given.alias("_given")), "query_id", "left")
    cost = F.col("_given") + tx.token_estimate(F.col("text"))
    kept = conversation.kept_history(sized, cost, budget, texts=True)
    ids = talk.select("query_id", "conv_id", "turn")
    return context.join(ids.join(kept, ["conv_id", "turn"]).select("query_id", "n_kept", "history"), "query_id")


@dataclass
class TopicModel:
    """Tables of a fitted model; every table carries the category as key."""

    documents: DataFrame
    centroids: DataFrame
    terms: DataFrame
    quality: DataFrame


def fit_topics(
    docs: DataFrame,
    config: DataFrame,
    *,
    eps: float | None = None,
    dims: int = 5,
    min_samples: int = 10,
    min_cluster_size: int = 30,
    outlier_threshold: float = 0.5,
    stop: Sequence[str] = (),
    unwanted: DataFrame | None = None,
    candidates: int = 30,
    k: int = 10,
    merge_above: float | None = None,
) -> TopicModel:
    """Reduce, cluster, reassign outliers, weigh terms and score, for all categories in one go.

    ``docs(doc_id, category, text, embedding)``; ``config(category, min_df, max_df)``, and where it
    has them ``min_samples`` and ``min_cluster_size`` per category. Stop terms of a category come as
    ``unwanted(category, term)``. ``merge_above`` joins topics whose centroids are that similar.
    """
    own = config if {"min_samples", "min_cluster_size"} <= set(config.columns) else None
    points = staged(clusters.reduce_dims(docs, dims), "points")
    if eps is None:
        eps = clusters.choose_eps(points, [0.02 * 1.25**i for i in range(24)], min_samples, dims=dims)
    found = clusters.density_clusters(points, eps, min_samples, min_cluster_size, dims=dims, config=own).drop("reduced")
    if merge_above is not None:
        found = clusters.merge_similar_topics(found, merge_above).drop("topic").withColumnRenamed("merged_topic", "topic")
    first = clusters.centroids(found, ["category", "topic"])
    settled = clusters.reassign_outliers(clusters.membership_probs(found, first), outlier_threshold)
    settled = staged(settled.drop("topic", "topic_ids").withColumnRenamed("new_topic", "topic"), "assigned")

    per_topic = topics.ngram_counts(settled, ["category", "topic"], "text", stop)
    per_topic = staged(per_topic, "terms")
    overall = per_topic.groupBy("category", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    sized = settled.groupBy("category").agg(F.count("*").alias("n_docs"))
    allowed = topics.vocabulary(overall, sized, config, unwanted)
    weights = topics.class_tfidf(per_topic.join(allowed, ["category", "term"]).drop("df"))
    ranked = staged(topics.top_terms(weights, k=candidates).drop("rank", "tf"), "candidates")
    centres = clusters.centroids(settled, ["category", "topic"])
    vectors = topics.term_vectors(settled, ranked, "text", stop)
    terms = staged(topics.mmr_terms(ranked.join(vectors, ["category", "topic", "term"]), centres, k=k), "chosen")

    lists = topics.topic_word_lists(terms)
    coherent = coherence.coherence_cv(settled, lists, "doc_id", "text").groupBy("category").agg(F.avg("coherence").alias("coherence"))
    quality = (
        topics.topic_diversity(terms)
        .join(coherent, "category", "left")
        .join(clusters.silhouette_cosine(settled), "category", "left")
    )
    return TopicModel(settled, centres, terms, quality)


def subtopic_graph(model: TopicModel, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the fitted topics of all categories."""
    nodes = staged(graph.build_nodes(model.documents, model.terms, names), "nodes")
    return nodes, graph.build_edges(nodes)
