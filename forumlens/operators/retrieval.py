"""Batch retrieval: pooled variants, re-ranking, entity matches, prompt context, entity trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions.text import hypothetical_document, query_variants
from forumlens.functions.vectors import cosine
from forumlens.operators.counts import top_k
from forumlens.operators.rows import pos_exploded
from forumlens.operators.search import top_inner_product
from forumlens.session import cut

# Order of sentiments in re-ranking; anything else comes last.
SENTIMENT_ORDER = ["positive", "neutral", "negative"]
REPEAT_NOTE = "This message has now come {times} times. Say so kindly and answer in another way than before."
REPEAT_MORE = " Name a person or service to turn to."
PASSAGE_SEPARATOR = "\n\n---\n\n"


def with_fallback_category(queries: DataFrame, corpus: DataFrame, fallback: str = "general") -> DataFrame:
    """A category without passages is replaced by the fallback category."""
    known = corpus.select("category").distinct().withColumn("_known", F.lit(True))
    return (
        queries.join(known, "category", "left")
        .withColumn("category", F.when(F.col("_known"), F.col("category")).otherwise(F.lit(fallback)))
        .drop("_known")
    )


def variant_texts(asked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, variant_no, text) to embed and search, by ``strategy``.

    original: the query; multi: usable lines of the reply without the query (three fixed variants
    when too few); hyde: the reply as a hypothetical answer.
    """
    texts = (
        F.when(F.col("strategy") == "multi", query_variants(F.col("query"), F.col("reply")))
        .when(F.col("strategy") == "hyde", F.array(hypothetical_document(F.col("reply"))))
        .otherwise(F.array("query"))
    )
    return pos_exploded(asked, keys, texts, "variant_no", "text")


def retrieve(
    variants: DataFrame,
    corpus: DataFrame,
    k: int = 10,
    *,
    dedup_key: str = "passage_id",
    carry: Sequence[str] = (),
    fallback: str = "general",
) -> DataFrame:
    """Pool the hits of all variants of a query by best score and keep the top k.

    ``variants(query_id, variant_no, category, embedding)`` holds one row for the plain query or a
    hypothetical answer and several for generated variants; hits stay within the category.
    """
    routed = with_fallback_category(variants, corpus, fallback).withColumn("_routes", F.array("category"))
    columns = list(dict.fromkeys(["passage_id", dedup_key, *carry]))
    hits = top_inner_product(
        routed, corpus, k, query_keys=("query_id", "variant_no"), carry=columns, route="category", routes="_routes"
    )
    # At most (variants x k) rows per query are left here.
    best = hits.groupBy("query_id", dedup_key).agg(
        F.min_by(F.struct(*[c for c in columns if c != dedup_key], "score"), F.struct(-F.col("score"), "passage_id")).alias("h")
    )
    flat = best.select("query_id", dedup_key, "h.*")
    return top_k(flat, ["query_id"], [F.desc("score"), F.asc("passage_id")], k)


def sentiment_rank(sentiment: Column) -> Column:
    out = F.lit(len(SENTIMENT_ORDER))
    for place, name in reversed(list(enumerate(SENTIMENT_ORDER))):
        out = F.when(sentiment == name, F.lit(place)).otherwise(out)
    return out


def rerank_diverse(hits: DataFrame, keep: int = 5, limit: float = 0.85, carry: Sequence[str] = ()) -> DataFrame:
    """Sentiment order, then score; a hit too close to a kept one is dropped; first ``keep`` stay.

    ``hits`` holds at most k rows per query, so the greedy pass is a fold over one small array.
    Queries without hits simply have no rows.
    """
    item = F.struct(
        sentiment_rank(F.col("sentiment")).alias("place"),
        (-F.col("score")).alias("minus_score"),
        "passage_id",
        "sentiment",
        "embedding",
        *carry,
    )
    grouped = hits.groupBy("query_id").agg(F.sort_array(F.collect_list(item)).alias("found"))
    none = F.slice("found", 1, 0)

    def take(kept: Column, h: Column) -> Column:
        # A zero vector is close to nothing.
        close = F.exists(kept, lambda o: cosine(h["embedding"], o["embedding"]) > limit)
        return F.when(close, kept).otherwise(F.array_append(kept, h))

    kept = F.slice(F.aggregate("found", none, take), 1, keep)
    return grouped.select("query_id", F.posexplode(kept).alias("rank", "h")).select(
        "query_id",
        (F.col("rank") + 1).alias("rank"),
        "h.passage_id",
        "h.sentiment",
        (-F.col("h.minus_score")).alias("score"),
        *[F.col(f"h.{c}") for c in carry],
    )


def match_entities(queries: DataFrame, entities: DataFrame, k: int = 4, threshold: float = 0.7, carry: Sequence[str] = ()) -> DataFrame:
    """Top k entities per query, kept only above the threshold."""
    hits = top_inner_product(queries, entities, k, carry=["entity_id", *carry])
    return hits.where(F.col("score") > threshold)


def repetition_note(repeats: Column, note: str = REPEAT_NOTE, more: str = REPEAT_MORE) -> Column:
    """Empty up to the first repeat, then ``note`` with the count in place of ``{times}``, then ``more`` too."""
    base = F.replace(F.lit(note), F.lit("{times}"), (repeats + 1).cast("string"))
    return F.when(repeats <= 1, F.lit("")).otherwise(F.concat(base, F.when(repeats >= 2, F.lit(more)).otherwise(F.lit(""))))


def assemble_context(turns: DataFrame, passages: DataFrame, entities: DataFrame) -> DataFrame:
    """One row per question: passages, history summary, repetition note and entity notes joined.

    ``turns(query_id, history_summary, repeats)``; ``passages(query_id, rank, content)``;
    ``entities(query_id, rank, name, code, description)``. Both lists are short per question.
    """
    joined = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("rank", c.alias("t")))), lambda s: s["t"])
    texts = passages.groupBy("query_id").agg(F.array_join(joined(F.col("content")), PASSAGE_SEPARATOR).alias("context"))
    note = F.concat_ws(
        "\n", F.concat(F.lit("Disorder Name: "), "name"), F.concat(F.lit("Disorder Code: "), "code"),
        F.concat(F.lit("Disorder symptoms: "), "description"),
    )
    notes = entities.groupBy("query_id").agg(F.array_join(joined(note), "\n\n").alias("entity_notes"))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return (
        turns.join(texts, "query_id", "left")
        .join(notes, "query_id", "left")
        .select(
            "query_id", "history_summary", blank("context"), blank("entity_notes"),
            repetition_note(F.col("repeats")).alias("repetition_note"),
        )
    )


def leaf_entities(entities: DataFrame, root: DataFrame, max_depth: int = 10) -> DataFrame:
    """Leaves below the roots that carry a code and are no chapter or block heading.

    ``entities(entity_id, parent_id, code, title)``. One join per level; each level is written to
    the scratch folder, so the plan does not grow with the depth.
    """
    level = cut(entities.join(root.select("entity_id"), "entity_id", "left_semi"))
    seen = level
    for _ in range(max_depth):
        parents = level.select(F.col("entity_id").alias("parent_id"))
        level = cut(entities.join(parents, "parent_id", "left_semi").select(*entities.columns))
        if level.isEmpty():
            break
        seen = seen.unionByName(level)
    inner = entities.where(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("entity_id"))
    leaves = seen.join(inner, "entity_id", "left_anti")
    titled = (F.coalesce("code", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != "")
    heading = F.col("title").startswith("Chapter") | F.col("title").startswith("Block")
    return leaves.where(titled & ~heading)
