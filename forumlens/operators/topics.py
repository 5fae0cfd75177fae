"""n-gram vocabularies, class-based TF-IDF, topic words and topic reports, keyed by category."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from forumlens.functions.text import remove_stop_words, tokenize
from forumlens.operators.counts import top_k
from forumlens.operators.evaluation import word_ngrams
from forumlens.operators.ngrams import counted_runs, packed_runs
from forumlens.operators.rows import exploded
from forumlens.operators.sizing import broadcast_if_small
from forumlens.session import staged


def _tokens(text: str, stop: Sequence[str]) -> Column:
    """Lower-case words of two or more characters, stop words left out."""
    return remove_stop_words(tokenize(F.lower(F.col(text)), 2), stop)


def with_ngrams(docs: DataFrame, text: str, stop: Sequence[str], n_max: int, to: str) -> DataFrame:
    """1- to n-grams of the lower-case words of two or more characters, stop words left out first.

    The tokens are a column of their own, so the n-gram lambdas do not tokenise again per element.
    """
    tokens = docs.withColumn("_tok", _tokens(text, stop))
    grams = F.flatten(F.array(*[word_ngrams(F.col("_tok"), n) for n in range(1, n_max + 1)]))
    return tokens.withColumn(to, grams).drop("_tok")


def ngram_counts(
    docs: DataFrame, keys: Sequence[str], text: str, stop: Sequence[str] = (), n_max: int = 3
) -> DataFrame:
    """(keys, term, tf, df) in one shuffle."""
    parcels = packed_runs(docs, keys, _tokens(text, stop), text, n_max, keys)
    return counted_runs(parcels, keys, n_max, keys).drop("_total")


def vocabulary(
    counts: DataFrame, doc_counts: DataFrame, config: DataFrame, unwanted: DataFrame | None = None
) -> DataFrame:
    """(category, term) within the category's document-frequency limits, minus unwanted n-grams.

    ``config(category, min_df, max_df)``: at least min_df documents, at most the share max_df.
    """
    limits = broadcast_if_small(doc_counts.join(config, "category"))
    kept = (
        counts.join(limits, "category")
        .where((F.col("df") >= F.col("min_df")) & (F.col("df") <= F.col("max_df") * F.col("n_docs")))
        .select("category", "term")
    )
    return kept if unwanted is None else kept.join(unwanted.select("category", "term"), ["category", "term"], "left_anti")


def _weighed(counts: DataFrame, per_topic: DataFrame, keys: Sequence[str], dampen: bool) -> DataFrame:
    """Weights from counts with ``_total`` (of the term, all topics) and ``per_topic(keys, topic, _words)``."""
    per_topic = per_topic.withColumn("_mean", F.floor(F.avg("_words").over(Window.partitionBy(*keys))))
    joined = counts.join(broadcast_if_small(per_topic), [*keys, "topic"])
    share = F.col("tf") / F.col("_words")
    weight = (F.sqrt(share) if dampen else share) * F.log1p(F.col("_mean") / F.col("_total"))
    return joined.select(*keys, "topic", "term", "tf", weight.alias("weight"))


def class_tfidf(counts: DataFrame, keys: Sequence[str] = ("category",), dampen: bool = True) -> DataFrame:
    """Weight of a term in a topic: f(share of the topic's words) x ln(1 + A / total frequency).

    ``counts`` has keys, topic, term, tf; A is the mean number of words per topic, rounded down;
    f is the square root when frequent words are dampened. The windows hold at most one row per
    topic, since the input is already counted. The counts are written once, as they are read twice.
    """
    counts = staged(counts, "term-counts")
    per_topic = counts.groupBy(*keys, "topic").agg(F.sum("tf").alias("_words"))
    total = F.sum("tf").over(Window.partitionBy(*keys, "term"))
    return _weighed(counts.withColumn("_total", total), per_topic, keys, dampen)


def document_tfidf(
    docs: DataFrame, text: str, stop: Sequence[str] = (), n_max: int = 3, keys: Sequence[str] = ("category",), dampen: bool = True
) -> DataFrame:
    """``class_tfidf`` of all n-grams of ``docs(keys, topic, text)``, without writing the counts.

    Packed runs are written once, as they are read twice: for the number of n-grams of every topic, which a
    parcel states, and for the counts. Terms are dealt whatever their topic, so totals need no shuffle of their own.
    """
    of_topic = [*keys, "topic"]
    parcels = staged(packed_runs(docs, of_topic, _tokens(text, stop), text, n_max, keys), "runs")
    sizes = parcels.select(F.explode(F.arrays_zip("keys", "grams")).alias("_k")).select("_k.keys.*", "_k.grams")
    per_topic = sizes.groupBy(*of_topic).agg(F.sum("grams").alias("_words"))
    return _weighed(counted_runs(parcels, of_topic, n_max, keys).drop("df"), per_topic, keys, dampen)


def top_terms(weights: DataFrame, keys: Sequence[str] = ("category",), k: int = 10) -> DataFrame:
    """Ordered topic words; weights are compared on 12 digits so that equal ones fall back to the term.

    Each task first keeps the k best of a topic in a bounded queue, so that the ranking sorts only those.
    """
    groups = [*keys, "topic"]
    others = [F.col(c) for c in weights.columns if c not in groups]
    order = [(-F.round("weight", 12)).alias("_order"), F.col("term").alias("_term")]
    best = weights.groupBy(*groups).agg(InternalFunction.collect_top_k(F.struct(*order, F.struct(*others).alias("_row")), k, True).alias("_best"))
    kept = best.select(*groups, F.explode("_best").alias("_b")).select(*groups, "_b._row.*")
    return top_k(kept.select(*weights.columns), groups, [F.desc(F.round("weight", 12)), F.asc("term")], k)


def term_vectors(docs: DataFrame, candidates: DataFrame, text: str, stop: Sequence[str] = (), n_max: int = 3) -> DataFrame:
    """Mean vector of the topic's documents that contain a candidate term.

    Each document meets the short candidate list of its topic; only matching terms are exploded.
    """
    lists = candidates.groupBy("category", "topic").agg(F.collect_list("term").alias("_terms"))
    lists = broadcast_if_small(lists, values=F.size("_terms"))
    grams = with_ngrams(docs.join(lists, ["category", "topic"]), text, stop, n_max, "_g")
    vector = array_to_vector(F.col("embedding").cast("array<double>")).alias("_f")
    found = exploded(grams, ["category", "topic", vector], F.array_intersect("_g", "_terms"), "term")
    return found.groupBy("category", "topic", "term").agg(vector_to_array(Summarizer.mean(F.col("_f"))).alias("vector"))


def mmr_terms(candidates: DataFrame, centres: DataFrame, diversity: float = 0.3, k: int = 10) -> DataFrame:
    """Of up to 30 weighted candidates per topic, the k chosen by maximal marginal relevance.

    ``candidates(category, topic, term, weight, vector)``; chosen terms keep their weight order.
    The choice is sequential but a group is one short candidate list.
    """

    def unit(m: np.ndarray) -> np.ndarray:
        size = np.linalg.norm(m, axis=-1, keepdims=True)
        return m / np.where(size == 0, 1, size)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["weight", "term"], ascending=[False, True]).reset_index(drop=True)
        terms = unit(np.array(group["vector"].tolist(), dtype=float))
        relevance = np.round(terms @ unit(np.array(group["centroid"][0], dtype=float)), 12)
        chosen = [int(relevance.argmax())]
        while len(chosen) < min(k, len(group)):
            redundancy = np.round(terms @ terms[chosen].T, 12).max(axis=1)
            score = (1 - diversity) * relevance - diversity * redundancy
            score[chosen] = -np.inf
            chosen.append(int(score.argmax()))
        out = group.iloc[sorted(chosen)].copy()
        out["rank"] = np.arange(1, len(out) + 1, dtype="int32")
        return out[["category", "topic", "term", "weight", "rank"]]

    centres = broadcast_if_small(centres.select("category", "topic", "centroid"), values=F.size("centroid"))
    joined = candidates.join(centres, ["category", "topic"])
    kinds = {f.name: f.dataType.simpleString() for f in candidates.schema.fields}
    schema = f"category {kinds['category']}, topic {kinds['topic']}, term string, weight double, rank int"
    return joined.groupBy("category", "topic").applyInPandas(choose, schema)


def topic_diversity(terms: DataFrame, keys: Sequence[str] = ("category",), k: int = 10, exclude_outlier: bool = False) -> DataFrame:
    """Distinct words of the real topics over (number of topics x k); outliers count as a topic below the line."""
    real = F.col("topic") != -1
    topics = F.count_distinct(F.when(real, F.col("topic")) if exclude_outlier else F.col("topic"))
    words = F.count_distinct(F.when(real & (F.col("rank") <= k), F.col("term")))
    return terms.groupBy(*keys).agg((words / (topics * k)).alias("diversity"))


def topic_word_lists(terms: DataFrame, keys: Sequence[str] = ("category",), k: int = 10) -> DataFrame:
    """Top n-grams split into words, repeated words dropped, order kept."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", "term")))
    lists = terms.where((F.col("topic") != -1) & (F.col("rank") <= k)).groupBy(*keys, "topic").agg(ordered.alias("_t"))
    split = F.flatten(F.transform("_t", lambda s: F.split(s["term"], " ")))
    return lists.select(*keys, "topic", F.array_distinct(split).alias("words"))


def topic_info(assignments: DataFrame, terms: DataFrame) -> DataFrame:
    """Topic, name made of its first four words, document count and word list."""
    counted = assignments.groupBy("category", "topic").agg(F.count("*").alias("doc_count"))
    ordered = terms.groupBy("category", "topic").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_t"))
    words = F.transform("_t", lambda s: s["term"])
    name = F.concat_ws("_", F.col("topic").cast("string"), F.slice(words, 1, 4))
    return counted.join(ordered, ["category", "topic"], "left").select(
        "category", "topic", name.alias("name"), "doc_count", F.array_join(words, ", ").alias("words")
    )


# Settled settings per display label; stop lists are a table (category, term) of the caller.
CATEGORY_SETTINGS = [
    ("Anxiety", 1, 0.5, 15, 60, 40),
    ("Depression", 1, 0.5, 15, 60, 40),
    ("PTSD and trauma", 1, 0.4, 15, 40, 40),
    ("Suicidal thoughts and self-harm", 1, 0.45, 15, 55, 39),
]
SETTINGS_SCHEMA = "category string, min_df int, max_df double, n_neighbors int, min_cluster_size int, min_samples int"


def category_config(categories: DataFrame, settings: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """Settings of every category that occurs, with defaults where none are listed."""
    known = categories.select("category").distinct().join(settings, "category", "left")
    return known.select(
        "category", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in defaults.items()]
    )
