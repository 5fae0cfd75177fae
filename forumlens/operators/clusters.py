"""Density clusters, memberships and cluster quality, keyed by category."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.functions.vectors import cosine, dot, l2_normalize, softmax
from forumlens.operators.rows import tied
from forumlens.operators.sizing import broadcast_if_small, hint_for
from forumlens.session import cut, staged


def reduce_dims(df: DataFrame, k: int, vector: str = "embedding", to: str = "reduced") -> DataFrame:
    """Principal components; the covariance is summed in the tasks, only a d x d matrix is collected."""
    features = df.withColumn("_f", array_to_vector(F.col(vector).cast("array<double>")))
    model = PCA(k=k, inputCol="_f", outputCol="_p").fit(features)
    return model.transform(features).withColumn(to, vector_to_array("_p")).drop("_f", "_p")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): smallest id reachable. ``edges`` must hold both directions.

    Labels are lowered along edges and then by pointer jumping; every round is written and read back, so
    the plan stays flat, and the stop test is a single count. A checkpoint would keep the size estimate of its
    plan, and labels that meet themselves in every round square it until planning takes minutes.
    """
    links = staged(edges.select("src", "dst").where(F.col("src") != F.col("dst")), "links")
    labels = staged(nodes.select("id", F.col("id").alias("component")), "labels")
    small = hint_for(labels.count())
    while True:
        heard = (
            links.join(small(labels.withColumnRenamed("id", "dst")), "dst")
            .groupBy(F.col("src").alias("id"))
            .agg(F.min("component").alias("_m"))
        )
        lowered = labels.join(small(heard), "id", "left").select(
            "id", F.col("component").alias("_old"), F.least("component", F.coalesce("_m", "component")).alias("component")
        )
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("_next"))
        new = staged(
            lowered.join(small(jump), "component").select("id", "_old", F.least("component", "_next").alias("component")), "labels"
        )
        moved = new.where(F.col("_old") != F.col("component")).limit(1).count()
        labels = new.drop("_old")
        if not moved:
            return labels


def cell_of(point: Column, eps: float, dims: int) -> Column:
    """Grid cell with diagonal ``eps``: any two points of a cell are within ``eps``."""
    side = eps / math.sqrt(dims)
    return F.transform(point, lambda x: F.floor(x / F.lit(side)))


def _near_offsets(dims: int) -> list[tuple[int, ...]]:
    """Steps between cells whose centres lie within ``eps`` (squared length up to ``dims``)."""
    reach = math.isqrt(dims)
    return [o for o in product(range(-reach, reach + 1), repeat=dims) if sum(x * x for x in o) <= dims]


def cluster_cells(cells: DataFrame, keys: Sequence[str], dims: int) -> DataFrame:
    """Density clusters over counted grid cells: (keys, cell, topic), -1 for noise.

    ``cells`` carries keys, ``cell``, ``n``, ``min_samples`` and ``min_cluster_size``. A cell is
    dense when it and its near cells hold at least ``min_samples`` points; near dense cells form
    clusters; small clusters become noise. Cells meet by an equi-join over a fixed set of steps,
    so the pairs per cell are bounded by geometry, whatever the number of points in a cell.
    """
    name = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.array_join(F.col("cell").cast("array<string>"), ","))
    named = cut(cells.withColumn("id", name))
    steps = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in o]) for o in _near_offsets(dims)])
    near = named.select(*keys, F.col("id").alias("src"), F.explode(steps).alias("_o"), "cell", "min_samples").select(
        *keys, "src", "min_samples", F.zip_with("cell", "_o", lambda a, b: a + b).alias("cell")
    )
    pairs = cut(near.join(named.select(*keys, "cell", F.col("id").alias("dst"), "n"), [*keys, "cell"]).select("src", "dst", "n", "min_samples"))
    dense = cut(
        pairs.groupBy("src").agg(F.sum("n").alias("_near"), F.first("min_samples").alias("_need"))
        .where(F.col("_near") >= F.col("_need")).select(F.col("src").alias("id"))
    )
    linked = (
        pairs.select("src", "dst")
        .join(dense.withColumnRenamed("id", "src"), "src", "left_semi")
        .join(dense.withColumnRenamed("id", "dst"), "dst", "left_semi")
    )
    found = named.join(connected_components(dense, linked), "id")
    sizes = found.groupBy(*keys, "component").agg(F.sum("n").alias("_size"), F.first("min_cluster_size").alias("_least"))
    # One row per cluster: numbering by size needs no window over points.
    order = Window.partitionBy(*keys).orderBy(F.desc("_size"), F.asc("component"))
    topics = sizes.where(F.col("_size") >= F.col("_least")).select("component", (F.row_number().over(order) - 1).alias("topic"))
    labelled = found.select("id", "component").join(topics, "component").select("id", "topic")
    return named.join(labelled, "id", "left").select(*keys, "cell", "n", F.coalesce("topic", F.lit(-1)).alias("topic"))


def density_clusters(
    points: DataFrame,
    eps: float,
    min_samples: int,
    min_cluster_size: int,
    *,
    dims: int,
    category: str = "category",
    vector: str = "reduced",
    config: DataFrame | None = None,
) -> DataFrame:
    """Adds ``topic`` to every point: clusters numbered by size within the category, -1 for noise.

    ``config(category, min_samples, min_cluster_size)`` overrides both numbers for the categories it
    lists, one row each; a null keeps the common number.
    """
    placed = points.withColumn("cell", cell_of(F.col(vector), eps, dims))
    cells = placed.groupBy(category, "cell").agg(F.count("*").alias("n"))
    common = {"min_samples": F.lit(min_samples), "min_cluster_size": F.lit(min_cluster_size)}
    if config is None:
        cells = cells.withColumns(common)
    else:
        own = config.select(F.col("category").alias(category), *[F.col(c).alias(f"_{c}") for c in common])
        cells = cells.join(own, category, "left")
        cells = cells.withColumns({c: F.coalesce(f"_{c}", v) for c, v in common.items()}).drop(*[f"_{c}" for c in common])
    topics = cluster_cells(cells, [category], dims).drop("n")
    return placed.join(broadcast_if_small(topics), [category, "cell"]).drop("cell")


def choose_eps(
    points: DataFrame, ladder: Sequence[float], min_samples: int, *, dims: int, share: float = 0.5, vector: str = "reduced"
) -> float:
    """Smallest candidate at which at least ``share`` of the points sit in a cell of ``min_samples``.

    All candidates are counted in one pass; one number per candidate reaches the driver.
    """
    level = F.explode(
        F.array(*[F.struct(F.lit(e).alias("eps"), cell_of(F.col(vector), e, dims).alias("cell")) for e in ladder])
    )
    counted = points.select(level.alias("l")).groupBy("l.eps", "l.cell").agg(F.count("*").alias("n"))
    shares = counted.groupBy("eps").agg(
        (F.sum(F.when(F.col("n") >= min_samples, F.col("n")).otherwise(0)) / F.sum("n")).alias("share")
    )
    enough = sorted(r["eps"] for r in shares.collect() if r["share"] >= share)
    if enough or not shares.take(1):
        return enough[0] if enough else max(ladder)
    # None is wide enough: the next candidates go on from the largest, up to one cell for all.
    wider = [max(ladder) * 1.25**i for i in range(1, len(ladder) + 1)]
    if wider[0] > 1e6:
        raise ValueError(f"no radius puts a share of {share} of the points into cells of {min_samples}")
    return choose_eps(points, wider, min_samples, dims=dims, share=share, vector=vector)


def centroids(df: DataFrame, keys: Sequence[str], vector: str = "embedding", to: str = "centroid") -> DataFrame:
    """Mean vector and row count per group; partial means are merged, no vector is exploded."""
    features = df.withColumn("_f", array_to_vector(F.col(vector).cast("array<double>")))
    return features.groupBy(*keys).agg(
        F.count("*").alias("n"), vector_to_array(Summarizer.mean(F.col("_f"))).alias(to)
    )


# A difference of 0.1 in cosine makes a topic e times as likely.
TEMPERATURE = 0.1


def _topic_lists(df: DataFrame, category: str, fields: Sequence[str]) -> DataFrame:
    """Topics of a category as one ordered array (one row per category)."""
    return df.groupBy(category).agg(F.sort_array(F.collect_list(F.struct("topic", *fields))).alias("_topics"))


def _vector_values(field: str) -> Column:
    return F.aggregate("_topics", F.lit(0), lambda s, t: s + F.size(t[field]))


def membership_probs(
    docs: DataFrame, centres: DataFrame, *, category: str = "category", vector: str = "embedding", temperature: float = TEMPERATURE
) -> DataFrame:
    """``probs``: softmax of cosine / temperature over the topics of the category, ordered by topic.

    Cosines lie within 2 of each other, so without the temperature no topic among many could ever
    reach one half.
    """
    lists = _topic_lists(centres.where(F.col("topic") != -1), category, ["centroid"])
    lists = broadcast_if_small(lists, values=_vector_values("centroid"))
    lists = lists.withColumnRenamed(category, "_route")
    joined = docs.withColumn("_route", tied(category, vector)).join(lists, "_route", "left").drop("_route")
    near = F.transform("_topics", lambda t: cosine(F.col(vector), t["centroid"]))
    return (
        joined.withColumn("topic_ids", F.col("_topics.topic"))
        .withColumn("probs", softmax(F.transform(near, lambda s: s / temperature)))
        .drop("_topics")
    )


def reassign_outliers(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """An outlier takes its most probable topic if that probability reaches the threshold."""
    best = F.array_max("probs")
    likely = F.get("topic_ids", (F.array_position("probs", best) - 1).cast("int"))
    return docs.withColumn(
        "new_topic", F.when((F.col("topic") == -1) & (best >= threshold), likely).otherwise(F.col("topic"))
    )


def merge_similar_topics(
    docs: DataFrame, threshold: float = 0.9, *, category: str = "category", vector: str = "embedding"
) -> DataFrame:
    """Topics of a category whose centroids reach the cosine ``threshold``, directly or over others, become one.

    Adds ``merged_topic``: merged topics numbered by size, then by their smallest old number; -1 stays.
    Only topics are compared, whose number does not grow with the documents.
    """
    centres = centroids(docs.where(F.col("topic") != -1), [category, "topic"], vector)
    named = cut(centres.withColumn("id", F.concat_ws("|", F.col(category).cast("string"), F.format_string("%012d", "topic"))))
    other = named.select(F.col(category), F.col("id").alias("dst"), F.col("centroid").alias("_c"))
    near = named.withColumnRenamed("id", "src").join(other, category).where(F.col("src") != F.col("dst"))
    near = near.where(cosine(F.col("centroid"), F.col("_c")) >= threshold).select("src", "dst")
    joined = named.join(connected_components(named.select("id"), near), "id")
    sizes = joined.groupBy(category, "component").agg(F.sum("n").alias("_size"))
    order = Window.partitionBy(category).orderBy(F.desc("_size"), F.asc("component"))
    numbers = sizes.select("component", (F.row_number().over(order) - 1).alias("merged_topic"))
    mapping = joined.join(numbers, "component").select(category, "topic", "merged_topic")
    return docs.join(broadcast_if_small(mapping), [category, "topic"], "left").withColumn(
        "merged_topic", F.coalesce("merged_topic", F.lit(-1))
    )


def silhouette_cosine(docs: DataFrame, *, category: str = "category", vector: str = "embedding") -> DataFrame:
    """Mean cosine silhouette per category without outliers; 0 with fewer than two topics.

    The mean cosine distance of x to a cluster is 1 - x.(sum of the cluster)/N, so each document
    meets one array of cluster sums instead of the other documents.
    """
    kept = docs.where(F.col("topic") != -1).select(category, "topic", l2_normalize(F.col(vector)).alias("_x"))
    sums = centroids(kept, [category, "topic"], "_x", "_mean")
    lists = broadcast_if_small(_topic_lists(sums, category, ["n", "_mean"]), values=_vector_values("_mean"))
    lists = lists.withColumnRenamed(category, "_route")
    joined = kept.withColumn("_route", tied(category, "_x")).join(lists, "_route")
    near = F.transform(
        "_topics",
        lambda t: F.struct(
            (t["topic"] == F.col("topic")).alias("own"), t["n"].alias("n"), (1 - dot(F.col("_x"), t["_mean"])).alias("d")
        ),
    )
    placed = joined.select(category, near.alias("_d"))
    own = F.get(F.filter("_d", lambda t: t["own"]), 0)
    a = own["d"] * own["n"] / F.nullif(own["n"] - 1, F.lit(0))
    b = F.array_min(F.transform(F.filter("_d", lambda t: ~t["own"]), lambda t: t["d"]))
    # Clusters of identical vectors are at distance 0 from themselves and each other: 0, not an error.
    score = F.when((own["n"] == 1) | b.isNull(), F.lit(0.0)).otherwise(F.coalesce((b - a) / F.nullif(F.greatest(a, b), F.lit(0.0)), F.lit(0.0)))
    return placed.groupBy(category).agg(F.avg(score).alias("silhouette"))
