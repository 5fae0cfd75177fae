"""Subtopic graphs: nodes, weighted edges, mixing statistics, null models and communities."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.functions.vectors import cosine
from forumlens.operators.clusters import centroids, connected_components
from forumlens.operators.coherence import pair_coherence
from forumlens.operators.counts import topic_counts
from forumlens.operators.merge import named
from forumlens.operators.sizing import hint_for
from forumlens.operators.stats import in_trials, p_verdict, seeded_order
from forumlens.session import cut


def build_nodes(docs: DataFrame, terms: DataFrame, names: DataFrame, k: int = 10) -> DataFrame:
    """One node per topic: name or "category_topic", keywords, share of the category, mean vector.

    ``docs(category, topic, embedding)``; ``terms(category, topic, term, rank)``; outliers left out.
    """
    sizes = topic_counts(docs.select("category", "topic")).where(F.col("topic") != -1)
    centres = centroids(docs.where(F.col("topic") != -1), ["category", "topic"]).drop("n")
    ordered = F.sort_array(F.collect_list(F.struct("rank", "term")))
    words = terms.where(F.col("rank") <= k).groupBy("category", "topic").agg(ordered.alias("_t"))
    nodes = sizes.join(centres, ["category", "topic"]).join(words, ["category", "topic"], "left")
    fallback = F.concat_ws("_", "category", F.col("topic").cast("string"))
    nodes = named(nodes, names, ["category", "topic"], fallback)
    keywords = F.coalesce(F.transform("_t", lambda s: s["term"]), F.array().cast("array<string>"))
    return nodes.select(
        fallback.alias("id"), F.col("category").alias("label"), "topic", "name", keywords.alias("words"),
        F.array_join(keywords, ", ").alias("keywords"), F.col("relative_size").alias("size"), "doc_count", "centroid",
    )


def all_pairs(nodes: DataFrame, columns: Sequence[str], blocks: int = 8) -> DataFrame:
    """Every unordered pair of nodes once, ``src < dst``, with ``columns`` of both ends (_u, _v).

    The complete graph is the result asked for, and nodes are topics, not documents. Nodes meet in
    an equi-join on pairs of hash blocks: work is spread evenly and neither side is broadcast.
    """
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    others = F.sequence(F.lit(0), F.lit(blocks - 1))
    keys = F.transform(others, lambda x: F.struct(F.least(own, x).alias("lo"), F.greatest(own, x).alias("hi")))
    spread = nodes.select("id", *columns, own.alias("_b"), F.explode(keys).alias("_k"))
    u = spread.select("_k", F.col("_b").alias("_bu"), F.col("id").alias("src"), *[F.col(c).alias(f"{c}_u") for c in columns])
    v = spread.select("_k", F.col("_b").alias("_bv"), F.col("id").alias("dst"), *[F.col(c).alias(f"{c}_v") for c in columns])
    # Two nodes of one block share several keys; they count under the key of their own blocks only.
    home = (F.least("_bu", "_bv") == F.col("_k.lo")) & (F.greatest("_bu", "_bv") == F.col("_k.hi"))
    return u.join(v, "_k").where((F.col("src") < F.col("dst")) & home).drop("_k", "_bu", "_bv")


def similarity_edges(nodes: DataFrame, vector: str = "centroid", label: str = "label") -> DataFrame:
    pairs = all_pairs(nodes, [vector, label])
    return pairs.select(
        "src", "dst", f"{label}_u", f"{label}_v", cosine(F.col(f"{vector}_u"), F.col(f"{vector}_v")).alias("original_sim")
    )


def build_edges(nodes: DataFrame) -> DataFrame:
    """(src, dst, original_sim, coherence, weight, nor_weight) for every pair of nodes."""
    similar = cut(similarity_edges(nodes))
    keywords = nodes.select(F.col("id").alias("node"), "words")
    coherent = pair_coherence(similar.select("src", "dst"), keywords)
    edges = similar.join(coherent, ["src", "dst"]).withColumn("weight", F.col("coherence") * F.col("original_sim"))
    return minmax_weights(edges)


def minmax_weights(edges: DataFrame) -> DataFrame:
    """Product of both scores scaled to 0..1; a constant score counts as 1."""
    edges = cut(edges)
    bounds = edges.agg(
        F.struct(
            F.min("original_sim").alias("s0"), F.max("original_sim").alias("s1"),
            F.min("coherence").alias("c0"), F.max("coherence").alias("c1"),
        )
    ).scalar()

    def scaled(c: str, lo: str, hi: str) -> Column:
        span = bounds[hi] - bounds[lo]
        return F.when(span == 0, F.lit(1.0)).otherwise((F.col(c) - bounds[lo]) / span)

    return edges.withColumn("nor_weight", scaled("original_sim", "s0", "s1") * scaled("coherence", "c0", "c1"))


def above(edges: DataFrame, value: str, threshold: float) -> DataFrame:
    return edges.where(F.col(value) >= threshold)


def connected_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that keep at least one edge; a plot that shows isolated nodes uses ``nodes`` as is."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return nodes.join(ends, "id", "left_semi")


def with_labels(edges: DataFrame, nodes: DataFrame, label: str = "label") -> DataFrame:
    for end, to in (("src", "label_u"), ("dst", "label_v")):
        edges = edges.join(nodes.select(F.col("id").alias(end), F.col(label).alias(to)), end)
    return edges


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected nodes, edges, and density against all pairs of all nodes."""
    n_all = nodes.agg(F.count("*")).scalar()
    linked = connected_nodes(nodes, edges).agg(F.count("*")).scalar()
    return edges.agg(F.count("*").alias("edges")).select(
        linked.alias("nodes"), "edges", (F.col("edges") / (n_all * (n_all - 1) / 2)).alias("density")
    )


def split_intra_inter(edges: DataFrame, value: str) -> DataFrame:
    kind = F.when(F.col("label_u") == F.col("label_v"), "intra").otherwise("inter")
    return edges.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))


def mixing(edges: DataFrame, weight: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Per key: m (total weight), weight within labels, and the sum of squared label degrees.

    ``edges`` carries label_u and label_v. Modularity and assortativity both follow from these.
    """
    inner = F.when(F.col("label_u") == F.col("label_v"), weight).otherwise(F.lit(0.0))
    ends = F.array(
        F.struct(F.col("label_u").alias("label"), weight.alias("w"), inner.alias("inner")),
        F.struct(F.col("label_v").alias("label"), weight.alias("w"), F.lit(0.0).alias("inner")),
    )
    per_label = (
        edges.select(*keys, F.explode(ends).alias("e"))
        .groupBy(*keys, "e.label")
        .agg(F.sum("e.w").alias("k"), F.sum("e.inner").alias("inner"))
    )
    sums = [
        (F.sum("k") / 2).alias("m"), F.sum("inner").alias("within"), F.sum(F.col("k") * F.col("k")).alias("squares")
    ]
    return per_label.groupBy(*keys).agg(*sums) if keys else per_label.agg(*sums)


def _modularity() -> Column:
    m = F.col("m")
    return F.when(m > 0, F.col("within") / m - F.col("squares") / (4 * m * m)).otherwise(F.lit(0.0))


def modularity(edges: DataFrame, weight: Column | None = None) -> DataFrame:
    """Newman modularity of the labels; no weight means 1 per edge."""
    return mixing(edges, F.lit(1.0) if weight is None else weight).select(_modularity().alias("modularity"))


def assortativity(edges: DataFrame, weight: Column | None = None) -> DataFrame:
    """(tr e - sum a^2) / (1 - sum a^2); 0 without weight or when the denominator is 0."""
    m = F.col("m")
    a2 = F.col("squares") / (4 * m * m)
    r = F.when((m == 0) | m.isNull() | (a2 == 1), F.lit(0.0)).otherwise((F.col("within") / m - a2) / (1 - a2))
    return mixing(edges, F.lit(1.0) if weight is None else weight).select(r.alias("assortativity"))


def null_model_test(nodes: DataFrame, edges: DataFrame, trials: int = 1000, seed: int = 42) -> DataFrame:
    """Modularity against random graphs with the same degrees; unweighted on both sides.

    Stubs are paired in seeded hash order within a trial; double edges and loops are dropped.
    """
    edges = cut(edges.select("src", "dst"))
    degree = edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("deg"))
    stubs = degree.select("id", F.explode(F.sequence(F.lit(1), F.col("deg").cast("int"))).alias("stub"))
    order = Window.partitionBy("trial").orderBy(seeded_order(seed, "trial", "id", "stub"), "id", "stub")
    placed = in_trials(stubs, trials).select("trial", "id", F.floor((F.row_number().over(order) - 1) / 2).alias("pair"))
    drawn = placed.groupBy("trial", "pair").agg(F.min("id").alias("src"), F.max("id").alias("dst"))
    drawn = drawn.where(F.col("src") != F.col("dst")).select("trial", "src", "dst").distinct()
    nulls = mixing(with_labels(drawn, nodes), F.lit(1.0), ["trial"]).select("trial", _modularity().alias("q"))
    observed = modularity(with_labels(edges, nodes))
    seen = F.round(observed.scalar(), 12)
    # A trial that lost all its edges has modularity 0.
    missing = F.lit(trials) - F.count("*")
    reached = F.count_if(F.round("q", 12) >= seen) + F.when(seen <= 0, missing).otherwise(F.lit(0))
    out = nulls.agg((F.sum("q") / trials).alias("null_mean"), (reached / trials).alias("p"))
    return out.withColumn("observed", observed.scalar()).withColumn("verdict", p_verdict(F.col("p")))


def greedy_communities(edges: DataFrame, weight: str, exact: bool = True) -> DataFrame:
    """(id, community) by greedy modularity maximisation, communities numbered by size.

    ``exact`` merges the single best pair per round (Clauset, Newman and Moore 2004); otherwise
    all pairs that are each other's best partner merge at once, which takes few rounds. The state
    is one row per pair of communities (a = b holds the inner weight); each round is checkpointed.
    """
    links = cut(
        edges.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.sum(weight).alias("w"))
    )
    total = links.agg(F.sum("w").alias("m")).first()["m"]
    members = cut(links.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("community", F.col("id")))
    small = hint_for(members.count())
    rounds = 0
    while total:
        gains = _merge_gains(links, total, small)
        if exact:
            best = gains.orderBy(F.desc("gain"), "a", "b").first()
            if best is None:
                break
            into = lambda c, best=best: F.when(F.col(c) == best["b"], F.lit(best["a"])).otherwise(F.col(c))
            renamed = links.select(into("a").alias("a"), into("b").alias("b"), "w")
            members = members.withColumn("community", into("community"))
        else:
            merges = cut(_mutual_best(gains))
            if merges.isEmpty():
                break
            renamed = _renamed(_renamed(links, "a", merges), "b", merges)
            members = _renamed(members, "community", merges)
        links = cut(
            renamed.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("w").alias("w"))
        )
        rounds += 1
        if not exact or rounds % 16 == 0:
            members = cut(members)
    sizes = members.groupBy("community").agg(F.count("*").alias("n"))
    # One row per community.
    numbered = sizes.select("community", (F.row_number().over(Window.orderBy(F.desc("n"), "community")) - 1).alias("_no"))
    return members.join(numbered, "community").select("id", F.col("_no").alias("community"))


def _merge_gains(links: DataFrame, total: float, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Modularity gained by merging each linked pair: w/m - k_a k_b / (2 m^2)."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("c"), "w"), F.struct(F.col("b").alias("c"), "w"))).alias("e")
    degree = links.select(ends).groupBy("e.c").agg(F.sum("e.w").alias("k"))
    k_a = degree.select(F.col("c").alias("a"), F.col("k").alias("k_a"))
    k_b = degree.select(F.col("c").alias("b"), F.col("k").alias("k_b"))
    gain = F.col("w") / total - F.col("k_a") * F.col("k_b") / (2 * total * total)
    pairs = links.where(F.col("a") != F.col("b")).join(small(k_a), "a").join(small(k_b), "b")
    return pairs.select("a", "b", F.round(gain, 15).alias("gain")).where(F.col("gain") > 1e-12)


def _mutual_best(gains: DataFrame) -> DataFrame:
    """(a, b), a < b, where each is the other's best partner."""
    sides = F.array(F.struct("a", "b", "gain"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "gain"))
    order = F.struct(-F.col("gain"), F.least("a", "b"), F.greatest("a", "b"))
    best = gains.select(F.explode(sides).alias("g")).select("g.*").groupBy("a").agg(F.min_by("b", order).alias("b"))
    swapped = best.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return best.join(swapped, ["a", "b"], "left_semi").where(F.col("a") < F.col("b"))


def _renamed(df: DataFrame, column: str, merges: DataFrame) -> DataFrame:
    to = merges.select(F.col("b").alias(column), F.col("a").alias("_to"))
    return df.join(to, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")


def community_crosstab(nodes: DataFrame, communities: DataFrame) -> DataFrame:
    """Predefined label against found community, counted."""
    return nodes.join(communities, "id").groupBy("label", "community").agg(F.count("*").alias("nodes"))


def single_linkage(edges: DataFrame, distance: str) -> DataFrame:
    """Merge steps of single-linkage clustering: the minimum spanning forest, ordered by distance.

    Every round each cluster takes its shortest outgoing edge (Boruvka), so a few rounds suffice.
    """
    links = cut(edges.select("src", "dst", F.col(distance).alias("d")))
    nodes = cut(links.select(F.explode(F.array("src", "dst")).alias("id")).distinct())
    labels = nodes.select("id", F.col("id").alias("component"))
    chosen = None
    while True:
        a = labels.select(F.col("id").alias("src"), F.col("component").alias("a"))
        b = labels.select(F.col("id").alias("dst"), F.col("component").alias("b"))
        outer = links.join(a, "src").join(b, "dst").where(F.col("a") != F.col("b"))
        sides = outer.select(F.explode(F.array("a", "b")).alias("c"), F.struct("d", "src", "dst").alias("e"))
        best = cut(sides.groupBy("c").agg(F.min("e").alias("e")).select("e.*").distinct())
        if best.isEmpty():
            break
        chosen = best if chosen is None else cut(chosen.unionByName(best).distinct())
        both = chosen.select("src", "dst").unionByName(chosen.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        labels = connected_components(nodes, both)
    steps = chosen if chosen is not None else links
    # One row per merge of topics.
    order = Window.orderBy("d", "src", "dst")
    return steps.select(F.row_number().over(order).alias("step"), "src", "dst", F.col("d").alias("distance"))
