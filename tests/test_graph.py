"""Graph and rank statistics on graphs with known answers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from forumlens.operators import graph, stats
from forumlens.operators.evaluation import ndcg_at_k

TRIANGLES = [(1, 2), (1, 3), (2, 3), (4, 5), (4, 6), (5, 6), (3, 4)]


@pytest.fixture(scope="module")
def triangles(spark):
    nodes = spark.createDataFrame([(i, "x" if i <= 3 else "y") for i in range(1, 8)], "id int, label string")
    edges = spark.createDataFrame([(a, b, 1.0) for a, b in TRIANGLES], "src int, dst int, w double")
    return nodes, edges


def test_modularity_and_assortativity(triangles):
    nodes, edges = triangles
    labelled = graph.with_labels(edges, nodes)
    assert graph.modularity(labelled).first()[0] == pytest.approx(5 / 14)
    assert graph.assortativity(labelled).first()[0] == pytest.approx(5 / 7)
    single = graph.with_labels(edges, nodes.withColumn("label", F.lit("z")))
    assert graph.modularity(single).first()[0] == pytest.approx(0.0)
    assert graph.assortativity(single).first()[0] == 0.0
    assert graph.assortativity(labelled, F.col("w") * 0).first()[0] == 0.0


def test_graph_stats_and_isolated_nodes(triangles):
    nodes, edges = triangles
    row = graph.graph_stats(nodes, edges).first()
    assert (row["nodes"], row["edges"]) == (6, 7) and row["density"] == pytest.approx(7 / 21)
    assert graph.connected_nodes(nodes, edges).count() == 6


@pytest.mark.parametrize("exact", [True, False])
def test_greedy_communities_find_the_triangles(triangles, exact):
    nodes, edges = triangles
    found = {r["id"]: r["community"] for r in graph.greedy_communities(edges, "w", exact).collect()}
    assert found == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1}
    table = graph.community_crosstab(nodes, graph.greedy_communities(edges, "w", exact)).collect()
    assert {(r["label"], r["community"], r["nodes"]) for r in table} == {("x", 0, 3), ("y", 1, 3)}


def brute_greedy(edges):
    """Merge the best pair while modularity rises."""
    total = sum(w for *_, w in edges)
    groups = {v: v for a, b, _ in edges for v in (a, b)}

    def gain(c, d):
        between = sum(w for a, b, w in edges if {groups[a], groups[b]} == {c, d})
        if not between:
            return -1.0
        k = lambda g: sum(w * ((groups[a] == g) + (groups[b] == g)) for a, b, w in edges)
        return between / total - k(c) * k(d) / (2 * total * total)

    while True:
        names = sorted(set(groups.values()))
        best = max(((round(gain(c, d), 15), -c, -d) for i, c in enumerate(names) for d in names[i + 1 :]), default=(-1,))
        if best[0] <= 1e-12:
            return groups
        groups = {v: -best[1] if g == -best[2] else g for v, g in groups.items()}


def test_greedy_communities_equal_a_plain_loop(spark):
    rnd = random.Random(9)
    edges = [(a, b, round(rnd.uniform(0.1, 1), 3)) for a in range(12) for b in range(a + 1, 12) if rnd.random() < (0.8 if a % 3 == b % 3 else 0.15)]
    df = spark.createDataFrame(edges, "src int, dst int, w double")
    found = {r["id"]: r["community"] for r in graph.greedy_communities(df, "w").collect()}
    want = brute_greedy(edges)
    assert {(a, b) for a in found for b in found if found[a] == found[b]} == {(a, b) for a in want for b in want if want[a] == want[b]}


def test_every_pair_once(spark):
    nodes = spark.range(23).select("id", F.lit("l").alias("label"))
    for blocks in (1, 3, 8):
        pairs = [(r["src"], r["dst"]) for r in graph.all_pairs(nodes, ["label"], blocks).collect()]
        assert sorted(pairs) == [(a, b) for a in range(23) for b in range(a + 1, 23)]


def test_minmax_weights(spark):
    edges = spark.createDataFrame([(1, 2, 0.2, 0.5), (1, 3, 0.4, 0.5)], "src int, dst int, original_sim double, coherence double")
    got = {r["dst"]: r["nor_weight"] for r in graph.minmax_weights(edges).collect()}
    assert got == {2: 0.0, 3: 1.0}


def test_single_linkage_merges(spark):
    rnd = random.Random(1)
    d = {(a, b): rnd.random() for a in range(9) for b in range(a + 1, 9)}
    edges = spark.createDataFrame([(a, b, w) for (a, b), w in d.items()], "src int, dst int, d double")
    got = [(r["src"], r["dst"]) for r in graph.single_linkage(edges, "d").orderBy("step").collect()]
    group, want = {v: v for v in range(9)}, []
    for (a, b), _ in sorted(d.items(), key=lambda e: e[1]):
        if group[a] != group[b]:
            want.append((a, b))
            old = group[b]
            group = {v: group[a] if g == old else g for v, g in group.items()}
    assert got == want


def test_null_model_keeps_degrees_and_seed(triangles):
    nodes, edges = triangles
    first = graph.null_model_test(nodes, edges, 50).first()
    again = graph.null_model_test(nodes.repartition(5), edges.repartition(3), 50).first()
    assert first["p"] == again["p"] and first["null_mean"] == pytest.approx(again["null_mean"])
    assert first["observed"] == pytest.approx(5 / 14) and 0 <= first["p"] <= 0.3


def ranks_of(values):
    s = sorted(values)
    return [(s.index(v) + 1 + len(s) - s[::-1].index(v)) / 2 for v in values]


@pytest.mark.parametrize("buckets", [2, 5, 64])
def test_ranks_with_ties(spark, buckets):
    rnd = random.Random(buckets)
    values = [float(rnd.choice([0, 0, 0, 1, 2, 3.5, rnd.random()])) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["value"]: r["avg_rank"] for r in stats.rank_table(df, "v", buckets=buckets).collect()}
    assert [got[v] for v in values] == ranks_of(values)
    row = stats.value_summary(df, "v").first()
    s = sorted(values)
    assert row["median"] == pytest.approx((s[149] + s[150]) / 2)


def test_mann_whitney_and_delta(spark):
    rows = [(1.0, True), (2.0, True), (3.0, True), (1.0, False), (2.0, False), (2.0, False)]
    df = spark.createDataFrame(rows, "v double, x boolean")
    row = stats.mann_whitney(df, "v", F.col("x")).first()
    assert row["u_x"] == 5.5 and row["u_y"] == 3.5
    delta = stats.cliffs_delta(df, "v", F.col("x")).first()
    assert delta["delta"] == pytest.approx(2 / 9) and delta["effect"] == "Small effect"


@pytest.mark.parametrize("z", [-8.0, -3.2, -0.1, 0.0, 0.4, 1.96, 5.0, 7.5, 12.0])
def test_normal_tail(spark, z):
    got = spark.range(1).select(stats.normal_tail(F.lit(z))).first()[0]
    assert got == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-9)


def test_permutation_test_is_seeded(triangles):
    nodes, edges = triangles
    once = stats.permutation_test(nodes, edges, "w", 40).first()
    valued = edges.withColumn("w", F.when(F.col("src") == 3, 0.1).otherwise(F.lit(1.0)))
    first = stats.permutation_test(nodes, valued, "w", 60).first()
    assert once["observed"] == pytest.approx(0.0)
    again = stats.permutation_test(nodes.repartition(4), valued.repartition(3), "w", 60).first()
    assert first["p"] == again["p"] and first["mean_shuffled"] == pytest.approx(again["mean_shuffled"])
    assert first["observed"] == pytest.approx(0.9)


def test_ndcg(spark):
    rows = [(1, 1, 1.0), (1, 2, 0.5), (1, 3, 0.0), (2, 1, 0.0), (2, 2, 1.0), (3, 1, 0.0)]
    df = spark.createDataFrame(rows, "q int, rank int, rel double")
    got = {r["q"]: r["ndcg"] for r in ndcg_at_k(df, ["q"], "rank", "rel").collect()}
    assert got[1] == pytest.approx(1.0) and got[2] == pytest.approx(1 / math.log2(3)) and got[3] == 0.0
