"""Local moving with aggregation: modularity, local optimality, both forms, and awkward graphs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from forumlens.operators import communities


def planted(seed, n=40, groups=4):
    rng = random.Random(seed)
    edges = {}
    for a, b in itertools.combinations(range(n), 2):
        p = 0.5 if a % groups == b % groups else 0.06
        if rng.random() < p:
            edges[a, b] = round(rng.uniform(0.2, 1.0), 3)
    return edges


def quality(edges, own):
    total = sum(edges.values())
    names = {x for e in edges for x in e}
    degree = {x: sum(w * ((a == x) + (b == x)) for (a, b), w in edges.items()) for x in names}
    inside = sum(w for (a, b), w in edges.items() if own[a] == own[b])
    sums = {}
    for x in names:
        sums[own[x]] = sums.get(own[x], 0) + degree[x]
    return inside / total - sum(s * s for s in sums.values()) / (4 * total * total)


def frame(spark, edges):
    return spark.createDataFrame([(f"n{a:03d}", f"n{b:03d}", w) for (a, b), w in edges.items()], "src string, dst string, weight double")


def labels(df):
    return {int(r["id"][1:]): r["community"] for r in df.collect()}


def test_no_worse_than_greedy_merging_and_no_move_gains():
    for seed in range(12):
        edges = planted(seed, 24 + seed, 2 + seed % 4)
        names = sorted({x for e in edges for x in e})
        number = {x: i for i, x in enumerate(names)}
        g = communities.Graph(len(names), {(number[a], number[b]): w for (a, b), w in edges.items()})
        own = g.communities()
        value = quality(edges, dict(zip(names, own)))
        assert value == pytest.approx(g.modularity(own))
        assert value >= quality(edges, dict(zip(names, g.merged()))) - 1e-9
        # Each step of moving raises modularity.
        assert g.modularity(g.moved(list(range(g.n)))) >= g.modularity(list(range(g.n))) - 1e-9
        for i in range(g.n):
            for c in {own[j] for j in g.near[i]}:
                assert g.modularity([c if j == i else x for j, x in enumerate(own)]) <= g.modularity(own) + 1e-9


def test_optimum_of_tiny_graphs():
    def partitions(n):
        for code in itertools.product(*[range(i + 1) for i in range(n)]):
            if all(c <= max(code[:i], default=-1) + 1 for i, c in enumerate(code)):
                yield code

    for seed in range(6):
        edges = planted(seed, 7, 2)
        n = 7
        g = communities.Graph(n, edges)
        best = max(g.modularity(list(p)) for p in partitions(n))
        assert g.modularity(g.communities()) >= best - 0.02


def test_spark_forms(spark):
    edges = planted(3)
    got = labels(communities.level_communities(frame(spark, edges).repartition(3), "weight"))
    sizes = [list(got.values()).count(c) for c in range(max(got.values()) + 1)]
    assert sizes == sorted(sizes, reverse=True) and set(got) == {x for e in edges for x in e}


def test_rounds_of_a_graph_in_tables(spark):
    edges = planted(5, 10, 2)
    got = labels(communities.level_communities(frame(spark, edges), "weight", whole_links=0))
    alone = {x: x for e in edges for x in e}
    assert set(got) == set(alone) and quality(edges, got) > quality(edges, alone)
    assert quality(edges, got) >= 0.8 * quality(edges, labels(communities.level_communities(frame(spark, edges), "weight")))


def test_awkward_graphs(spark):
    none = spark.createDataFrame([], "src string, dst string, weight double")
    assert communities.level_communities(none, "weight").count() == 0
    odd = spark.createDataFrame([("n000", "n001", 0.0), ("n001", "n000", None), ("n002", "n002", 0.0)], "src string, dst string, weight double")
    assert sorted(labels(communities.level_communities(odd, "weight")).values()) == [0, 1, 2]
    loops = spark.createDataFrame([("n000", "n000", 1.0), ("n000", "n001", 2.0), ("n001", "n000", 1.0)], "src string, dst string, weight double")
    assert len(labels(communities.level_communities(loops.withColumn("a", F.lit(1)), "weight"))) == 2
