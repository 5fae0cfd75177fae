"""Density hierarchy against a version that walks down all thresholds on the full distance matrix."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from forumlens.operators import density


def components(d, own, below):
    """Components of the points ``own`` under edges shorter than ``below``."""
    near, left, out = d[np.ix_(own, own)] < below, np.ones(len(own), bool), []
    while left.any():
        seen = np.zeros(len(own), bool)
        todo = np.zeros(len(own), bool)
        todo[np.argmax(left)] = True
        while todo.any():
            seen |= todo
            todo = near[todo].any(axis=0) & ~seen
        left &= ~seen
        out.append([own[i] for i in np.flatnonzero(seen)])
    return out


def tree_lengths(d):
    """Edge lengths of a spanning tree: components change nowhere else."""
    if len(d) < 2:
        return []
    near, out, inside = d[0].copy(), [], {0}
    while len(inside) < len(d):
        near[list(inside)] = np.inf
        i = int(np.argmin(near))
        out.append(float(near[i]))
        inside.add(i)
        near = np.minimum(near, d[i])
    return out


def brute(x, min_samples, least):
    """(topic as a frozen set of points or None, probability) per point."""
    n = len(x)
    d = density.distances(x, x)
    core = np.array([np.sort(np.delete(d[i], i))[min(min_samples, n - 1) - 1] if n > 1 else 0.0 for i in range(n)])
    d = np.maximum(np.maximum(d, core[:, None]), core[None, :])
    levels = sorted(set(tree_lengths(d)), reverse=True)
    leave, clusters = {}, []

    def walk(own, birth, parent, start):
        me = {"own": own, "birth": birth, "sum": 0.0, "kids": [], "death": 0.0}
        clusters.append(me)
        if parent:
            parent["kids"].append(me)
        for at in range(start, len(levels)):
            parts = components(d, own, levels[at])
            if len(parts) == 1:
                continue
            near = 1 / max(levels[at], density.LEAST)
            big = [p for p in parts if len(p) >= least]
            me["death"] = near
            for p in parts:
                if p not in big:
                    leave.update({i: (me, near) for i in p})
                    me["sum"] += near * len(p)
            if len(big) == 1:
                own = big[0]
                continue
            me["sum"] += near * sum(map(len, big))
            for p in big:
                walk(p, near, me, at + 1)
            return

    if n >= least:
        walk(list(range(n)), 0.0, None, 0)

    def best(c):
        kids = sum(best(k) for k in c["kids"])
        stable = round(c["sum"] - len(c["own"]) * c["birth"], 6)
        c["chosen"] = stable >= round(kids, 6)
        return max(stable, kids)

    def tops(c, root):
        if c["chosen"] and not root:
            return [c]
        return [t for k in c["kids"] for t in tops(k, False)]

    out = [(None, 0.0)] * n
    if clusters:
        best(clusters[0])
        for c in tops(clusters[0], True):
            for i in c["own"]:
                out[i] = (frozenset(c["own"]), min(leave[i][1], c["death"]) / c["death"])
    return out


def clumps(seed, n, spread=0.4, grid=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(scale=4, size=(5, 2))
    x = centres[rng.integers(0, 5, n)] + rng.normal(scale=spread, size=(n, 2)) * rng.choice([0.3, 1.0, 3.0], n)[:, None]
    return np.round(x * 2) / 2 if grid else x


CASES = {"plain": clumps(1, 120), "ties": clumps(2, 500, 0.6, True), "few": clumps(3, 6), "one": clumps(4, 1), "copies": np.repeat(clumps(5, 20), 6, axis=0)}


@pytest.mark.parametrize("merge_edges", [density.MERGE_EDGES, 60])
def test_topics_and_probabilities_match_brute_force(spark, monkeypatch, merge_edges):
    monkeypatch.setattr(density, "BLOCK_ROWS", 64)
    monkeypatch.setattr(density, "SLICE_ROWS", 100)
    rows, want = [], {}
    for name, x in CASES.items():
        for i, (v, w) in enumerate(zip(x, brute(x, 4, 8))):
            rows.append((f"{name}-{i:03d}", name, v.tolist(), 5))
            want[f"{name}-{i:03d}"] = (None if w[0] is None else frozenset(f"{name}-{j:03d}" for j in w[0]), w[1])
    rows.append(("lost", "plain", None, 5))
    want["lost"] = (None, 0.0)
    points = spark.createDataFrame(rows, "doc_id string, category string, reduced array<double>, n int").repartition(3)
    got = density.density_hierarchy(points, 4, 8, merge_edges=merge_edges).collect()
    assert len(got) == len(rows)
    groups = {}
    for r in got:
        groups.setdefault((r["category"], r["topic"]), set()).add(r["doc_id"])
    for r in got:
        topic, p = want[r["doc_id"]]
        assert (r["topic"] == -1) == (topic is None), r
        assert topic is None or groups[r["category"], r["topic"]] == topic
        assert r["probability"] == pytest.approx(p, abs=1e-9)
    # Numbered by size.
    for name in CASES:
        sizes = [len(groups[name, t]) for t in sorted(t for c, t in groups if c == name and t >= 0)]
        assert sizes == sorted(sizes, reverse=True)
    assert {t for c, t in groups if c == "ties"} - {-1}


@pytest.mark.parametrize("whole", [10, 1000])
def test_spanning_tree_has_the_least_length(spark, monkeypatch, whole):
    monkeypatch.setattr(density, "BLOCK_ROWS", 32)
    monkeypatch.setattr(density, "SLICE_ROWS", 50)
    monkeypatch.setattr(density, "WHOLE_ROWS", whole)
    x = np.unique(clumps(7, 150, grid=True), axis=0)
    nodes = spark.createDataFrame([("+", i, 1, v.tolist()) for i, v in enumerate(x)], "g string, node long, n long, vector array<double>")
    nodes = density.core_distances(nodes, 3)
    core = {r["node"]: r["core"] for r in nodes.collect()}
    d = density.distances(x, x)
    assert all(core[i] == np.sort(d[i])[3] for i in range(len(x)))
    d = np.maximum(np.maximum(d, np.array([core[i] for i in range(len(x))])[:, None]), np.array([core[i] for i in range(len(x))])[None, :])
    edges = density.spanning_tree(nodes).collect()
    inside, total = {0}, 0.0
    while len(inside) < len(x):
        rest = [i for i in range(len(x)) if i not in inside]
        sub = d[np.ix_(sorted(inside), rest)]
        total += sub.min()
        inside.add(rest[int(np.argmin(sub.min(axis=0)))])
    assert len(edges) == len(x) - 1 and sum(r["d"] for r in edges) == pytest.approx(total)


def test_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, category string, reduced array<double>")
    assert density.density_hierarchy(none, 3, 5).count() == 0


def test_rounds_do_not_square_the_size_estimate(spark):
    """A chain of 600 clusters takes ten rounds of joining the table with itself."""
    rows = [("", f"c{i}", f"c{i + 1}" if i < 599 else None, i == 598, 1.0) for i in range(600)]
    clusters = spark.createDataFrame(rows, "g string, cluster string, parent string, chosen boolean, death double")
    tops = density.chosen_ancestors(clusters)
    assert {r["top"] for r in tops.collect()} == {"c598"} and tops.count() == 599
    assert tops._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 64


def test_only_near_blocks_meet(spark, monkeypatch):
    """A grid of 900 nodes in blocks of 25: what is within 1 of a block lies in a few blocks around it."""
    monkeypatch.setattr(density, "BLOCK_ROWS", 25)
    monkeypatch.setattr(density, "SLICE_ROWS", 300)
    rows = [("+", 30 * i + j, [float(i), float(j)]) for i in range(30) for j in range(30)]
    nodes = density._laid(spark.createDataFrame(rows, "g string, node long, vector array<double>"))
    sizes = {r["b"]: r["count"] for r in nodes.groupBy("b").count().collect()}
    assert max(sizes.values()) <= 25 and sum(sizes.values()) == 900 and len(sizes) < 60
    boxes = density._boxes(nodes).selectExpr("g", "b", "box", "1.0D AS reach", "CAST(NULL AS bigint) AS one")
    met = {(r["b"], r["other"]) for r in density.near_blocks(boxes).collect()}
    at = {r["node"]: r["b"] for r in nodes.collect()}
    needed = {(at[30 * i + j], at[30 * k + m]) for i in range(30) for j in range(30) for k, m in ((i + 1, j), (i, j + 1)) if k < 30 and m < 30}
    assert {p for p in needed if p[0] != p[1]} <= met
    assert len(met) < len(sizes) * (len(sizes) - 1) / 3


def test_missing_numbers_leave_other_core_distances_alone(spark, monkeypatch):
    monkeypatch.setattr(density, "BLOCK_ROWS", 16)
    x = np.unique(clumps(11, 60), axis=0)
    rows = [("+", i, 1, v.tolist()) for i, v in enumerate(x)] + [("+", 99, 3, [None, None])]
    nodes = spark.createDataFrame(rows, "g string, node long, n long, vector array<double>")
    got = {r["node"]: r["core"] for r in density.core_distances(nodes, 4).collect()}
    d = density.distances(x, x)
    assert {i: got[i] for i in range(len(x))} == {i: np.sort(d[i])[4] for i in range(len(x))}
    assert np.isnan(got[99]) and len(got) == len(x) + 1
    monkeypatch.setattr(density, "WHOLE_ROWS", 10)
    tree = density.spanning_tree(density.core_distances(nodes, 4)).collect()
    assert len(tree) == len(x) - 1 and 99 not in {r[c] for r in tree for c in ("src", "dst")}
