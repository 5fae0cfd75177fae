"""Communities by local moving and graph aggregation, level by level (Blondel et al. 2008).

A graph whose links fit one task, as graphs of topics do, is solved there at once. A larger one is moved in
rounds: half of the nodes, another half every round, choose the neighbouring community that gains
most, and a round counts only if modularity rises; when none does, communities become the nodes of
the next level. Either way modularity never falls.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import cut

# Links that one task takes, and nodes from which merging pair by pair is left out.
WHOLE_LINKS = 200_000
MERGED_NODES = 1_000
# Gains below this are rounding.
TINY = 1e-12


class Graph:
    """Weighted links between nodes 0 .. n-1 in memory; a link of a node to itself counts twice in its degree."""

    def __init__(self, n: int, links: dict[tuple[int, int], float]) -> None:
        self.n, self.links = n, links
        self.near: list[dict[int, float]] = [{} for _ in range(n)]
        self.degree = [0.0] * n
        for (a, b), w in links.items():
            self.degree[a] += w
            self.degree[b] += w
            if a != b:
                self.near[a][b] = self.near[b][a] = w
        self.total = sum(links.values())

    def modularity(self, own: list[int]) -> float:
        inside, sums = 0.0, defaultdict(float)
        for (a, b), w in self.links.items():
            inside += w * (own[a] == own[b])
        for i, c in enumerate(own):
            sums[c] += self.degree[i]
        return inside / self.total - sum(s * s for s in sums.values()) / (4 * self.total**2) if self.total else 0.0

    def moved(self, own: list[int]) -> list[int]:
        """Nodes in turn go to the neighbouring community that gains most, until none gains."""
        own, sums = list(own), defaultdict(float)
        for i, c in enumerate(own):
            sums[c] += self.degree[i]
        changed = self.total > 0
        while changed:
            changed = False
            for i in range(self.n):
                at, k = own[i], self.degree[i]
                to: dict[int, float] = defaultdict(float)
                for j, w in self.near[i].items():
                    to[own[j]] += w
                sums[at] -= k
                gain = lambda c: to.get(c, 0.0) - k * sums[c] / (2 * self.total)  # noqa: E731, B023
                best = min(to, key=lambda c: (-round(gain(c), 12), c), default=at)
                if best != at and gain(best) > gain(at) + TINY * self.total:
                    own[i], changed = best, True
                sums[own[i]] += k
        return own

    def aggregated(self, own: list[int]) -> tuple[Graph, list[int]]:
        """Communities as nodes, and the new node of every old one."""
        number = {c: i for i, c in enumerate(sorted(set(own)))}
        names = [number[c] for c in own]
        links: dict[tuple[int, int], float] = defaultdict(float)
        for (a, b), w in self.links.items():
            links[min(names[a], names[b]), max(names[a], names[b])] += w
        return Graph(len(number), dict(links)), names

    def merged(self) -> list[int]:
        """Greedy merging of the best pair, again and again (Clauset, Newman and Moore 2004)."""
        graph, own = self, list(range(self.n))
        while graph.total:
            pairs = [(w / graph.total - graph.degree[a] * graph.degree[b] / (2 * graph.total**2), -a, -b) for (a, b), w in graph.links.items() if a != b]
            best = max(((round(g, 15), a, b) for g, a, b in pairs), default=(0.0, 0, 0))
            if best[0] <= TINY:
                break
            graph, names = graph.aggregated([-best[1] if c == -best[2] else c for c in range(graph.n)])
            own = [names[c] for c in own]
        return own

    def levels(self, own: list[int]) -> list[int]:
        """Moving and aggregation from a start until neither changes anything."""
        while True:
            own = self.moved(own)
            graph, names = self.aggregated(own)
            above = graph.moved(list(range(graph.n)))
            if len(set(above)) == graph.n:
                return names
            own = [above[c] for c in names]

    def communities(self) -> list[int]:
        """The better of two starts: nodes alone and, for small graphs, the greedy merge."""
        starts = [list(range(self.n))] + ([self.merged()] if self.n <= MERGED_NODES else [])
        return max((self.levels(s) for s in starts), key=lambda own: round(self.modularity(own), 12))


def _whole(rows: pd.DataFrame) -> pd.DataFrame:
    names = sorted(set(rows["a"]) | set(rows["b"]))
    number = {x: i for i, x in enumerate(names)}
    own = Graph(len(names), {(number[a], number[b]): w for a, b, w in zip(rows["a"], rows["b"], rows["w"])}).communities()
    first: dict[int, int] = {}
    for i, c in enumerate(own):
        first.setdefault(c, i)
    return pd.DataFrame({"id": names, "community": [names[first[c]] for c in own]}).astype({"id": rows["a"].dtype, "community": rows["a"].dtype})


def _modularity(links: DataFrame, labels: DataFrame, total: float) -> float:
    a, b = (labels.select(F.col("id").alias(c), F.col("community").alias(f"c{c}")) for c in ("a", "b"))
    met = links.join(a, "a").join(b, "b")
    inside = met.agg(F.coalesce(F.sum(F.when(F.col("ca") == F.col("cb"), F.col("w"))), F.lit(0.0))).first()[0]
    ends = met.select(F.explode(F.array(F.struct(F.col("ca").alias("c"), "w"), F.struct(F.col("cb").alias("c"), "w"))).alias("e"))
    squares = ends.groupBy("e.c").agg(F.sum("e.w").alias("s")).agg(F.sum(F.col("s") * F.col("s"))).first()[0]
    return inside / total - squares / (4 * total * total)


def _proposed(links: DataFrame, labels: DataFrame, total: float, half: int) -> DataFrame:
    """Labels after the nodes of one half took their best neighbouring community."""
    both = links.where("a != b").select("a", "b", "w").unionByName(links.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("id"), "w"), F.struct(F.col("b").alias("id"), "w"))).alias("e"))
    degree = ends.groupBy("e.id").agg(F.sum("e.w").alias("k"))
    known = labels.join(degree, "id")
    sums = known.groupBy("community").agg(F.sum("k").alias("s"))
    movers = known.where(F.pmod(F.xxhash64("id", F.lit(half // 2)), F.lit(2)) == half % 2)
    to = both.join(labels.select(F.col("id").alias("b"), F.col("community").alias("to")), "b").groupBy("a", "to").agg(F.sum("w").alias("w"))
    options = movers.join(to, F.col("id") == F.col("a")).join(sums.withColumnRenamed("community", "to"), "to")
    other = F.when(F.col("to") == F.col("community"), F.col("s") - F.col("k")).otherwise(F.col("s"))
    gain = F.round(F.col("w") - F.col("k") * other / (2 * total), 12)
    alone = movers.join(sums, "community").select("id", F.round(-F.col("k") * (F.col("s") - F.col("k")) / (2 * total), 12).alias("stay"))
    # Of equal gains the own community, then the smallest.
    choice = F.struct((-gain).alias("g"), (F.col("to") != F.col("community")).alias("o"), F.col("to"))
    best = options.groupBy("id").agg(F.min(choice).alias("b")).join(alone, "id").where(-F.col("b.g") > F.col("stay"))
    return labels.join(best.select("id", F.col("b.to").alias("_to")), "id", "left").select("id", F.coalesce("_to", "community").alias("community"))


def _rounds(links: DataFrame, total: float) -> DataFrame:
    """Labels of a graph in tables: rounds of moves, then the same over communities, until a level changes nothing."""
    ids = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    whole = cut(ids.withColumn("community", F.col("id")))
    level, at = links, whole
    while True:
        labels = at
        value, failed, half = _modularity(level, labels, total), 0, 0
        # Two halves make up all nodes.
        while failed < 2:
            new = cut(_proposed(level, labels, total, half))
            after = _modularity(level, new, total)
            half += 1
            if after > value + TINY:
                labels, value, failed = new, after, 0
            else:
                failed += 1
        if labels.where("id != community").isEmpty():
            return whole
        to = labels.select(F.col("id").alias("community"), F.col("community").alias("_to"))
        whole = cut(whole.join(to, "community").select("id", F.col("_to").alias("community")))
        a, b = (labels.select(F.col("id").alias(c), F.col("community").alias(f"c{c}")) for c in ("a", "b"))
        joined = level.join(a, "a").join(b, "b")
        level = cut(joined.groupBy(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.sum("w").alias("w")))
        at = cut(labels.select(F.col("community").alias("id")).distinct().withColumn("community", F.col("id")))


def level_communities(edges: DataFrame, weight: str, whole_links: int = WHOLE_LINKS) -> DataFrame:
    """(id, community) with communities numbered by size, then by their smallest id.

    Repeated edges add up; an edge of a node to itself counts; null or zero weights count as none, and
    a graph without weight leaves every node alone. Nodes without an edge are not known here.
    """
    links = edges.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    links = cut(links.agg(F.coalesce(F.sum(F.col(weight).cast("double")), F.lit(0.0)).alias("w")))
    size = links.agg(F.count("*").alias("n"), F.coalesce(F.sum("w"), F.lit(0.0)).alias("w")).first()
    kind = links.schema["a"].dataType.simpleString()
    if size["n"] <= whole_links:
        # A bounded number of links.
        found = links.groupBy().applyInPandas(lambda rows: _whole(rows), f"id {kind}, community {kind}")
    elif not size["w"]:
        found = links.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("community", F.col("id"))
    else:
        found = _rounds(links, size["w"])
    members = found.groupBy("community").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    # One row per community.
    numbers = members.select("community", (F.row_number().over(Window.orderBy(F.desc("n"), "least")) - 1).alias("_no"))
    return found.join(numbers, "community").select("id", F.col("_no").alias("community"))
