"""Density clusters with membership strength: core distances, a spanning tree, and the most stable branches.

Points of one vector are one node with a count. The core distance of a node is the distance to its
``min_samples``-th nearest other point, and two nodes are as far apart as the largest of their distance and both
core distances. The minimum spanning tree of that distance is found exactly: in every round each
component takes its shortest edge to another one. Nodes lie in blocks of neighbours. A block is searched by itself first,
which bounds what is looked for, and then meets only the blocks whose box lies within that bound.
The tree's edges are then joined in order of length, a bounded range at a time. What joins at one length
joins at once, so ties and the choice among equal trees change nothing (Campello, Moulavi and Sander 2013).
Rounds are written and read back: a checkpoint keeps the size estimate of its plan, and a table joined with itself
in every round squares it until the estimate alone fills the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import staged

# Nodes of a block, a meeting holds the distances of two, 8 MB; and nodes that one task lays out in blocks.
BLOCK_ROWS = 1024
SLICE_ROWS = 65_536
# Nodes of a group that one task joins by itself.
WHOLE_ROWS = 4096
# Edges joined by one task; a length shared by more edges is still joined at once.
MERGE_EDGES = 500_000
# Distances are compared on this many decimals; shorter ones than this count as this.
DIGITS = 9
LEAST = 10.0**-DIGITS
# Bounds are widened by this, absolute and relative, since distances are rounded.
SLACK = 1e-8


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between two lists of vectors, summed coordinate by coordinate so that equal vectors are at 0."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        out += (a[:, i, None] - b[None, :, i]) ** 2
    return np.round(np.sqrt(out), DIGITS)


def _rows(flat: pa.StructArray, fields: list[str]) -> dict[str, np.ndarray]:
    out = {f: flat.field(f).to_numpy(zero_copy_only=False) for f in fields}
    out["vector"] = np.asarray(flat.field("vector").flatten(), np.float64).reshape(len(flat), -1)
    return out


def _laid(nodes: DataFrame) -> DataFrame:
    """Adds ``b`` to nodes (g, node, vector, ..): the number of its block among those of the group.

    Nodes are ordered along a curve through their first eight coordinates at most, cut into ranges, and ranges into
    blocks. The order decides only how much is searched.
    """
    dims = min(8, nodes.agg(F.min(F.size("vector"))).first()[0] or 0)
    x = F.slice("vector", 1, dims) if dims else F.array().cast("array<double>")
    bounds = nodes.select(F.posexplode(x).alias("i", "x")).where("x is not null").groupBy("i").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    bounds = sorted((r["i"], r["low"], r["high"]) for r in bounds.collect())
    bits = 62 // max(dims, 1)

    @F.pandas_udf("long")
    def curve(vectors: pd.Series) -> pd.Series:
        place = np.zeros(len(vectors), np.int64)
        if dims:
            table = np.stack(vectors.to_list())
            for i, low, high in bounds:
                cell = np.nan_to_num((table[:, i] - low) / ((high - low) or 1.0)).clip(0, 1) * (2.0**bits - 1)
                for bit in range(bits):
                    place |= ((cell.astype(np.int64) >> bit) & 1) << (bit * dims + i)
        return pd.Series(place)

    parts = max(1, -(-nodes.count() // SLICE_ROWS))
    ranged = nodes.withColumn("_z", curve(x)).repartitionByRange(parts, "g", "_z", "node").withColumn("_p", F.spark_partition_id())
    number = F.row_number().over(Window.partitionBy("g", "_p").orderBy("_z", "node")) - 1
    block = F.col("_p").cast("bigint") * (1 << 32) + F.floor(number / BLOCK_ROWS)
    return staged(staged(ranged, "ranges").withColumn("b", block).drop("_z", "_p"), "laid")


def _boxes(nodes: DataFrame) -> DataFrame:
    """(g, b, box): least and largest value of every coordinate of a block."""
    sides = nodes.select("g", "b", F.posexplode("vector").alias("i", "x")).groupBy("g", "b", "i")
    sides = sides.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    return sides.groupBy("g", "b").agg(F.sort_array(F.collect_list(F.struct("i", "low", "high"))).alias("box"))


def _packed(nodes: DataFrame, fields: list[str]) -> DataFrame:
    return nodes.groupBy("g", "b").agg(F.collect_list(F.struct(*fields, "vector")).alias("rows"))


def _alone(nodes: DataFrame, fields: list[str]) -> DataFrame:
    """Every block with itself, as two lists of rows."""
    own = _packed(nodes.withColumn("reach", F.lit(float("inf"))), [*fields, "reach"])
    return own.select(F.col("rows").alias("left"), F.col("rows").alias("right"))


def near_blocks(boxes: DataFrame) -> DataFrame:
    """(g, b, other): other blocks of the group within ``reach`` of a block (g, b, box, reach, one); blocks of ``one`` same value do not meet.

    One row per block meets another, so this grows with the square of the number of blocks, not of nodes.
    """
    other = boxes.select("g", F.col("b").alias("other"), F.col("box").alias("_box"), F.col("one").alias("_one"))
    apart = F.zip_with("box", "_box", lambda a, b: F.greatest(b["low"] - a["high"], a["low"] - b["high"], F.lit(0.0)))
    gap = F.sqrt(F.aggregate(apart, F.lit(0.0), lambda s, x: s + x * x))
    met = boxes.join(other, "g").where((F.col("b") != F.col("other")) & F.coalesce(F.col("one") != F.col("_one"), F.lit(True)))
    return met.where(gap * (1 - SLACK) - SLACK <= F.col("reach")).select("g", "b", "other")


def _meetings(nodes: DataFrame, boxes: DataFrame, fields: list[str], one: Column) -> DataFrame:
    """Blocks of nodes (g, b, ``fields``, reach, vector) and the blocks within the largest reach of theirs, as two lists of rows."""
    wide = nodes.groupBy("g", "b").agg(F.max("reach").alias("reach"), one.alias("one"))
    pairs = near_blocks(staged(boxes.join(wide, ["g", "b"]), "wide"))
    blocks = staged(_packed(nodes, [*fields, "reach"]), "blocks")
    right = blocks.select("g", F.col("b").alias("other"), F.col("rows").alias("right"))
    return pairs.join(blocks, ["g", "b"]).join(right, ["g", "other"]).select(F.col("rows").alias("left"), "right")


def _within(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """The rows of ``a`` that may find one of ``b`` within their reach, and the rows of ``b`` that any of them may find.

    What cannot be compared, as vectors with missing numbers, stays.
    """

    def near(x: np.ndarray, box: np.ndarray, reach: np.ndarray) -> np.ndarray:
        gap = np.sqrt((np.maximum(np.maximum(box.min(axis=0) - x, x - box.max(axis=0)), 0) ** 2).sum(axis=1))
        return ~(gap * (1 - SLACK) - SLACK > reach)

    own = near(a["vector"], b["vector"], a["reach"])
    if "core" in a:
        own &= ~(a["core"] > a["reach"])
    a = {k: v[own] for k, v in a.items()}
    if own.any():
        reach = a["reach"].max()
        there = near(b["vector"], a["vector"], reach)
        if "core" in b:
            there &= ~(b["core"] > reach)
        b = {k: v[there] for k, v in b.items()}
    return a, b


def core_distances(nodes: DataFrame, min_samples: int) -> DataFrame:
    """Adds ``core`` to nodes (g, node, n, vector); with too few points it is the distance to the farthest."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = _within(*(_rows(batch.column(c).slice(i, 1).flatten(), ["node", "n", "reach"]) for c in (0, 1)))
                if not len(a["node"]) or not len(b["node"]):
                    continue
                d = distances(a["vector"], b["vector"])
                # At most so many distinct neighbours hold the wanted one; a node itself is one of them.
                k = min(min_samples + 1, d.shape[1])
                at = np.argpartition(d, k - 1, axis=1)[:, :k]
                who = np.repeat(np.arange(len(d)), k)
                near = at.ravel()
                others = b["n"][near] - (b["node"][near] == a["node"][who])
                kept = ~(d[who, near] > a["reach"][who])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a["node"][who[kept]]), pa.array(d[who, near][kept]), pa.array(others[kept].astype(np.int64))], names=["node", "d", "others"]
                )

    def reached(found: DataFrame) -> DataFrame:
        # A few rows per node and block.
        summed = F.sum("others").over(Window.partitionBy("node").orderBy("d").rangeBetween(Window.unboundedPreceding, 0))
        return found.withColumn("sum", summed).groupBy("node").agg(F.min(F.when(F.col("sum") >= min_samples, F.col("d"))).alias("core"), F.max("d").alias("far"))

    schema = "node bigint, d double, others bigint"
    laid = _laid(nodes)
    own = staged(_alone(laid, ["node", "n"]).mapInArrow(nearest, schema), "own")
    # No core distance is larger than within the block.
    bound = reached(own).select("node", F.coalesce("core", F.lit(float("inf"))).alias("reach"))
    met = _meetings(staged(laid.join(bound, "node"), "bounded"), _boxes(laid), ["node", "n"], F.lit(None).cast("bigint"))
    found = reached(own.unionByName(met.mapInArrow(nearest, schema)))
    return nodes.join(found.select("node", F.coalesce("core", "far").alias("core")), "node")


def _whole_tree(rows: pd.DataFrame) -> pd.DataFrame:
    """Minimum spanning tree of one small group: the nearest node outside the tree joins it."""
    rows = rows.sort_values("node")
    x, core, name = np.stack(rows["vector"].to_list()).astype(float), rows["core"].to_numpy(), rows["node"].to_numpy()
    near, by, outside, out = np.full(len(x), np.inf), np.zeros(len(x), np.int64), np.ones(len(x), bool), []
    at = 0
    for _ in range(len(x) - 1):
        outside[at] = False
        d = np.maximum(np.maximum(distances(x[at : at + 1], x)[0], core), core[at])
        closer = outside & (d < near)
        near[closer], by[closer] = d[closer], at
        at = int(np.argmin(np.where(outside, near, np.inf)))
        a, b = sorted((int(name[at]), int(name[by[at]])))
        out.append((rows["g"].iloc[0], a, b, near[at]))
    return pd.DataFrame(out, columns=["g", "src", "dst", "d"]).astype({"g": object})


def spanning_tree(nodes: DataFrame) -> DataFrame:
    """Edges (g, src, dst, d) of a minimum spanning tree per group over nodes (g, node, core, vector).

    Groups of at most ``WHOLE_ROWS`` nodes are one task each; larger ones are cut into blocks.
    """
    sized = nodes.join(nodes.groupBy("g").agg(F.count("*").alias("all")), "g")
    columns = "g string, src bigint, dst bigint, d double"
    small = sized.where(F.col("all") <= WHOLE_ROWS).select("g", "node", "core", "vector")
    tree = small.groupBy("g").applyInPandas(_whole_tree, columns)
    large = sized.where(F.col("all") > WHOLE_ROWS).select("g", "node", "core", "vector")
    return tree if large.isEmpty() else tree.unionByName(_tree_of_blocks(staged(large, "large")))


def _shortest_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per component of a block its shortest edge to another component of the block it meets."""
    for batch in batches:
        for i in range(batch.num_rows):
            a, b = _within(*(_rows(batch.column(c).slice(i, 1).flatten(), ["node", "core", "component", "reach"]) for c in (0, 1)))
            if not len(a["node"]) or not len(b["node"]):
                continue
            d = np.maximum(np.maximum(distances(a["vector"], b["vector"]), a["core"][:, None]), b["core"][None, :])
            d[(a["component"][:, None] == b["component"][None, :]) | np.isnan(d)] = np.inf
            best = d.min(axis=1)
            # Of equal edges the one of the smaller ends, so that no circle arises.
            tied = d == best[:, None]
            low, high = np.minimum(a["node"][:, None], b["node"][None, :]), np.maximum(a["node"][:, None], b["node"][None, :])
            none = np.iinfo(np.int64).max
            src = np.where(tied, low, none).min(axis=1)
            last = np.where(tied & (low == src[:, None]), high, none)
            to = last.argmin(axis=1)
            columns = [a["component"], best, src, last[np.arange(len(to)), to], b["component"][to]]
            order = np.lexsort((columns[3], src, best, a["component"]))
            order = order[np.isfinite(best[order])]
            owner = a["component"][order]
            first = order[np.r_[True, owner[1:] != owner[:-1]]] if len(order) else order
            yield pa.RecordBatch.from_arrays([pa.array(c[first]) for c in columns], names=["component", "d", "src", "dst", "other"])


def _tree_of_blocks(nodes: DataFrame) -> DataFrame:
    """In every round each component takes its shortest edge out; so a few rounds suffice."""
    nodes = _laid(nodes)
    boxes = staged(_boxes(nodes), "boxes")
    labels = nodes.select("node", F.col("node").alias("component"))
    tree = None
    fields, schema = ["node", "core", "component"], "component bigint, d double, src bigint, dst bigint, other bigint"
    # Blocks of one and the same component have no edge for each other.
    one = F.when(F.min("component") == F.max("component"), F.min("component"))
    while True:
        held = staged(nodes.join(labels, "node"), "held")
        own = staged(_alone(held, fields).mapInArrow(_shortest_edges, schema), "own")
        # No shortest edge is longer than one inside a block.
        bound = own.groupBy("component").agg(F.min("d").alias("reach"))
        bounded = held.join(bound, "component", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))
        met = _meetings(staged(bounded, "bounded"), boxes, fields, one)
        edges = own.unionByName(met.mapInArrow(_shortest_edges, schema))
        best = staged(edges.groupBy("component").agg(F.min(F.struct("d", "src", "dst", "other")).alias("e")).select("component", "e.*"))
        if best.isEmpty():
            break
        chosen = best.select("src", "dst", "d").distinct()
        tree = chosen if tree is None else tree.unionByName(chosen)
        # Two components that chose each other are a root; all others lead to one.
        back = best.select(F.col("component").alias("other"), F.col("other").alias("back"))
        mutual = (F.col("back") == F.col("component")) & (F.col("component") < F.col("other"))
        to = staged(best.join(back, "other").select("component", F.when(mutual, F.col("component")).otherwise(F.col("other")).alias("to")))
        while True:
            further = to.select(F.col("component").alias("to"), F.col("to").alias("next"))
            new = staged(to.join(further, "to").select("component", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")))
            to = new.drop("moved")
            if new.where("moved").isEmpty():
                break
        labels = staged(labels.join(to, "component").select("node", F.col("to").alias("component")))
    return tree.join(nodes.select("g", F.col("node").alias("src")), "src").select("g", "src", "dst", "d")


class _Joiner:
    """Joins components at ascending distances and records condensed clusters; see ``STATE`` for what a component carries."""

    def __init__(self, states: pd.DataFrame, least: int) -> None:
        self.least = least
        self.state = {s["comp"]: s for s in states.to_dict("records")}
        self.parent = {c: c for c in self.state}
        # Components of the start of this range whose points no cluster holds yet.
        self.loose = {c: ([c] if s["cluster"] is None else []) for c, s in self.state.items()}
        self.given: list[tuple[int, str, float]] = []
        self.ended: list[tuple] = []

    def find(self, c: int) -> int:
        while self.parent[c] != c:
            self.parent[c] = self.parent[self.parent[c]]
            c = self.parent[c]
        return c

    def join(self, edges: list[tuple[int, int]], d: float) -> None:
        """All edges of one distance."""
        near = 1.0 / max(d, LEAST)
        group: dict[int, set[int]] = {}
        for a, b in edges:
            a, b = self.find(a), self.find(b)
            one = group.setdefault(a, {a}) | group.setdefault(b, {b})
            for c in one:
                group[c] = one
        for members in {id(m): m for m in group.values()}.values():
            self._merge(sorted(members), near)

    def _merge(self, members: list[int], near: float) -> None:
        states = [self.state[c] for c in members]
        held = [s for s in states if s["cluster"] is not None]
        size = sum(s["size"] for s in states)
        loose = [c for m in members for c in self.loose[m]]
        n_loose = size - sum(s["size"] for s in held)
        to = members[0]
        new = {"comp": to, "size": size, "cluster": None, "near": 0.0, "death": 0.0, "below": 0.0}
        if len(held) == 1:
            new = {**held[0], "comp": to, "size": size, "near": held[0]["near"] + n_loose * near}
        elif len(held) > 1 or size >= self.least:
            new.update(cluster=f"{to}/{size}", near=size * near, death=near)
            new["below"] = sum(self._end(s, near, new["cluster"]) for s in held)
        if new["cluster"] is not None:
            self.given += [(c, new["cluster"], near) for c in loose]
            loose = []
        for m in members:
            self.parent[m] = to
        self.state[to], self.loose[to] = new, loose

    def _end(self, s: dict, birth: float, parent: str | None) -> float:
        """A cluster that is one branch of a split; gives the best stability in its subtree."""
        stability = round(s["near"] - s["size"] * birth, 6)
        chosen = stability >= round(s["below"], 6)
        self.ended.append((s["cluster"], parent, chosen and parent is not None, s["death"]))
        return max(stability, s["below"])


STATE = "g string, comp bigint, size bigint, cluster string, near double, death double, below double"
EVENT = "g string, kind string, comp bigint, to bigint, size bigint, cluster string, parent string, near double, death double, below double, chosen boolean"


def _joined_range(least: int):
    def run(edges: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in EVENT.split(", ")]
        if edges.empty:
            return pd.DataFrame(columns=columns)
        states = states.astype({"cluster": object}).where(states.notna(), None)
        joiner = _Joiner(states.drop(columns="g"), least)
        edges = edges.sort_values("d", kind="stable")
        ends, lengths = list(zip(edges["a"].tolist(), edges["b"].tolist())), edges["d"].to_numpy()
        border = np.flatnonzero(np.r_[True, lengths[1:] != lengths[:-1], True])
        for i, j in zip(border[:-1].tolist(), border[1:].tolist()):
            joiner.join(ends[i:j], float(lengths[i]))
        rows = [{"kind": "move", "comp": c, "to": joiner.find(c)} for c in joiner.parent]
        rows += [{"kind": "state", **{k: v for k, v in joiner.state[c].items()}} for c in joiner.parent if joiner.find(c) == c]
        rows += [{"kind": "given", "comp": c, "cluster": k, "near": near} for c, k, near in joiner.given]
        rows += [{"kind": "ended", "cluster": k, "parent": p, "chosen": ch, "death": dt} for k, p, ch, dt in joiner.ended]
        group = edges["g"].iloc[0]
        return pd.DataFrame([[group if c == "g" else r.get(c) for c in columns] for r in rows], columns=columns, dtype=object)

    return run


def condensed(nodes: DataFrame, tree: DataFrame, min_cluster_size: int, merge_edges: int = MERGE_EDGES) -> tuple[DataFrame, DataFrame]:
    """Where every node leaves the tree: (node, cluster, near), and the clusters: (g, cluster, parent, chosen, death).

    ``near`` is one over the distance at which the node's points join a cluster. Copies of a vector join each
    other at its core distance. Ranges of edges are joined one after the other per group, groups
    side by side; between them only the state of components is carried.
    """
    own = nodes.where("n > 1").select("g", F.col("node").alias("src"), F.col("node").alias("dst"), F.col("core").alias("d"))
    events = staged(tree.select("g", "src", "dst", "d").unionByName(own), "edges")
    parts = max(1, -(-events.count() // merge_edges))
    # Ranges by (group, distance) never split a distance.
    ranged = events.repartitionByRange(parts, "g", "d").withColumn("part", F.spark_partition_id()) if parts > 1 else events.withColumn("part", F.lit(0))
    ranged = staged(ranged, "ranges")
    turns = ranged.select("g", "part").distinct().withColumn("turn", F.row_number().over(Window.partitionBy("g").orderBy("part")))
    # One row per group and range.
    ranged = ranged.join(F.broadcast(turns), ["g", "part"]) if parts <= 10_000 else ranged.join(turns, ["g", "part"])
    members = nodes.select("g", "node", F.col("node").alias("comp"), F.lit(None).cast("string").alias("cluster"), F.lit(None).cast("double").alias("near"))
    states = nodes.select(
        "g", F.col("node").alias("comp"), F.col("n").alias("size"), F.lit(None).cast("string").alias("cluster"),
        *[F.lit(0.0).alias(c) for c in ("near", "death", "below")],
    )
    ended = None
    for turn in range(1, (turns.agg(F.max("turn")).first()[0] or 0) + 1):
        at = ranged.where(F.col("turn") == turn)
        end = lambda c, name: members.select(F.col("node").alias(c), F.col("comp").alias(name))
        edges = staged(at.join(end("src", "a"), "src").join(end("dst", "b"), "dst").select("g", "a", "b", "d"), "joined")
        touched = edges.select("g", F.explode(F.array("a", "b")).alias("comp")).distinct()
        own = states.join(touched, ["g", "comp"], "left_semi")
        events = edges.groupBy("g").cogroup(own.groupBy("g")).applyInPandas(_joined_range(min_cluster_size), EVENT)
        events = staged(events, "events")
        of = lambda kind: events.where(F.col("kind") == kind)
        moves = of("move").select("comp", F.col("to").alias("_to"))
        given = of("given").select("comp", F.col("cluster").alias("_c"), F.col("near").alias("_near"))
        met = members.join(moves, "comp", "left").join(given, "comp", "left")
        # A node is given to a cluster once, while no cluster holds its component.
        members = staged(met.select("g", "node", F.coalesce("_to", "comp").alias("comp"), F.coalesce("cluster", "_c").alias("cluster"), F.coalesce("near", "_near").alias("near")))
        kept = states.join(touched, ["g", "comp"], "left_anti")
        states = staged(kept.unionByName(of("state").select(*kept.columns)))
        part = of("ended").select("g", "cluster", "parent", "chosen", "death")
        ended = part if ended is None else staged(ended.unionByName(part))
    roots = states.where("cluster is not null").select("g", "cluster", F.lit(None).cast("string").alias("parent"), F.lit(False).alias("chosen"), "death")
    clusters = roots if ended is None else ended.unionByName(roots)
    return members.where("cluster is not null").select("node", "cluster", "near"), staged(clusters)


def chosen_ancestors(clusters: DataFrame) -> DataFrame:
    """(cluster, top): the topmost chosen cluster on the way from a cluster to its root, where there is one."""
    state = clusters.select("cluster", F.col("parent").alias("up"), F.when(F.col("chosen"), F.col("cluster")).alias("top"))
    while True:
        # The way doubles in every round.
        ahead = state.select(F.col("cluster").alias("up"), F.col("up").alias("_up"), F.col("top").alias("_top"))
        state = staged(state.join(ahead, "up", "left").select("cluster", F.col("_up").alias("up"), F.coalesce("_top", "top").alias("top")))
        if state.where("up is not null").isEmpty():
            return state.where("top is not null").select("cluster", "top")


def density_hierarchy(
    points: DataFrame, min_samples: int, min_cluster_size: int, *,
    category: str = "category", ident: str = "doc_id", vector: str = "reduced", merge_edges: int = MERGE_EDGES,
) -> DataFrame:
    """Adds ``topic`` (-1: noise; numbered by size, then by smallest id) and ``probability`` to every point.

    Of all branches of a category's tree with at least ``min_cluster_size`` points (2 at least) the most stable ones are
    topics, never the whole tree. A point's probability is the nearness at which it joins its topic,
    relative to the topic's densest moment; 0 for noise. Points without a vector are noise. Equal vectors
    share their fate, whatever the ids; every input row comes back, with its columns.
    """
    if min_cluster_size < 2:
        raise ValueError("a cluster has at least two points")
    g = F.coalesce(F.concat(F.lit("+"), F.col(category).cast("string")), F.lit(""))
    at = points.withColumns({"_g": g, "_v": F.col(vector).cast("array<double>")})
    counted = at.where("_v is not null").groupBy(F.col("_g").alias("g"), F.col("_v").alias("vector")).agg(F.count("*").alias("n"))
    # Written, so that the numbers stay.
    nodes = staged(counted.withColumn("node", F.monotonically_increasing_id()), "nodes")
    nodes = staged(core_distances(nodes, min_samples), "cores")
    leaves, clusters = condensed(nodes, spanning_tree(nodes), min_cluster_size, merge_edges)
    tops = chosen_ancestors(clusters).join(clusters.select(F.col("cluster").alias("top"), "death"), "top")
    strength = F.least("near", "death") / F.col("death")
    placed = leaves.join(tops, "cluster").select("node", "top", strength.alias("probability"))
    named = nodes.join(placed, "node").select(F.col("g").alias("_g"), F.col("vector").alias("_v"), "top", F.col("probability").alias("_p"))
    found = staged(at.join(named, ["_g", "_v"], "left"), "placed")
    sizes = found.where("top is not null").groupBy("_g", "top").agg(F.count("*").alias("_n"), F.min(ident).alias("_least"))
    # One row per topic.
    order = Window.partitionBy("_g").orderBy(F.desc("_n"), F.asc("_least"), F.asc("top"))
    numbers = sizes.select("top", (F.row_number().over(order) - 1).alias("topic"))
    kept = [c for c in points.columns if c not in ("topic", "probability")]
    return found.drop("topic", "probability").join(numbers, "top", "left").select(
        *kept, F.coalesce("topic", F.lit(-1)).alias("topic"), F.coalesce("_p", F.lit(0.0)).alias("probability")
    )
