"""Merkle manifest of a dataset, with a persistent tree that gives every changed row a version of its own.

A row's leaf is a digest of its fields. Rows are ranked inside their group by key, in ranges, and cut
into aligned blocks of 8^DEPTH leaves, so a block is a whole subtree. Each block folds to one node, those
nodes are again cut into blocks, and so on up to the group's root; the roots of the groups form one more tree.
On the way down every block gets the siblings between its top and the root. There a changed leaf
copies only its ancestors in the block, sharing all other nodes with the tree before, and the version goes on
above the block with the siblings that came down: no row travels up, and no task holds more than a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from forumlens.operators.sizing import broadcast_if_small
from forumlens.session import staged

FANOUT = 8
# Levels that one block folds: 512 leaves.
DEPTH = 3
BLOCK = FANOUT**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def levels_of(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    out = 0
    while n > 1:
        n, out = -(-n // FANOUT), out + 1
    return out


def leaf_digest(fields: Sequence[Column]) -> Column:
    """sha256 over the fields: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    value = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in value]
    return F.sha2(F.encode(F.concat(*parts), "UTF-8"), 256)


class PersistentTree:
    """Nodes of a block, level by level from the leaves; a version is a top node and shares what it does not change."""

    def __init__(self, leaves: Sequence[str], levels: int) -> None:
        self.digests: list[str] = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        self.level = [list(range(len(leaves)))]
        for _ in range(levels):
            below = self.level[-1]
            self.level.append([self._add(tuple(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
        (self.top,) = self.level[-1]

    def _add(self, children: tuple[int, ...]) -> int:
        self.digests.append(digest("".join([self.digests[c] for c in children])))
        self.children.append(children)
        return len(self.digests) - 1

    def changed(self, top: int, at: int, leaf: str) -> int:
        """Top of a new version with another leaf at place ``at``: only the ancestors of the leaf are copied."""
        path, node = [], top
        for depth in reversed(range(1, len(self.level))):
            path.append((node, at // FANOUT ** (depth - 1) % FANOUT))
            node = self.children[node][path[-1][1]]
        self.digests.append(leaf)
        self.children.append(())
        node = len(self.digests) - 1
        for old, place in reversed(path):
            own = self.children[old]
            node = self._add((*own[:place], node, *own[place + 1 :]))
        return node

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """Per level the digests before and after the leaf's ancestor among its run, each joined."""
        out = []
        for nodes in self.level[:-1]:
            run = [self.digests[x] for x in nodes[at // FANOUT * FANOUT : at // FANOUT * FANOUT + FANOUT]]
            out.append(("".join(run[: at % FANOUT]), "".join(run[at % FANOUT + 1 :])))
            at //= FANOUT
        return out


def folded(leaf: str, path: Sequence[tuple[str, str]]) -> str:
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds pos, the rank of a row in its group ``g`` by (k, node), and n, the rows of the group; written once.

    Rows are sorted in ranges, where equal rows differ by their place in the input, so neither a group nor
    a repeated row is one task. Ranges are numbered inside and shifted by the counts of the ranges before.
    """
    apart = rows.withColumn("salt", F.monotonically_increasing_id())
    order = [F.col("g").asc(), F.col("k").asc_nulls_first(), F.col("node").asc(), F.col("salt").asc()]
    ranged = apart.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, group, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            at = []
            for g in batch.column("g").to_pylist():
                group, done = g, done + 1 if g == group else 0
                at.append(done)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([task] * len(at), pa.int32()), pa.array(at, pa.int64())], names=[*batch.schema.names, "task", "at"]
            )

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema.fields)
    stored = staged(ranged.mapInArrow(number, f"{types}, task int, at bigint"), "ranked")
    counts = stored.groupBy("g", "task").agg(F.count("*").alias("rows"))
    whole = Window.partitionBy("g")
    # One row per group and range.
    starts = counts.select(
        "g", "task",
        F.coalesce(F.sum("rows").over(whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
        F.sum("rows").over(whole).alias("n"),
    )
    placed = stored.join(broadcast_if_small(starts), ["g", "task"])
    return placed.withColumn("pos", F.col("at") + F.col("start")).drop("task", "at", "start")


def _block_top(table: pa.Table) -> pa.Table:
    """A block of (g, block, pos, node, n) becomes its top node."""
    tree = _block_tree(table.sort_by("pos"))
    left = -(-table["n"][0].as_py() // FANOUT ** (len(tree.level) - 1))
    return pa.table({"g": table["g"].slice(0, 1), "pos": table["block"].slice(0, 1), "node": [tree.digests[tree.top]], "n": pa.array([left], pa.int64())})


def _blocked(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("bigint"))


def _levels_up(placed: DataFrame) -> list[DataFrame]:
    """Tables of nodes (g, pos, node, n) from the leaves up to one node per group."""
    out = [placed]
    most = placed.agg(F.max("n")).first()[0] or 0
    while most > 1:
        members = _blocked(out[-1]).select("g", "block", "pos", "node", "n")
        tops = members.groupBy("g", "block").applyInArrow(_block_top, "g string, pos bigint, node string, n bigint")
        out.append(staged(tops, "nodes"))
        most = -(-most // BLOCK)
    return out


TEXTS = pa.list_(pa.string())
PATHS = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("subroot", pa.string()), ("lefts", TEXTS), ("rights", TEXTS)])
PATH_COLUMNS = "g string, pos bigint, subroot string, lefts array<string>, rights array<string>"


def _block_tree(members: pa.Table) -> PersistentTree:
    return PersistentTree(members["node"].to_pylist(), min(DEPTH, levels_of(members["n"][0].as_py())))


def _member_paths(members: pa.Table, above: pa.Table, *, groups: bool = False) -> pa.Table:
    """The path of every node of a block: its siblings in the block, then those above. Members may stand for groups ``k``."""
    if not members.num_rows or not above.num_rows:
        return PATHS.empty_table()
    members = members.sort_by("pos")
    tree, row = _block_tree(members), above.to_pylist()[0]
    paths = [tree.siblings(i) for i in range(members.num_rows)]
    if groups:
        own = [members["k"], pa.array([0] * len(paths), pa.int64()), members["node"]]
    else:
        own = [members["g"], members["pos"], pa.array([row["subroot"]] * len(paths), pa.string())]
    sides = [[[x[side] for x in p] + row[name] for p in paths] for side, name in enumerate(("lefts", "rights"))]
    return pa.table([*own, *[pa.array(s, TEXTS) for s in sides]], schema=PATHS)


def _paths_down(levels: list[DataFrame], top: DataFrame, use, columns: str) -> DataFrame:
    """Brings paths (see ``PATHS``) from the top nodes down to blocks of leaves, where ``use`` gives the result."""
    above = top
    for level in reversed(levels[:-1]):
        own = above.select("g", F.col("pos").alias("block"), "subroot", "lefts", "rights").groupBy("g", "block")
        pairs = _blocked(level).groupBy("g", "block").cogroup(own)
        if level is levels[0]:
            return pairs.applyInArrow(use, columns)
        above = staged(pairs.applyInArrow(lambda m, a: _member_paths(m, a), PATH_COLUMNS), "paths")
    # No group has a second leaf, so every leaf is the top of its group.
    own = above.select("g", F.col("pos").alias("block"), "subroot", "lefts", "rights").groupBy("g", "block")
    return _blocked(levels[0]).groupBy("g", "block").cogroup(own).applyInArrow(use, columns)


def merkle_manifest(
    docs: DataFrame,
    observed: Mapping[str, Column] | None = None,
    key: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
) -> DataFrame:
    """Leaf, roots and proof of every row, and whether the row as ``observed`` still folds to the root.

    ``observed`` names fields whose present value differs from the recorded one; by default none does.
    Leaves of a group ascend by key; every 8 neighbours become the digest of their joined hex digests until one is left,
    the group's ``subroot``; subroots in order of the group do the same and give ``root``. ``proof_sha256``
    is the digest of all siblings, level by level. ``folded_root`` is computed from the observed leaf and the recorded
    siblings, ``verified`` says whether it is the root.

    Null keys come first, null groups too; rows of one key are ordered by leaf, so equal rows change places without
    effect and each keeps its own row. Null and empty fields differ. Other columns are not
    read. An empty table gives no rows. Text of any length is only read by the digest of its leaf.
    """
    changed = dict(observed or {})
    seen = leaf_digest([changed.get(f, F.col(f)) for f in fields]) if changed else F.lit(None).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("")).alias("g"),
        F.col(key).alias("k"), leaf_digest([F.col(f) for f in fields]).alias("node"), seen.alias("seen"),
    )
    # Written first, so that ranging the rows does not digest every text again.
    levels = _levels_up(_numbered(staged(leaves, "leaves")))
    tops = levels[-1].select("g", "node")
    heads = _levels_up(_numbered(tops.select(F.lit("").alias("g"), F.col("g").alias("k"), "node")))
    found = heads[-1].select("node").take(1)
    root = found[0]["node"] if found else None
    none = F.array().cast("array<string>")
    top = heads[-1].select("g", "pos", F.lit("").alias("subroot"), none.alias("lefts"), none.alias("rights"))

    # Written, so that the two sides meet as different tables even where a tree has one level.
    top = staged(top, "top")
    above = staged(_paths_down(heads, top, lambda m, a: _member_paths(m, a, groups=True), PATH_COLUMNS), "paths")
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    kind = docs.schema[key].dataType
    schema = pa.schema([("k", to_arrow_type(kind)), *[(c, pa.string()) for c in names], ("verified", pa.bool_())])

    def verify(members: pa.Table, above: pa.Table) -> pa.Table:
        if not members.num_rows or not above.num_rows:
            return schema.empty_table()
        members = members.sort_by("pos")
        leaf, seen = members["node"].to_pylist(), members["seen"].to_pylist()
        tree, row = _block_tree(members), above.to_pylist()[0]
        upper = list(zip(row["lefts"], row["rights"]))
        rest = "".join(x for pair in upper for x in pair)
        plain = folded(tree.digests[tree.top], upper)
        proofs, roots = [], []
        for i in range(len(leaf)):
            proofs.append(digest("".join([x for pair in tree.siblings(i) for x in pair]) + rest))
            if seen[i] is None or seen[i] == leaf[i]:
                roots.append(plain)
            else:
                roots.append(folded(tree.digests[tree.changed(tree.top, i, seen[i])], upper))
        columns = [leaf, [row["subroot"]] * len(leaf), [root] * len(leaf), proofs, roots, [r == root for r in roots]]
        return pa.table([members["k"], *map(pa.array, columns)], schema=schema)

    out = f"k {kind.simpleString()}, {', '.join(f'{c} string' for c in names)}, verified boolean"
    return _paths_down(levels, above, verify, out).withColumnRenamed("k", key)
