"""Near-duplicate documents: a multi-index Hamming join of b-bit MinHash signatures, links confirmed on full sets.

A signature has 40 positions of 16 bits in 10 chunks of 4. Two signatures that differ in at most 19
positions have a chunk with at most one difference (ten chunks with two each would be 20), so they
agree on three positions of some chunk: every signature enters the index under its 40 (chunk,
omitted position) keys, and all pairs within the distance share a key. At similarity 0.8 a pair
differs in 8 +- 2.5 positions, so it lies beyond 19 with probability 4e-6.

Groups are never expanded into all pairs. Documents of equal word sequences are one node. Each key
first links its members to its smallest one; after components are known, only keys whose members
still differ in component are searched, members outside the key's largest component against all,
in blocks, with a union-find that skips what is already joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.components import components
from forumlens.llm.words import WordHashes, byte_slices, hashed, mixed, window_hashes, worker_cache
from forumlens.session import staged

SHINGLE = 5
CHUNKS, WIDTH = 10, 4
POSITIONS = CHUNKS * WIDTH
# The largest distance for which the index finds every pair.
REACH = 2 * CHUNKS - 1
BLOCK = 512
LOWEST = -(2**63)
FACTORS = mixed(np.arange(1, POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_set(text: bytes, table: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words of the lower-cased text (A-Z only)."""
    hashes = hashed(text.lower().split(), table)
    if not len(hashes):
        return hashes
    return np.unique(window_hashes(hashes, min(size, len(hashes))))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 16-bit values per non-empty set."""
    joined = np.concatenate(sets)
    first = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), POSITIONS), np.uint16)
    for i, factor in enumerate(FACTORS):
        out[:, i] = mixed(np.minimum.reduceat(joined * factor, first)) & np.uint64(0xFFFF)
    return out


def index_keys(signature: np.ndarray) -> np.ndarray:
    """Keys (rows x 40): chunk, omitted position, and the three other values of the chunk."""
    chunks = signature.reshape(-1, CHUNKS, WIDTH).astype(np.int64)
    out = np.empty((len(signature), CHUNKS, WIDTH), np.int64)
    for skip in range(WIDTH):
        rest = [i for i in range(WIDTH) if i != skip]
        value = (chunks[:, :, rest[0]] << 32) | (chunks[:, :, rest[1]] << 16) | chunks[:, :, rest[2]]
        out[:, :, skip] = value | (np.arange(CHUNKS) * WIDTH + skip)[None, :] << 48
    return out.reshape(-1, POSITIONS)


def _signature(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, POSITIONS)


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _described(rows: DataFrame, size: int) -> DataFrame:
    """Per row: key, text digest, class (word sequence), set size, signature (null without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_cache("words", WordHashes)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                raw, offsets = byte_slices(part.column(1))
                raw = raw.tobytes()
                classes, sets = [], []
                for i in range(part.num_rows):
                    words = raw[offsets[i] : offsets[i + 1]].lower().split()
                    classes.append(xxhash.xxh3_128_digest(b" ".join(words)))
                    hashes = hashed(words, table)
                    sets.append(np.unique(window_hashes(hashes, min(size, len(hashes)))) if words else hashes)
                full = [s for s in sets if len(s)]
                made = iter(signatures(full)) if full else iter(())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(classes, pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([next(made).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["k", "s", "class", "n", "sig"],
                )

    return rows.mapInArrow(run, "k bigint, s bigint, class binary, n bigint, sig binary")


def _keys(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = index_keys(_signature(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), POSITIONS))], names=["key", "node"]
                )

    return nodes.where("sig is not null").select("node", "sig").mapInArrow(run, "key bigint, node bigint")


def _within_reach(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures differ in at most REACH positions; set sizes alone rule out others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = (_signature(batch.column(2)) != _signature(batch.column(3))).sum(1) <= REACH
                yield batch.select([0, 1]).filter(pa.array(near))

    sized = pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return sized.select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) of rows (a, b, ta, tb) whose full sets are similar; rows of one ``a`` come together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_cache("words", WordHashes)
        last, held = None, None
        for batch in batches:
            ta, tb, good = batch.column(2), batch.column(3), []
            a = batch.column(0).to_pylist()
            for i in range(batch.num_rows):
                if a[i] != last:
                    last, held = a[i], shingle_set((ta[i].as_py() or "").encode(), table, size)
                good.append(_similar(held, shingle_set((tb[i].as_py() or "").encode(), table, size), percent))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return pairs.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


class _Block:
    """Members of one block pair of one key."""

    def __init__(self, size: int, percent: int, table: WordHashes) -> None:
        self.size, self.percent, self.table = size, percent, table
        self.parent: dict[int, int] = {}
        self.sets: dict[int, np.ndarray] = {}

    def root(self, x: int) -> int:
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def links(self, key: int, rows: dict[str, list]) -> Iterator[tuple[int, int]]:
        label, small, n = np.array(rows["label"]), np.array(rows["small"]), np.array(rows["n"])
        sig = np.frombuffer(b"".join(rows["sig"]), np.uint16).reshape(-1, POSITIONS)
        keys = index_keys(sig)
        order = (key >> 48) & 0xFF
        for x in np.flatnonzero(small):
            fit = (label != label[x]) & ((sig != sig[x]).sum(1) <= REACH)
            fit &= np.minimum(n, n[x]) * 100 >= np.maximum(n, n[x]) * self.percent
            # A pair is looked at under the first key that it shares.
            others = np.flatnonzero(fit)
            others = others[(keys[others, :order] == keys[x, :order]).sum(1) == 0]
            for y in others:
                a, b = self.root(int(label[x])), self.root(int(label[y]))
                if a != b and _similar(self.set_of(rows, x), self.set_of(rows, y), self.percent):
                    self.parent[max(a, b)] = min(a, b)
                    yield int(label[x]), int(label[y])

    def set_of(self, rows: dict[str, list], i: int) -> np.ndarray:
        node = rows["node"][i]
        if node not in self.sets:
            if len(self.sets) > 2 * BLOCK:
                self.sets.clear()
            self.sets[node] = shingle_set((rows["text"][i] or "").encode(), self.table, self.size)
        return self.sets[node]


def _across(blocks: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between labels that meet in a block pair; rows come sorted by (key, i, j)."""
    columns = ["label", "small", "n", "sig", "node", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_cache("words", WordHashes)
        block = _Block(size, percent, table)
        group, rows = None, {c: [] for c in columns}

        def flush() -> pa.RecordBatch:
            found = list(block.links(group[0], rows)) if len(set(rows["label"])) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            groups = list(zip(*[batch.column(i).to_pylist() for i in range(3)]))
            held = {c: batch.column(c).to_pylist() for c in columns}
            for i, g in enumerate(groups):
                if g != group:
                    if group is not None:
                        yield flush()
                    group, rows = g, {c: [] for c in columns}
                for c in columns:
                    rows[c].append(held[c][i])
        if group is not None:
            yield flush()

    return blocks.select("key", "i", "j", *columns).mapInArrow(run, "a bigint, b bigint")


def _blocks(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, i, j, node, label, small): block pairs of the keys whose members differ in component.

    Block numbers from 0 hold members outside the key's largest component, those below 0 the largest.
    """
    labelled = members.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    labelled = staged(labelled, "labelled")
    sizes = labelled.groupBy("key", "label").agg(F.count("*").alias("c"))
    stats = sizes.groupBy("key").agg(F.sum("c").alias("all"), F.max(F.struct("c", "label")).alias("top")).where("all > top.c")
    stats = stats.select(
        "key", F.col("top.label").alias("top"),
        F.ceil(F.col("top.c") / BLOCK).cast("int").alias("nt"), F.ceil((F.col("all") - F.col("top.c")) / BLOCK).cast("int").alias("ns"),
    )
    active = labelled.join(stats, "key").withColumn("small", F.col("label") != F.col("top"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("small"), F.col("ns")).otherwise(F.col("nt"))).cast("int")
    active = active.withColumn("own", own)
    every = F.sequence(F.lit(0), F.col("ns") - 1)
    top = F.transform(F.sequence(F.lit(1), F.col("nt")), lambda x: -x)

    def pair(i, j):
        return F.struct(i.alias("i"), j.alias("j"))

    small = F.concat(
        F.transform(every, lambda x: pair(F.least(x, F.col("own")), F.greatest(x, F.col("own")))),
        F.transform(top, lambda x: pair(F.col("own"), x)),
    )
    large = F.transform(every, lambda x: pair(x, -F.col("own") - 1))
    spread = active.withColumn("p", F.explode(F.when(F.col("small"), small).otherwise(large)))
    return spread.select("key", "p.i", "p.j", "node", "label", "small")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = 80
) -> DataFrame:
    """Link documents whose shingle sets have Jaccard similarity of at least ``percent`` / 100, exactly confirmed.

    Columns: key, n_shingles, component_id (smallest key reachable over links), kept (key is that
    smallest one; of rows without key only those of one text), class_id (smallest key of equal word
    sequences), first (key and text are the smallest of the component), text_sum (digest of the text).
    Words are lower-cased (A-Z only). A text with fewer words than a shingle is
    one shingle; null, empty and blank texts have none and link with nothing, each being its own
    component. Links join texts, never keys: rows of one key, or without key, are linked only if their
    texts are, and of their texts in one component one is first. All rows come back, repeated rows
    alike; a null key stands below all others and comes back as null, with null as its component.
    Other columns are not read. An empty table gives no rows. Texts of any length are compared whole.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)).alias("k"), F.col(text).alias("t"))
    rows = rows.withColumn("s", F.xxhash64("t"))
    described = staged(_described(rows, shingle), "described")
    # A node is a word sequence, whatever keys it has; its number is fixed as the table is written.
    nodes = described.groupBy("class").agg(
        F.min(F.struct("k", "s")).alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig")
    )
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    keys = _keys(nodes)
    shared = keys.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    members = staged(keys.join(shared, "key"), "members")
    # Only texts whose signature meets another one are needed from here on.
    met = members.select("node").distinct()
    owners = nodes.select("node", "least.k", "least.s").join(met, "node", "left_semi")
    # Rows repeated under one key give their text once.
    texts = staged(rows.join(owners, ["k", "s"]).groupBy("node").agg(F.first("t").alias("t")), "texts")
    brief = nodes.where("sig is not null").select("node", "n", "sig").join(met, "node", "left_semi")
    brief = staged(brief, "brief")

    pairs = members.where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    pairs = pairs.join(brief.toDF("a", "na", "sa"), "a").join(brief.toDF("b", "nb", "sb"), "b")
    pairs = staged(_within_reach(pairs, percent), "pairs")
    read = pairs.join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a")
    links = staged(_confirmed(read, shingle, percent), "links")
    labels = components(links)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks(members, labels).join(brief, "node").join(texts.toDF("node", "text"), "node")
    dealt = blocks.repartition(partitions, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    more = staged(_across(dealt, shingle, percent), "more")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    labels = staged(labels, "labels")
    named = nodes.join(labels, "node", "left").select("class", "least", F.coalesce("label", "node").alias("label"))
    tops = named.groupBy("label").agg(F.min("least").alias("top"))
    named = named.join(tops, "label").select("class", F.col("least.k").alias("class_id"), "top")
    out = described.join(named, "class")
    lone = F.col("sig").isNull()
    component = F.when(lone, F.col("k")).otherwise(F.col("top.k"))

    first = F.col("s") == F.col("top.s")

    def restored(c):
        return F.when(c != LOWEST, c)

    return out.select(
        restored(F.col("k")).alias(key),
        F.col("n").alias("n_shingles"),
        restored(component).alias("component_id"),
        (lone | ((F.col("k") == F.col("top.k")) & ((F.col("k") != LOWEST) | first))).alias("kept"),
        restored(F.when(lone, F.col("k")).otherwise(F.col("class_id"))).alias("class_id"),
        (lone | ((F.col("k") == F.col("top.k")) & first)).alias("first"),
        F.col("s").alias("text_sum"),
    )
