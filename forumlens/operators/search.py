"""Exact and approximate vector search for batches of queries.

Queries are packed into blocks and the corpus into slices of bounded size, and slices travel to the
blocks of their route, of which there are a fixed number while blocks stay below their bound. A block meets its
slices one after the other in one task, which carries k rows per query, so no (query, row) pair is emitted
besides the kept ones. Products in single precision only rule rows out, by a bound of their error; what is left is scored
in double precision, coordinate by coordinate, so that a score does not depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from forumlens.operators.counts import top_k

# Blocks of a route while they hold LEAST_BLOCK to QUERY_BLOCK queries, and rows of a slice: with 768 dimensions of 4 bytes 48 MB and 12 MB.
QUERY_BLOCKS = 48
LEAST_BLOCK = 64
QUERY_BLOCK = 16_384
SLICE_ROWS = 4096
# Queries whose best rows a task carries at a time, when several blocks fall to it.
CARRIED = 65_536
# Scores held at a time, 4 MB, and numbers of vectors scored exactly at a time, 16 MB.
SCORES_AT_ONCE = 1 << 20
NUMBERS_AT_ONCE = 1 << 21
# Queries on which the number of probed cells is measured.
PROBE_SAMPLE = 256
# Scores are compared on this many digits, so equal vectors tie and the id decides.
DIGITS = 9


def _matrix(column: pa.ListArray) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _packed(side: DataFrame, sizes: DataFrame, keys: Sequence[str], groups: Column, group: str, packed: str) -> DataFrame:
    """(route, group number, list of rows), dealt to ``groups`` lists by a hash of the keys."""
    number = F.pmod(F.xxhash64(*keys), groups).cast("int").alias(group)
    item = F.struct(*keys, "vector").alias("item")
    dealt = side.join(sizes, "route").select("route", number, item)
    return dealt.groupBy("route", group).agg(F.collect_list("item").alias(packed))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, smallest id first among equals."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))][:k]


def _first_of_equals(stored: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the rows that can be among the k best: of equal vectors only those of the k smallest ids."""
    # Equal vectors have equal sums; a look at these mostly shows that there are few.
    sums = np.sort((stored * np.arange(1.0, stored.shape[1] + 1)).sum(axis=1))
    if len(sums) <= k or not (sums[k:] == sums[:-k]).any():
        return np.arange(len(stored))
    rows = np.ascontiguousarray(stored).view(np.dtype((np.void, stored.shape[1] * stored.itemsize))).ravel()
    _, same, n = np.unique(rows, return_inverse=True, return_counts=True)
    if n.max(initial=0) <= k:
        return np.arange(len(rows))
    order = np.lexsort((_comparable(ids), same))
    return np.sort(order[np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n) < k])


def _comparable(ids: np.ndarray) -> np.ndarray:
    return ids if ids.dtype.kind in "iuf" else pd.factorize(ids, sort=True)[0]


class _Kept:
    """The k best rows so far of every query of a block: highest score, then smallest id."""

    def __init__(self, keys: list[pa.Array], asked: np.ndarray, k: int) -> None:
        self.keys, self.q, self.k = keys, asked, k
        self.length = np.sqrt((asked**2).sum(axis=1))
        self.least = np.full(len(asked), -np.inf)
        self.who, self.score, self.ids = np.zeros(0, np.int64), np.zeros(0), None

    def meet(self, stored: np.ndarray, ids: np.ndarray) -> None:
        first = _first_of_equals(stored, ids, self.k)
        stored, ids = stored[first], ids[first]
        # Single precision only where its range holds the products.
        largest = max(np.abs(self.q).max(initial=0), np.abs(stored).max(initial=0))
        kind = np.float32 if largest < 1e15 else np.float64
        q, c = self.q.astype(kind), stored.astype(kind).T
        far = (stored.shape[1] + 8) * np.finfo(kind).eps * np.sqrt((stored**2).sum(axis=1)).max(initial=0)
        step = max(1, SCORES_AT_ONCE // max(1, len(ids)))
        for start in range(0, len(q), step):
            near = q[start : start + step] @ c
            error = far * self.length[start : start + step]
            least = self.least[start : start + step] - error
            if len(ids) > self.k and np.isinf(least).any():
                # k rows of this slice are at least this near.
                least = np.maximum(least, np.partition(near, len(ids) - self.k, axis=1)[:, len(ids) - self.k] - 2 * error)
            border = np.nextafter((least - 10.0**-DIGITS).astype(kind), kind(-np.inf))
            row, what = np.divmod(np.flatnonzero(near >= border[:, None]), len(ids))
            self._add(row + start, what, stored, ids)

    def _add(self, row: np.ndarray, what: np.ndarray, stored: np.ndarray, ids: np.ndarray) -> None:
        step = max(1, NUMBERS_AT_ONCE // stored.shape[1])
        for i in range(0, len(row), step):
            who, at = row[i : i + step], what[i : i + step]
            score = np.zeros(len(who))
            for j in range(stored.shape[1]):
                score += self.q[who, j] * stored[at, j]
            score = np.round(score, DIGITS)
            fits = score >= self.least[who]
            if fits.any():
                self._merge(who[fits], score[fits], ids[at[fits]])

    def _merge(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.zeros(len(self.q), bool)
        touched[who] = True
        old = touched[self.who]
        held = ids[:0] if self.ids is None else self.ids
        who, score, ids = np.r_[self.who[old], who], np.r_[self.score[old], score], np.concatenate([held[old], ids])
        order = np.lexsort((_comparable(ids), -score, who))
        who, score, ids = who[order], score[order], ids[order]
        n = np.bincount(who, minlength=len(self.q))
        place = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
        last = place == self.k - 1
        self.least[who[last]] = score[last]
        best = place < self.k
        self.who, self.score = np.r_[self.who[~old], who[best]], np.r_[self.score[~old], score[best]]
        self.ids = np.concatenate([held[~old], ids[best]])

    def rows(self, names: list[str], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(self.who), 1 << 16):
            at = slice(i, i + (1 << 16))
            who, ids = pa.array(self.who[at]), pa.array(self.ids[at].tolist(), kind)
            yield pa.RecordBatch.from_arrays([*[key.take(who) for key in self.keys], ids, pa.array(self.score[at])], names=names)


def _meet(k: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Score lists of queries against lists of corpus rows and keep the k best of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is kept of a block leaves once; should it leave in parts, the final choice is the same.
        blocks: dict[tuple, _Kept] = {}
        kind = pa.null()
        for batch in batches:
            for i in range(batch.num_rows):
                block = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if block not in blocks:
                    *keys, asked = batch.column(2).slice(i, 1).flatten().flatten()
                    if sum(len(b.q) for b in blocks.values()) + len(asked) > CARRIED:
                        for b in blocks.values():
                            yield from b.rows(names, kind)
                        blocks = {}
                    # Copied: a view would hold the whole batch.
                    blocks[block] = _Kept([pa.concat_arrays([key.take(pa.array(np.arange(len(key))))]) for key in keys], _matrix(asked).copy(), k)
                ids, stored = batch.column(3).slice(i, 1).flatten().flatten()
                kind = ids.type
                blocks[block].meet(_matrix(stored), np.array(ids.to_pylist()) if pa.types.is_integer(kind) else np.array(ids.to_pylist(), object))
        for b in blocks.values():
            yield from b.rows(names, kind)

    return run


def top_inner_product(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 10,
    *,
    query_keys: Sequence[str] = ("query_id",),
    carry: Sequence[str] = ("doc_id",),
    vector: str = "embedding",
    route: str | None = None,
    routes: str | None = None,
    block: int = QUERY_BLOCK,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The k corpus rows with the largest inner product per query, with ``score`` and ``rank``.

    ``carry`` lists corpus columns to return, the unique id first. With ``route`` (corpus column)
    and ``routes`` (array column of the queries) a query meets only rows of its routes. Rows with a
    null vector, on either side, take no part. Neither side is gathered: queries are packed into
    blocks and the corpus into slices, every slice is sent to the blocks of its route, and a
    block keeps k rows per query, as ids; other columns are joined to the final k.
    """
    ident = carry[0]
    # Without routes all rows share one, made from a column: a constant would turn joins on it into pairings.
    one = lambda c: F.coalesce(F.substring(F.col(c).cast("string"), 1, 0), F.lit(""))
    place = F.col(route).cast("string") if route else one(ident)
    stored = corpus.where(F.col(vector).isNotNull() & place.isNotNull()).select(
        place.alias("route"), F.col(ident).alias("ident"), F.col(vector).alias("vector")
    )
    names = [f"key{i}" for i in range(len(query_keys))]
    wanted = F.explode(F.array_distinct(F.col(routes).cast("array<string>"))) if routes else one(query_keys[0])
    asked = queries.where(F.col(vector).isNotNull()).select(
        wanted.alias("route"), *[F.col(c).alias(n) for c, n in zip(query_keys, names)], F.col(vector).alias("vector")
    )
    count = lambda df, n: df.groupBy("route").agg(F.count("*").alias(n))
    held, wait = count(stored, "n"), count(asked, "n")
    slices = _packed(stored, held, ["ident"], F.ceil(F.col("n") / slice_rows), "slice", "rows")
    n_blocks = F.greatest(F.least(F.ceil(F.col("n") / LEAST_BLOCK), F.lit(QUERY_BLOCKS)), F.ceil(F.col("n") / block)).cast("int")
    blocks = _packed(asked, wait, names, n_blocks, "block", "queries")
    everywhere = F.explode(F.sequence(F.lit(0), n_blocks - 1))
    sent = slices.join(wait, "route").select("route", everywhere.alias("block"), "rows")
    # Hashed, not sorted: slices stream past the blocks of their task.
    met = sent.join(blocks.hint("shuffle_hash"), ["route", "block"]).select("route", "block", "queries", "rows")
    out_schema = StructType(
        [StructField(n, queries.schema[c].dataType) for c, n in zip(query_keys, names)]
        + [StructField("ident", corpus.schema[ident].dataType), StructField("score", DoubleType())]
    )
    found = met.mapInArrow(_meet(k, out_schema.names), out_schema)
    best = top_k(found, names, [F.desc("score"), F.asc("ident")], k)
    # Joined under names of their own, since a query key may be called like a corpus column.
    shown = corpus.select(F.col(ident).alias("_ident"), F.struct(*[F.col(c) for c in carry]).alias("_row"))
    full = best.join(shown, F.col("ident") == F.col("_ident"))
    return full.select(
        *[F.col(n).alias(c) for n, c in zip(names, query_keys)], *[F.col("_row").getField(c).alias(c) for c in carry], "score", "rank"
    )


def fit_cells(train: DataFrame, cells: int, vector: str = "embedding", seed: int = 42):
    """k-means cells for approximate search; ``train`` may be any part of the corpus."""
    prepared = train.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    return KMeans(k=cells, seed=seed, maxIter=10, featuresCol="features", predictionCol="cell").fit(prepared)


def _cell_order(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Cells of every vector, nearest first."""
    distance = (centres**2).sum(axis=1) - 2 * vectors @ centres.T
    return np.argsort(distance, axis=1, kind="stable")


def _located(corpus: DataFrame, model, vector: str) -> DataFrame:
    features = array_to_vector(F.col(vector).cast("array<double>"))
    return model.transform(corpus.withColumn("features", features)).drop("features")


def probes_for(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    model,
    recall: float,
    *,
    query_keys: Sequence[str] = ("query_id",),
    ident: str = "doc_id",
    vector: str = "embedding",
    sample: int = PROBE_SAMPLE,
) -> int:
    """The fewest probes of ``approximate_top`` with at least the given recall of the exact k.

    Measured on at most ``sample`` queries (smallest hash of the keys), which are searched exactly:
    a neighbour is found once its cell is probed. The mean has to lie three standard errors above
    the target, so that the other queries meet it too; if none but all cells do, all are probed.
    """
    drawn = queries.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(*query_keys), *query_keys).limit(sample)
    drawn = drawn.select(*query_keys, F.col(vector).cast("array<double>").alias(vector))
    rows = drawn.collect()
    centres = np.array(model.clusterCenters())
    if not rows:
        return len(centres)
    # The drawn rows again as a table, so that the search sees the same ones.
    asked = queries.sparkSession.createDataFrame(rows, drawn.schema)
    located = _located(corpus.where(F.col(vector).isNotNull()), model, vector)
    exact = top_inner_product(asked, located, k, query_keys=query_keys, carry=(ident, "cell"), vector=vector)
    place = np.argsort(_cell_order(np.array([r[vector] for r in rows]), centres), axis=1)
    number = {tuple(r[c] for c in query_keys): i for i, r in enumerate(rows)}
    found = np.zeros((len(rows), len(centres)))
    for r in exact.select(*query_keys, "cell").collect():
        i = number[tuple(r[c] for c in query_keys)]
        found[i, place[i, r["cell"]]] += 1
    share = np.cumsum(found, axis=1) / np.maximum(found.sum(axis=1, keepdims=True), 1)
    sure = share.mean(axis=0) - 3 * share.std(axis=0) / np.sqrt(len(rows))
    enough = np.flatnonzero(sure >= recall)
    return int(enough[0]) + 1 if len(enough) else len(centres)


def approximate_top(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    model,
    probes: int,
    *,
    query_keys: Sequence[str] = ("query_id",),
    carry: Sequence[str] = ("doc_id",),
    vector: str = "embedding",
) -> DataFrame:
    """As ``top_inner_product`` but a query only meets the rows of its ``probes`` nearest cells.

    Every row keeps its exact score. Slices are sent to the query blocks of their cell only.
    """
    located = _located(corpus, model, vector)
    centres = np.array(model.clusterCenters())

    @F.pandas_udf("array<int>")
    def nearest(batch: pd.Series) -> pd.Series:
        return pd.Series(list(_cell_order(np.stack(batch.to_list()), centres)[:, :probes].astype("int32")))

    return top_inner_product(
        queries.withColumn("_cells", nearest(vector)), located, k,
        query_keys=query_keys, carry=carry, vector=vector, route="cell", routes="_cells",
    )
