"""Sharding into shards of near equal bytes by sampled splitters.

A sample of keys, drawn with probability proportional to row size, gives quantile boundaries. Rows
are ranged between them; a range that turns out overfull is subdivided by a hash of the row, which
also splits a single key. Exact sums per range and running sums inside a range then give every row
its exact position in the whole order, and a shard is an equal stretch of that order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import staged

# Keys drawn for the splitters: the bound of what the driver gathers.
SAMPLE = 20_000
# Rows that one range should hold at most, and the range counts allowed.
RANGE_ROWS = 100_000
MIN_RANGES, MAX_RANGES = 64, 4096
# A range over this many times the mean is subdivided.
OVERFULL = 1.5


def splitters(rows: DataFrame, total: int, ranges: int, sample: int = SAMPLE, seed: int = 11) -> list[int]:
    """At most ``ranges - 1`` ascending keys: quantiles of a size-weighted sample of (key, size) rows."""
    if total == 0:
        return []
    # Every byte counts alike: a row is drawn as often as its share of the sample's steps it covers.
    want = F.col("size").cast("double") * sample / total
    times = F.floor(want + F.rand(seed)).cast("int")
    few = rows.select("key", F.least(times, F.lit(sample)).alias("n")).where("n > 0").limit(4 * sample).toPandas()
    if few.empty:
        return []
    few = few.sort_values("key", na_position="first")
    keys, at = few["key"].fillna(-(2**63)).astype("int64").to_numpy(), few["n"].cumsum().to_numpy()
    cuts = np.arange(1, ranges) * at[-1] / ranges
    return sorted(set(keys[np.minimum(np.searchsorted(at, cuts), len(keys) - 1)].tolist()))


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", seed: int = 11, sample: int = SAMPLE
) -> DataFrame:
    """Give every row a shard 0 .. shards-1 and a gapless slot in it; bytes per shard are near equal.

    The size of a row is the UTF-8 bytes of its text (null: none) plus 1. A shard starts where its
    share of all bytes starts, so shards differ by less than the largest row. Columns: key, size,
    text_crc32, shard, slot; other columns are not read. A null key sorts first. Repeated rows and
    ties stay, in interchangeable places; a key that holds most rows is split over ranges. An empty
    table gives no rows.
    """
    narrow = docs.select(
        F.col(key).cast("long").alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).alias("crc"),
    )
    # A row's own salt: equal rows differ, so that no key is too large for one range.
    rows = staged(narrow.withColumn("salt", F.rand(seed)), "rows")
    whole = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("total")).first()
    n, total = whole["n"], whole["total"]
    ranges = min(MAX_RANGES, max(MIN_RANGES, 4 * shards, -(-n // RANGE_ROWS)))
    bounds = np.array(splitters(rows, total, ranges, sample, seed), dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.fillna(-(2**63)).astype("int64").to_numpy(), side="left").astype("int32"))

    ranged = staged(rows.withColumn("range", range_of("key")), "ranges")
    sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes"))
    # At most MAX_RANGES rows.
    split = sums.select("range", F.greatest(F.lit(1), F.ceil(F.col("bytes") * ranges / (total * OVERFULL or 1))).cast("int").alias("parts"))
    cells = ranged.join(F.broadcast(split), "range").withColumn("part", F.floor(F.col("salt") * F.col("parts")).cast("int"))
    per_cell = cells.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    # At most ranges + ranges / OVERFULL cells, so one task and one broadcast are bounded.
    starts = per_cell.select(
        "range", "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("range", "part").orderBy("key", "salt", "crc", "size")
    placed = cells.select(
        "key", "size", "crc", "range", "part",
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("sum_in"),
        F.row_number().over(inside).alias("row_in"),
    ).join(F.broadcast(starts), ["range", "part"])
    # Where the middle of the row lies in all bytes, in decimals because products pass 64 bits.
    middle = (F.col("bytes_before") + F.col("sum_in")) * 2 - F.col("size")
    shard = F.floor(middle.cast("decimal(24,0)") * shards / F.lit(2 * max(total, 1)).cast("decimal(24,0)")).cast("int")
    placed = staged(
        placed.select(
            "key", "size", "crc", F.least(shard, F.lit(shards - 1)).alias("shard"),
            (F.col("rows_before") + F.col("row_in") - 1).alias("place"),
        ),
        "places",
    )
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("place") - F.col("first")).alias("slot"),
    )
