"""Union, first-wins de-duplication and incremental merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def dedup_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key under a total ``order``.

    ``min_by`` combines on the map side, so a key that fills a third of the table reaches the
    shuffle as one row per input partition; a ``row_number`` window would send it to one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    ranking = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*others), ranking).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def dedup_text(df: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """First row per text; groups by a 256-bit digest so long texts are shuffled once only."""
    digest = df.withColumn("_digest", F.sha2(F.col(text), 256))
    return dedup_first(digest, "_digest", order).drop("_digest")


def unseen(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet; only the key column of ``existing`` is read."""
    return new.join(existing.select(key), key, "left_anti")


def merge_posts(existing: DataFrame, new: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Stored rows win over new ones, earlier rows over later ones: one shuffle, no join."""
    both = union_all(
        existing.withColumn("_new", F.lit(0)),
        new.withColumn("_new", F.lit(1)),
    )
    return dedup_first(both, key, ["_new", *order]).drop("_new")


def attach(left: DataFrame, right: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Left join after the right side is reduced to its first row per key."""
    return left.join(dedup_first(right, key, order), key, "left")


def mapped(df: DataFrame, column: str, pairs: dict[str, str], to: str) -> DataFrame:
    """Look a short fixed table up in place (a map literal, no join)."""
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return df.withColumn(to, F.try_element_at(table, F.col(column)))


def named(df: DataFrame, names: DataFrame, on: Sequence[str], fallback: Column, to: str = "name") -> DataFrame:
    """Left join to a name table with a computed name where none is listed."""
    return df.join(names, list(on), "left").withColumn(to, F.coalesce(F.col(to), fallback))
