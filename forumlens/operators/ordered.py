"""Order-dependent steps over long sequences (conversations, message logs).

A sequence may hold a third of all rows, so none of these sorts a whole sequence in one task:
rows are bucketed by their integer position, and what crosses a bucket border travels either as
a copied margin (``halo``) or as one summary row per bucket (``running``, ``previous_value``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 4096


def lookback(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    back: int,
    build: dict[str, Callable[[Window], Column]],
    width: int = WIDTH,
) -> DataFrame:
    """Add columns computed over the rows at positions ``order - back .. order - 1``.

    Every row is copied to the next bucket only if it lies within ``back`` of it.
    """
    width = max(width, back + 1)
    at = F.col(order)
    own = F.floor(at / width)
    near = F.array_distinct(F.array(own, F.floor((at + back) / width)))
    spread = df.withColumn("_b", F.explode(near))
    frame = Window.partitionBy(*keys, "_b").orderBy(order).rangeBetween(-back, -1)
    out = spread.select("*", *[make(frame).alias(name) for name, make in build.items()])
    return out.where(F.col("_b") == own).drop("_b")


def running(
    df: DataFrame, keys: Sequence[str], order: str, values: dict[str, tuple[str, Column]], width: int = WIDTH
) -> DataFrame:
    """Inclusive running ``sum`` or ``max``; ``values`` maps output name to (kind, input column).

    Buckets are summed locally, then shifted by the total of earlier buckets.
    """
    kinds = {"sum": (F.sum, lambda a, b: a + b), "max": (F.max, F.greatest)}
    inside = Window.partitionBy(*keys, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("_b", F.floor(F.col(order) / width))
    local = local.select("*", *[kinds[k][0](c).over(inside).alias(name) for name, (k, c) in values.items()])
    # The last running value of a bucket is its total.
    totals = local.groupBy(*keys, "_b").agg(*[F.max_by(n, order).alias(f"_t_{n}") for n in values])
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_b", *[kinds[k][0](f"_t_{n}").over(before).alias(f"_o_{n}") for n, (k, _) in values.items()]
    )
    out = local.join(offsets, [*keys, "_b"])
    for name, (kind, _) in values.items():
        shift = F.col(f"_o_{name}")
        joined = kinds[kind][1](F.col(name), shift)
        out = out.withColumn(name, F.when(shift.isNull(), F.col(name)).when(F.col(name).isNull(), shift).otherwise(joined))
    return out.drop("_b", *[f"_o_{n}" for n in values])


def previous_value(
    df: DataFrame, keys: Sequence[str], order: str, value: str, to: str, width: int = WIDTH
) -> DataFrame:
    """Value of the preceding row of the same sequence, however many positions earlier it lies."""
    local = df.withColumn("_b", F.floor(F.col(order) / width))
    inside = Window.partitionBy(*keys, "_b").orderBy(order)
    local = local.withColumn(to, F.lag(value).over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    lasts = local.groupBy(*keys, "_b").agg(F.max_by(value, order).alias("_last"))
    carried = lasts.withColumn("_prev", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_b"))).drop("_last")
    return (
        local.join(carried, [*keys, "_b"])
        .withColumn(to, F.when(F.col("_first"), F.col("_prev")).otherwise(F.col(to)))
        .drop("_b", "_first", "_prev")
    )
