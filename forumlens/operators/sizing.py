"""Size checks: before a table is broadcast, and before rows are spread over more tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.session import cut

MAX_ROWS = 20_000
# Numbers inside array columns, 32 MB as doubles.
MAX_VALUES = 4_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_ROWS, values: Column | None = None) -> DataFrame:
    """Materialise a summary table and broadcast it only when its size is within the bound.

    ``values`` is the length of a row's array columns, so that a few rows with long vectors are
    measured too. Beyond the bound the table joins like any other: by shuffle, with adaptive skew
    handling.
    """
    stored = cut(df)
    size = stored.agg(F.count("*").alias("rows"), F.sum(F.lit(0) if values is None else values).alias("values")).first()
    small = size["rows"] <= max_rows and (size["values"] or 0) <= MAX_VALUES
    return F.broadcast(stored) if small else stored


def hint_for(n_rows: int, max_rows: int = MAX_ROWS) -> Callable[[DataFrame], DataFrame]:
    """Broadcast hint for tables of at most ``n_rows`` rows, or none when that is over the bound."""
    return F.broadcast if n_rows <= max_rows else lambda df: df


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for heavy per-row work when the input has fewer splits than there are cores.

    A large table has more splits than cores and passes through unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
