"""One row per array element without evaluating the array twice.

A plain ``explode`` makes the optimizer add a "size > 0" filter below it, which would tokenise or
clean every text a second and third time; the outer form with a filter above gives the same rows.
Elements must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tied(key: str | Column, array: str | Column) -> Column:
    """The key as it is, but tied to an array column: an equi-join on a constant key would become a pairing of rows."""
    column = F.col(key) if isinstance(key, str) else key
    return F.when(F.coalesce(F.size(array), F.lit(0)) >= -1, column)


def exploded(df: DataFrame, keep: Sequence[str | Column], array: str | Column, name: str) -> DataFrame:
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def pos_exploded(df: DataFrame, keep: Sequence[str | Column], array: str | Column, pos: str, name: str) -> DataFrame:
    return df.select(*keep, F.posexplode_outer(array).alias(pos, name)).where(F.col(name).isNotNull())
