"""Dense vectors as arrays; sums run in DOUBLE."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with the value computed once, also where ``build`` uses it per array element."""
    return F.get(F.transform(F.array(value), build), 0)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0).cast("double"), lambda s, v: s + v)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """0 when either vector is all zeros."""
    return let(
        norm(a) * norm(b), lambda size: F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)
    )


def l2_normalize(a: Column) -> Column:
    return let(
        norm(a),
        lambda size: F.transform(a, lambda x: F.when(size == 0, F.lit(0.0)).otherwise(x.cast("double") / size)),
    )


def softmax(scores: Column) -> Column:
    def shares(values: Column) -> Column:
        powers = let(F.array_max(values), lambda top: F.transform(values, lambda x: F.exp(x - top)))
        return let(powers, lambda p: let(_sum(p), lambda total: F.transform(p, lambda x: x / total)))

    return let(scores, shares)
