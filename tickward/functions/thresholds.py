"""Threshold arithmetic as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def profit_target(purchase: Column, percent: Column) -> Column:
    return purchase * (F.lit(1) + percent / F.lit(100))


def loss_limit(purchase: Column, percent: Column) -> Column:
    return purchase * (F.lit(1) - percent / F.lit(100))


def unusable(*values: Column) -> Column:
    """True where any operand is NULL or NaN. Spark orders NaN above every number, so a NaN
    limit would otherwise look like a crossed stop-loss."""
    return reduce(lambda a, b: a | b, [v.isNull() | F.isnan(v) for v in values])


def fired_side(price: Column, target: Column, limit: Column, usable: Column) -> Column:
    """``profit``, ``loss`` or NULL; both comparisons are inclusive and profit is tested first."""
    return F.when(usable & (price >= target), "profit").when(usable & (price <= limit), "loss")
