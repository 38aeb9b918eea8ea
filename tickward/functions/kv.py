"""``key=value, key=value`` text as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickward.functions.text import strip


def pairs_of(text: Column) -> Column:
    """Comma-separated fields, each split at ``=``, last field first."""
    return F.reverse(F.transform(F.split(text, ",", -1), lambda field: F.split(field, "=", -1)))


def is_well_formed(pairs: Column) -> Column:
    """Every field has exactly one ``=``."""
    return F.forall(pairs, lambda pair: F.size(pair) == 2)


def names_of(pairs: Column) -> Column:
    """Stripped, lower-cased field names in the order of ``pairs``."""
    return F.transform(pairs, lambda pair: F.lower(strip(F.get(pair, F.lit(0)))))


def value_of(pairs: Column, names: Column, key: str) -> Column:
    """Stripped value of the last field named ``key``; NULL when there is none."""
    return strip(F.get(F.get(pairs, F.array_position(names, key).cast("int") - 1), F.lit(1)))
