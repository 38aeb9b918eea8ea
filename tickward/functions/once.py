"""Keep an expensive expression from being copied."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column) -> Column:
    """``c`` as a generated column of exactly one row, computed once per input row.

    The optimizer copies the expression of a plain column into every filter above it that it
    pushes down: a JSON text would be parsed again for each field a filter tests. Filters on a
    generator's output stay above the generator.
    """
    return F.explode(F.array(c))
