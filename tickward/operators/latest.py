"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _unordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tiebreak: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the highest ``order``, then ``tiebreak``, then the remaining columns.

    ``max`` over a struct is a partial aggregate: each map task sends one row per key, so a key
    holding a third of the input costs no more to shuffle than any other, and no task sorts a
    whole group as ``row_number`` would. NULL in ``order`` ranks lowest, so it wins only when the
    group has nothing else; NULL keys form one group. Comparing every kept column makes the
    choice independent of input order. ``columns`` limits the output (and so the scan).
    """
    keys = list(keys)
    kept = [c for c in (columns if columns is not None else df.columns) if c not in keys]
    ranked = list(dict.fromkeys([order, *tiebreak, *kept]))
    ranked = [c for c in ranked if c not in keys]
    out = [*keys, *kept] if columns is not None else df.columns
    if any(_unordered(df.schema[c].dataType) for c in kept):
        # maps have no order: only order and tiebreak decide, so the tiebreak must be total
        rank = F.struct(*[c for c in (order, *tiebreak) if c not in keys])
        best = df.groupBy(*keys).agg(F.max_by(F.struct(*ranked), rank).alias("_best"))
    else:
        best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.`{c}`").alias(c) for c in out])
