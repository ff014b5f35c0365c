"""Latest row per key (A2): what a key-value store holds after the writes."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def tie_breakers(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Orderable columns appended to an ordering to make it total."""
    return [F.col(f"`{c}`") for c in columns if _orderable(df.schema[c].dataType)]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep, per key, the row that sorts last by ``order_by`` (later write wins).

    One ``max`` of a struct that starts with the order: a partial aggregate, so a
    key holding a third of the rows costs one row per task, not one giant
    group, and each column travels once.  The other columns break ties; columns without an
    order (maps, variants) cannot, and are carried by ``max_by``.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    named = [o for o in order_by if isinstance(o, str) and o in rest]
    lead = [F.col(f"`{o}`").alias(o if o in named else f"__o{i}") if isinstance(o, str) else o.alias(f"__o{i}")
            for i, o in enumerate(order_by)]
    order = F.struct(*lead, *tie_breakers(df, [c for c in rest if c not in named]))
    loose = [c for c in rest if not _orderable(df.schema[c].dataType)]
    aggs = [F.max(order).alias("__r")]
    if loose:
        aggs.append(F.max_by(F.struct(*[F.col(f"`{c}`") for c in loose]), order).alias("__l"))
    red = df.groupBy(*keys).agg(*aggs)
    return red.select(*[F.col(f"`{k}`") for k in keys],
                      *[F.col("__l" if c in loose else "__r").getField(c).alias(c) for c in rest])
