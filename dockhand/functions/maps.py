"""Key subset of a map or of a column list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_subset(m: Column | str, keys: list[str]) -> Column:
    """Entries of ``m`` whose key is in ``keys``; source order kept.

    Missing keys are skipped; an empty key list yields an empty map.
    """
    m = F.col(m) if isinstance(m, str) else m
    wanted = F.array(*[F.lit(k) for k in keys]) if keys else F.array().cast("array<string>")
    return F.map_filter(m, lambda k, v: F.array_contains(wanted, k))


def select_subset(df: DataFrame, keys: list[str]) -> DataFrame:
    """Column form: the intersection of ``keys`` with the frame, frame order."""
    wanted = set(keys)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in wanted])
