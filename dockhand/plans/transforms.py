"""User-code hooks."""

from __future__ import annotations

from typing import Any, Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def user_transform(df: DataFrame, fn: Callable[..., DataFrame | list[DataFrame]] | None,
                   **kwargs: Any) -> DataFrame | list[DataFrame]:
    """``fn(df, **kwargs)`` returning one frame or a list of frames."""
    if fn is None:
        return df
    out = fn(df, **kwargs)
    if isinstance(out, DataFrame) or (isinstance(out, list) and all(isinstance(x, DataFrame) for x in out)):
        return out
    raise TypeError("a transform must return a DataFrame or a list of DataFrames")


def dated_transform(spark: SparkSession, fn: Callable[..., DataFrame], run_date: str | None,
                    **kwargs: Any) -> DataFrame:
    """``fn(spark, run_date, **kwargs) -> DataFrame``; run date required."""
    if run_date is None or run_date == "None":
        raise ValueError("missing run_date")
    out = fn(spark, run_date, **kwargs)
    if not isinstance(out, DataFrame):
        raise TypeError("a dated transform must return a DataFrame")
    return out


def pandas_transform(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                     schema: T.StructType | str) -> DataFrame:
    """Pandas code that must stay pandas, run per Arrow batch.

    ``fn`` maps a batch of rows to a batch of rows.  Batches are slices of a
    partition: no group and no table is ever gathered into one task.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)
    return df.mapInPandas(run, schema)


def pandas_grouped(df: DataFrame, keys: Sequence[str], fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
                   schema: T.StructType | str, order_by: Sequence[str] = ()) -> DataFrame:
    """U3 per group: pandas code that sees one group, a batch of rows at a time.

    ``fn`` takes an iterator over the batches of one group (rows whose keys
    are equal, NULLs included) and yields any number of result frames.  No group is ever held whole: a
    group with most of the rows streams through its task in batches of
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows.  What ``fn`` does not
    read of a group is skipped.  With ``order_by`` the rows of a group arrive in
    that order (NULLs first); without, in any order.  Groups without rows do not exist, so an empty frame gives no call.
    """
    if not keys:
        raise ValueError("pandas_grouped needs keys; use pandas_transform for code that needs no groups")
    if order_by:
        # this shuffle and this sort are those of the grouping: neither is done again
        df = df.repartition(*keys).sortWithinPartitions(*keys, *order_by)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from fn(batches)

    return df.groupBy(*keys).applyInPandas(run, schema)
