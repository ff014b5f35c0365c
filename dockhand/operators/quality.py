"""Checks: count check, non-empty guard, validator, reconciliation,
completeness gate, target exists (Q1-Q6)."""

from __future__ import annotations

import datetime as dt
import logging
from typing import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.session import cut_lineage

log = logging.getLogger(__name__)


class CheckFailed(ValueError):
    """A data-quality check did not pass."""


_CHECK_SCHEMA = T.StructType([
    T.StructField("check_table", T.StringType()),
    T.StructField("run_date", T.StringType()),
    T.StructField("observed", T.LongType()),
    T.StructField("passed", T.BooleanType()),
])


def count_check_row(check: DataFrame, table: str, run_date: str | None) -> DataFrame:
    """One result row for one check query: its first cell must be >= 1.

    No row, no column or a NULL first cell fails.  The check query itself is
    usually an aggregate (``SELECT count(*) ...``), so this reads one row.
    """
    if not check.columns:
        v = check.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("v"))
    else:
        # a global aggregate always yields one row: NULL when the check has none
        first = check.select(F.col(f"`{check.columns[0]}`").cast("bigint").alias("v")).limit(1)
        v = first.agg(F.first("v", ignorenulls=False).alias("v"))
    return v.select(F.lit(table).alias("check_table"), F.lit(run_date).cast("string").alias("run_date"),
                    F.col("v").alias("observed"),
                    F.coalesce(F.col("v") >= 1, F.lit(False)).alias("passed"))


def count_checks(spark: SparkSession, sql_builder: Callable[[str | None, str, str], str],
                 tables: Sequence[str], run_date: str | None = None, schema: str = "default",
                 raise_on_failure: bool = False) -> DataFrame:
    """Q1: run ``sql_builder(run_date, schema, table)`` per table.

    Every check is evaluated (not just up to the first failure) and returned
    as ``(check_table, run_date, observed, passed)``; ``raise_on_failure``
    then raises naming every failed table.
    """
    parts = [count_check_row(spark.sql(sql_builder(run_date, schema, t)), t, run_date) for t in tables]
    if not parts:
        return spark.createDataFrame([], _CHECK_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if raise_on_failure:
        failed = [r["check_table"] for r in out.where(~F.col("passed")).collect()]  # one row per table
        if failed:
            raise CheckFailed(f"data quality check failed on {run_date} for {failed}")
    return out


def nonempty_guard(df: DataFrame, what: str = "source", on_empty: str = "fail") -> DataFrame:
    """Q2: fail (or warn) when the frame has no row.

    The frame is staged once in the shared folder and the staged copy is
    tested and returned, so a query behind it runs once, not once for the
    guard and once for the load.
    """
    if on_empty not in ("fail", "warn"):
        raise ValueError("on_empty must be 'fail' or 'warn'")
    staged = cut_lineage(df)
    if staged.isEmpty():
        if on_empty == "fail":
            raise CheckFailed(f"{what} has no rows")
        log.warning("%s has no rows; nothing to load", what)
    return staged


def observed_counts(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows while a write runs (no second pass): read ``obs.get`` after."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def wrote_rows(df: DataFrame, obs: Observation) -> bool:
    """Whether the observed write had rows.  A plan known to be empty is optimised
    away with its metrics; testing such a frame again costs nothing."""
    try:
        return obs.get["rows"] > 0
    except (KeyError, Py4JJavaError):
        return not df.isEmpty()


def reconcile(source: DataFrame, kept_flag: Column | str) -> DataFrame:
    """Q4: ``(source_rows, parsed_rows, dropped_rows)`` in one aggregate pass."""
    k = F.col(kept_flag) if isinstance(kept_flag, str) else kept_flag
    return source.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(k).alias("parsed_rows"),
        F.count_if(~F.coalesce(k, F.lit(False))).alias("dropped_rows"))


def completeness(expected: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Q5: each expected item marked existing or missing.

    ``present`` is reduced to its distinct keys first (partial aggregation),
    then left-joined; the result has one row per expected item.
    """
    have = present.select(*on).distinct().withColumn("__present", F.lit(True))
    return (expected.join(have, on=list(on), how="left")
            .withColumn("status", F.when(F.col("__present"), F.lit("existing")).otherwise(F.lit("missing")))
            .drop("__present"))


def is_ready(gate: DataFrame) -> bool:
    """True when no expected item is missing (reads at most one row)."""
    return gate.where(F.col("status") == "missing").isEmpty()


def script_validator(result: DataFrame, name: str = "script", run_date: str | None = None,
                     raise_on_failure: bool = True) -> DataFrame:
    """Q3: the last statement of a script must pass a count check."""
    row = count_check_row(result, name, run_date)
    if raise_on_failure and not row.where(F.col("passed")).take(1):
        raise CheckFailed(f"validator failed for {name}")
    return row


def table_exists(spark: SparkSession, name: str) -> bool:
    """Q6: the target table exists in the catalog."""
    return spark.catalog.tableExists(name)


def require_table(spark: SparkSession, name: str) -> None:
    """Q6 as a gate: raise when the target table does not exist."""
    if not table_exists(spark, name):
        raise CheckFailed(f"target table {name} does not exist")


# Seconds of a chunk, and the second that an index of 0 begins with (weeks begin on a Monday).
_CHUNK_SECONDS = {"hour": (3_600, 0), "day": (86_400, 0), "week": (604_800, 4 * 86_400)}
GAP_BLOCK = 10_000  # chunks of one window


def missing_ranges(df: DataFrame, ts_col: str, since, until, granularity: str = "day", keys: Sequence[str] = (),
                   expected_keys: DataFrame | None = None) -> DataFrame:
    """Q5 / W18 as ranges: the chunks of [since, until) in which ``df`` has no row.

    One row per maximal run of missing chunks: keys, ``missing_from``,
    ``missing_until`` (exclusive) and ``n_chunks``.  With ``keys`` each key has
    its own time line; ``expected_keys`` adds keys that have no row at all.  Bounds are cut to whole
    chunks that begin within them.

    Gaps inside a block of ``GAP_BLOCK`` chunks come from a window per key and
    block, gaps between blocks from one row per block, so no window holds a
    whole time line, and no expected chunk is ever listed.
    """
    from dockhand.operators.chunks import _ts, chunk_start

    step, origin = _CHUNK_SECONDS[granularity]
    zero = dt.datetime(1970, 1, 1)
    first, end = (-(-(int((_ts(v) - zero).total_seconds()) - origin) // step) for v in (since, until))
    keys = list(keys)
    out_schema = [*keys, "missing_from", "missing_until", "n_chunks"]
    start = chunk_start(ts_col, granularity) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.extract(F.lit("DAY"), start).cast("long") * 86_400 + F.extract(F.lit("HOUR"), start).cast("long") * 3_600
    index = F.floor((seconds - F.lit(origin)) / F.lit(step)).cast("long")
    have = df.select(*[F.col(f"`{k}`") for k in keys], index.alias("__i")).where((F.col("__i") >= first) & (F.col("__i") < end)).distinct()
    block = F.floor(F.col("__i") / F.lit(GAP_BLOCK))
    inside = have.withColumn("__next", F.lead("__i").over(Window.partitionBy(*keys, block).orderBy("__i")))
    blocks = have.groupBy(*keys, block.alias("__b")).agg(F.min("__i").alias("__lo"), F.max("__i").alias("__hi"))
    blocks = blocks.withColumn("__next", F.lead("__lo").over(Window.partitionBy(*keys).orderBy("__b")))  # a row for each block
    lines = [F.col(f"`{k}`") for k in keys]

    def gap(frame: DataFrame, lo: Column, hi: Column) -> DataFrame:
        return frame.select(*lines, lo.cast("long").alias("__lo"), hi.cast("long").alias("__hi")).where(F.col("__lo") < F.col("__hi"))

    ends = blocks.groupBy(*keys).agg(F.min("__lo").alias("__min"), F.max("__hi").alias("__max"))
    if not keys:  # a time line without rows is missing as a whole
        ends = ends.select(F.coalesce("__min", F.lit(end)).alias("__min"), F.coalesce("__max", F.lit(end - 1)).alias("__max"))
    found = (gap(inside, F.col("__i") + 1, F.col("__next"))
             .unionByName(gap(blocks, F.col("__hi") + 1, F.col("__next")))
             .unionByName(gap(ends, F.lit(first), F.col("__min"))).unionByName(gap(ends, F.col("__max") + 1, F.lit(end))))
    if expected_keys is not None and keys:
        same = None
        for k in keys:
            c = F.col(f"e.`{k}`").eqNullSafe(F.col(f"h.`{k}`"))
            same = c if same is None else same & c
        absent = expected_keys.select(*lines).distinct().alias("e").join(have.select(*lines).distinct().alias("h"), same, "left_anti")
        found = found.unionByName(gap(absent, F.lit(first), F.lit(end)))

    def at(i: str) -> Column:
        return F.timestamp_add("SECOND", F.col(i) * step + origin, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))

    return found.select(*lines, at("__lo").alias("missing_from"), at("__hi").alias("missing_until"),
                        (F.col("__hi") - F.col("__lo")).alias("n_chunks")).select(*[f"`{c}`" for c in out_schema])
