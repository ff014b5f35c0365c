"""Age-based retention."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.functions.timefmt import iso_wall_clock
from dockhand.session import remove_path

# Fixed value: the scheduled-run prefix.
RUN_ID_PREFIX = "run_id=scheduled__"
# Default limits, in days, for system and user classes.
SYSTEM_RETAIN_DAYS = 3
USER_RETAIN_DAYS = 15


def run_id_date(run_id: Column | str) -> Column:
    """Date of a scheduled run id, in the text's own offset (``+07:00`` or
    ``+0700``) whatever the session's zone; NULL when unreadable."""
    c = F.col(run_id) if isinstance(run_id, str) else run_id
    s = F.regexp_replace(c, "^" + RUN_ID_PREFIX, "")
    plain = F.when(s.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(s))
    return F.coalesce(iso_wall_clock(s).cast("date"), plain)


def resolve_run_date(run_date: str | None) -> Column:
    """Run date text, or today when it is unreadable."""
    if run_date is None:
        return F.current_date()
    return F.coalesce(F.to_date(F.try_to_timestamp(F.lit(run_date), F.lit("yyyy-MM-dd"))), F.current_date())


def retention_expired(date: Column, klass: Column, limits: Mapping[str, int | None],
                      default_days: int | None, run_date: str | None) -> Column:
    """TRUE where ``date + retain_days < run_date`` (strict).

    An unreadable date counts as the run date (kept); a class mapped to
    ``None`` is never expired.  Limits come from a driver-side dict turned
    into a CASE expression: no join, no broadcast.
    """
    rd = resolve_run_date(run_date)
    d = F.coalesce(date, rd)
    days = None
    for k, v in limits.items():
        val = F.lit(v).cast("int")
        days = F.when(klass == F.lit(k), val) if days is None else days.when(klass == F.lit(k), val)
    dflt = F.lit(default_days).cast("int")
    days = dflt if days is None else days.otherwise(dflt)
    return F.coalesce(F.date_add(d, days) < rd, F.lit(False))


def retention_filter(df: DataFrame, date_col: str, class_col: str, limits: Mapping[str, int | None],
                     default_days: int | None = USER_RETAIN_DAYS, run_date: str | None = None,
                     keep: bool = True) -> DataFrame:
    """Rows kept (``keep``) or dropped by the retention rule.

    ``date_col`` may be a date, a timestamp or run-id text.
    """
    dtype = df.schema[date_col].dataType
    if isinstance(dtype, T.StringType):
        date = run_id_date(date_col)
    else:
        date = F.to_date(F.col(date_col))
    exp = retention_expired(date, F.col(class_col), limits, default_days, run_date)
    return df.where(~exp) if keep else df.where(exp)


def retire_partitions(spark: SparkSession, target: str, date_col: str, class_col: str | None = None,
                      limits: Mapping[str, int | None] | None = None, default_days: int | None = USER_RETAIN_DAYS,
                      run_date: str | None = None, schema: T.StructType | None = None,
                      partition_cols: Sequence[str] | None = None, dry_run: bool = False) -> DataFrame:
    """W20 on whole partitions: drop those whose date has expired, reading no row and no file.

    ``target`` is a catalog table, or (with ``schema`` and ``partition_cols``) a
    partitioned folder.  The partition list, which the driver holds for planning
    anyway, is matched with the same rule as ``retention_filter``; expired
    partitions are dropped through the catalog or the file system.  Returns
    the expired partitions (also with ``dry_run``, which drops nothing).
    A partition whose date is NULL or unreadable stays.
    """
    from dockhand.sinks.catalog_tables import drop_partitions, folder_partitions, list_partitions

    if (schema is None) != (partition_cols is None):
        raise ValueError("a folder needs both schema and partition_cols")
    listed = folder_partitions(spark, target, schema, partition_cols) if schema is not None else list_partitions(spark, target)
    cols = [c for c in listed.columns if c != "__path"]
    if date_col not in cols or (class_col is not None and class_col not in cols):
        raise KeyError(f"{target} is partitioned by {cols}")
    klass = F.lit(None).cast("string") if class_col is None else F.col(class_col)
    date = run_id_date(date_col) if isinstance(listed.schema[date_col].dataType, T.StringType) else F.to_date(F.col(date_col))
    expired = listed.where(retention_expired(date, klass, limits or {}, default_days, run_date)).collect()  # a row per folder
    if not dry_run and schema is None:
        drop_partitions(spark, target, [{c: r[c] for c in cols} for r in expired])
    elif not dry_run:
        for r in expired:
            if not remove_path(spark, r["__path"]):
                raise OSError(f"could not remove {r['__path']}")
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in expired], T.StructType([listed.schema[c] for c in cols]))
