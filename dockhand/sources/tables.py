"""Table and query import, source resolution, dated and windowed extracts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.operators.quality import nonempty_guard


@dataclass
class Source:
    """Where rows come from: a catalog, a file format at a path, or JDBC.

    ``format='table'`` reads catalog tables; ``'jdbc'`` needs ``url`` (and
    usually ``driver``, ``user``, ``password``) in ``options``; any other
    format is a ``spark.read.format(...)`` over ``path`` (``{table}`` in the
    path is replaced by the table name).
    """

    format: str = "table"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def reader(self, spark: SparkSession):
        r = spark.read.format(self.format)
        for k, v in self.options.items():
            r = r.option(k, v)
        return r


def _jdbc_bounds(spark: SparkSession, src: Source, relation: str, column: str) -> tuple[Any, Any]:
    """One min/max query run by the database; two values reach the driver."""
    q = f"SELECT min({column}) AS lo, max({column}) AS hi FROM {relation} AS bounds_src"
    row = src.reader(spark).option("query", q).load().first()
    return row[0], row[1]


def _jdbc_read(spark: SparkSession, src: Source, relation: str, split_by: str | None,
               num_partitions: int | None, fetch_size: int | None) -> DataFrame:
    r = src.reader(spark).option("dbtable", relation)
    if fetch_size:
        r = r.option("fetchsize", str(fetch_size))
    if split_by and num_partitions and num_partitions > 1:
        lo, hi = _jdbc_bounds(spark, src, relation, split_by)
        if lo is not None and hi is not None:
            r = (r.option("partitionColumn", split_by).option("lowerBound", str(lo))
                 .option("upperBound", str(hi)).option("numPartitions", str(num_partitions)))
    return r.load()


def import_table(spark: SparkSession, table: str, source: Source | None = None, *,
                 columns: Sequence[str] | None = None, where: str | None = None,
                 split_by: str | None = None, num_partitions: int | None = None,
                 fetch_size: int | None = None) -> DataFrame:
    """Parallel import of a table: column subset, row filter, split column.

    JDBC: the subset and filter run in the database (a subquery, like a
    ``--where``), and ``split_by`` becomes a partitioned read over the
    column's min..max.  Files/catalog: ``select``/``where`` that Catalyst
    prunes and pushes into the scan, which is parallel already: ``split_by``
    plays no part there (a range shuffle would move the whole import).
    """
    src = source or Source()
    cols = ", ".join(columns) if columns else "*"
    if src.format == "jdbc":
        sub = f"SELECT {cols} FROM {table}" + (f" WHERE {where}" if where else "")
        return _jdbc_read(spark, src, f"({sub}) import_src", split_by, num_partitions, fetch_size)
    if src.format == "table":
        df = spark.table(table)
    else:
        df = src.reader(spark).load((src.path or "{table}").format(table=table))
    if columns:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    if where:
        df = df.where(F.expr(where))
    return df


def import_query(spark: SparkSession, query: str, source: Source | None = None, *,
                 split_by: str | None = None, num_partitions: int | None = None,
                 fetch_size: int | None = None, args: Mapping[str, Any] | None = None) -> DataFrame:
    """Import the result of free SQL.

    JDBC: a split needs ``dbtable='(q) t'`` with ``partitionColumn`` (the
    ``query`` option refuses a partition column).  Catalog: ``spark.sql``
    with bound parameters.
    """
    src = source or Source()
    if src.format == "jdbc":
        if split_by and num_partitions and num_partitions > 1:
            return _jdbc_read(spark, src, f"({query}) import_q", split_by, num_partitions, fetch_size)
        r = src.reader(spark).option("query", query)
        if fetch_size:
            r = r.option("fetchsize", str(fetch_size))
        return r.load()
    return spark.sql(query, args=dict(args) if args else None)


def resolve_source(spark: SparkSession, table: str | None = None, sql: str | None = None,
                   sql_generator: Callable[..., str] | None = None, schema: str | None = None,
                   args: Mapping[str, Any] | None = None, **generator_kwargs: Any) -> DataFrame:
    """S3: ``table`` beats ``sql`` beats ``sql_generator(**kwargs)``; else error."""
    if table:
        return spark.table(f"{schema}.{table}" if schema else table)
    if sql:
        return spark.sql(sql, args=dict(args) if args else None)
    if sql_generator is not None:
        return spark.sql(sql_generator(**generator_kwargs), args=dict(args) if args else None)
    raise ValueError("give one of table, sql or sql_generator")


def dated_extract(spark: SparkSession, sql_builder: Callable[[str], str], run_date: str | None,
                  on_empty: str | None = "fail", args: Mapping[str, Any] | None = None) -> DataFrame:
    """S4 (+Q2): ``spark.sql(sql_builder(run_date))``; a missing run date is an error."""
    if run_date is None or run_date == "None":
        raise ValueError("missing run_date")
    df = spark.sql(sql_builder(run_date), args=dict(args) if args else None)
    return nonempty_guard(df, f"extract for {run_date}", on_empty) if on_empty else df


def time_window(df: DataFrame, ts_col: str, start: str | dt.datetime, hours: int,
                with_parts: bool = True) -> DataFrame:
    """Rows with ``start <= ts < start + hours`` (half-open), plus the
    ``year/month/day/hour`` layout columns of the export path.

    The bounds are literals, so the predicate reaches the Parquet scan.
    """
    from dockhand.operators.chunks import _ts, ntz_literal
    lo = ntz_literal(_ts(start))
    hi = F.timestamp_add("HOUR", F.lit(hours), lo)
    ts = F.col(ts_col)
    out = df.where((ts >= lo) & (ts < hi))
    if with_parts:
        out = out.withColumns({
            "year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"),
            "day": F.date_format(ts, "dd"), "hour": F.date_format(ts, "HH")})
    return out
