"""Partitioned tables of the session catalog: create, conform, insert, publish, list, drop
(P4, W7, W8, W13 and X5 where the target is a table name, not a folder).

The table's own description rules: rows are conformed to its declared types
(partition columns that come from the data included) before anything is
written, matched by name, and inserted by position in the catalog's order.
The catalog learns new partitions from the insert; nothing is found by
listing folders.

Overwrites: Spark's default mode empties partitions that are not in the data,
and ``insertInto`` ignores the writer's ``partitionOverwriteMode`` option, so
the session's setting is ``dynamic`` around every insert and put back after.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.operators.conform import conform_schema
from dockhand.session import list_paths, path_exists, remove_path, scratch_path
from dockhand.sinks.partitions import partition_path

_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
# Fixed value: the folder name of a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
DROP_AT_ONCE = 100  # partitions in one ALTER TABLE


def quoted(name: str) -> str:
    """``schema.table`` with each part quoted; a name that holds a quote already is left alone."""
    return name if "`" in name else ".".join(f"`{part}`" for part in name.split("."))


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrites replace only the partitions in the data."""
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE, before)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(quoted(name)) if c.isPartition]


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'Location'")
    return described.select("data_type").first()[0].rstrip("/")


def create_table(spark: SparkSession, name: str, schema: T.StructType, partition_cols: Sequence[str] = (),
                 fmt: str = "parquet", location: str | None = None) -> str:
    """Create the table if it is absent; an existing one must be partitioned the same way and hold the columns.

    Partition columns come last in the catalog's order, whatever their place in ``schema``.
    """
    cols = list(partition_cols)
    lacking = [c for c in cols if c not in schema.names]
    if lacking:
        raise KeyError(f"partition columns not in the schema: {lacking}")
    if spark.catalog.tableExists(quoted(name)):
        have = partition_columns(spark, name)
        if [c.lower() for c in have] != [c.lower() for c in cols]:
            raise ValueError(f"table {name} is partitioned by {have}, not by {cols}")
        known = {c.lower() for c in spark.table(quoted(name)).columns}
        absent = [c for c in schema.names if c.lower() not in known]
        if absent:
            raise KeyError(f"table {name} lacks columns {absent}")
        return name
    ordered = T.StructType([f for f in schema.fields if f.name not in cols] + [schema[c] for c in cols])
    by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in cols)})" if cols else ""
    at = " LOCATION :location" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({ordered.toDDL()}) USING {fmt}{by}{at}",
              args={"location": location} if location else None)
    return name


def _resolve(partitions: Any, have: list[str], name: str) -> dict[str, Any]:
    """Static values by the table's column name; the other partition columns come from the data."""
    if partitions is None:
        return {}
    if not isinstance(partitions, (Mapping, list, tuple)):
        raise TypeError("partitions must be a dict (static values) or a list (columns of the data)")
    by_fold = {c.lower(): c for c in have}
    unknown = [c for c in partitions if c.lower() not in by_fold]
    if unknown:
        raise KeyError(f"table {name} is not partitioned by {unknown}")
    if not isinstance(partitions, Mapping):
        if {c.lower() for c in partitions} != set(by_fold):
            raise ValueError(f"give all partition columns of {name}: {have}")
        return {}
    if any(v is None for v in partitions.values()):
        raise ValueError("a static partition value cannot be NULL; let it come from the data")
    return {by_fold[c.lower()]: v for c, v in partitions.items()}


def conform_to_table(df: DataFrame, name: str, partitions: Any = None, strict: bool = True) -> DataFrame:
    """P4 against the catalog: the table's columns by name, cast to its types, in its order.

    The partition spec is resolved first, so partition columns taken from the
    data are cast too; static ones are left out (and ignored in ``df``).
    """
    spark = df.sparkSession
    static = _resolve(partitions, partition_columns(spark, name), name)
    target = T.StructType([f for f in spark.table(quoted(name)).schema.fields if f.name not in static])
    return conform_schema(df, target, strict=strict, keep_extra=False).select(*[f"`{f.name}`" for f in target.fields])


def _insert(rows: DataFrame, name: str, static: dict[str, Any], overwrite: bool) -> None:
    """Rows in the table's order (static columns left out) go in by position."""
    spark, have = rows.sparkSession, partition_columns(rows.sparkSession, name)
    dynamic = [c for c in have if c not in static]
    if dynamic:
        rows = rows.hint("rebalance", *dynamic)  # few files a partition; AQE splits a hot one
    view = f"dockhand_insert_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    # each value as its column's type, spelt by Spark: the catalog compares text
    fields = spark.table(quoted(name)).schema
    shown = spark.range(1).select(*[F.lit(v).cast(fields[c].dataType).cast("string").alias(c) for c, v in static.items()]).first() if static else None
    spec = ", ".join([f"`{c}` = :p{k}" if c in static else f"`{c}`" for k, c in enumerate(have)])
    clause = f" PARTITION ({spec})" if have else ""
    # in a spec, columns without a value must follow those with one
    if static and [c for c in have if c in static] != have[: len(static)]:
        raise ValueError(f"static partition columns must come first: {have}")
    try:
        with dynamic_overwrite(spark):
            spark.sql(f"INSERT {'OVERWRITE' if overwrite else 'INTO'} TABLE {quoted(name)}{clause} SELECT * FROM {view}",
                      args={f"p{k}": shown[c] for k, c in enumerate(have) if c in static} or None)
    finally:
        spark.catalog.dropTempView(view)


def insert_table(df: DataFrame, name: str, partitions: Mapping[str, Any] | Sequence[str] | None = None,
                 overwrite: bool = False) -> str:
    """W7 / W8 into a catalog table: conform, then INSERT INTO or OVERWRITE.

    A dict gives static partition values (leading columns), a list or None
    takes them from the data.  Overwrite replaces the named partition (no rows
    empty it) or, with values from the data, exactly the partitions present.
    """
    spark = df.sparkSession
    static = _resolve(partitions, partition_columns(spark, name), name)
    _insert(conform_to_table(df, name, partitions), name, static, overwrite)
    return name


def publish_table(df: DataFrame, name: str, partitions: Mapping[str, Any] | Sequence[str] | None = None, overwrite: bool = False,
                  partitions_generator: Callable[..., Any] | None = None, **generator_kwargs: Any) -> str:
    """W13 into a catalog table: conform, write a staging copy, insert from it, drop it.

    ``df`` may be derived from the table itself.  Replacing an unpartitioned
    table moves no rows twice: the staging copy is written beside the table's
    location and becomes it by one catalog change, so readers find the old or
    the new rows, never none.  If publishing fails the error names the staging copy, which is kept.
    """
    spark = df.sparkSession
    if partitions_generator is not None:
        partitions = partitions_generator(**generator_kwargs)
    have = partition_columns(spark, name)
    static = _resolve(partitions, have, name)
    rows = conform_to_table(df, name, partitions)
    if overwrite and not have:
        return _swap_location(rows, name)
    stage = scratch_path(spark, "staging")
    rows.write.parquet(stage)
    try:
        _insert(spark.read.schema(rows.schema).parquet(stage), name, static, overwrite)
    except Exception as e:
        raise RuntimeError(f"publishing to {name} failed; the complete staging copy is kept in {stage}") from e
    remove_path(spark, stage)
    return name


def _swap_location(rows: DataFrame, name: str) -> str:
    spark = rows.sparkSession
    old = table_location(spark, name)
    fresh = f"{old.split('__v_')[0]}__v_{uuid.uuid4().hex[:12]}"
    provider = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'Provider'").select("data_type").first()[0]
    rows.write.format(provider).save(fresh)
    spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION :at", args={"at": fresh})
    spark.catalog.refreshTable(quoted(name))
    remove_path(spark, old)  # last: a crash before this leaves an unused folder, not a broken table
    return name


def partition_specs(listed: DataFrame, schema: T.StructType, cols: Sequence[str], text: str = "partition") -> DataFrame:
    """Typed partition values from ``a=1/b=x`` texts (escaped as folder names are)."""
    parts = F.split(F.col(text), "/")
    out = []
    for k, c in enumerate(cols):
        raw = F.element_at(F.split(F.element_at(parts, k + 1), "=", 2), 2)
        value = F.url_decode(F.regexp_replace(raw, r"\+", "%2B"))
        out.append(F.when(raw != NULL_PARTITION, value).cast(schema[c].dataType).alias(c))
    return listed.select(*out, F.col(text).alias("__spec"))


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    """The catalog's partitions, one row each, with typed values.  No folder and no file is read."""
    schema = spark.table(quoted(name)).schema
    return partition_specs(spark.sql(f"SHOW PARTITIONS {quoted(name)}"), schema, partition_columns(spark, name)).drop("__spec")


def add_partition(spark: SparkSession, name: str, spec: Mapping[str, Any], location: str | None = None) -> None:
    """Register a partition (with the rows of a folder that is there already, if given)."""
    keys = ", ".join(f"`{c}` = :p{k}" for k, c in enumerate(spec))
    args = {f"p{k}": v for k, v in enumerate(spec.values())} | ({"at": location} if location else {})
    spark.sql(f"ALTER TABLE {quoted(name)} ADD IF NOT EXISTS PARTITION ({keys}){' LOCATION :at' if location else ''}", args=args)


def drop_partitions(spark: SparkSession, name: str, specs: Sequence[Mapping[str, Any]]) -> None:
    """Drop whole partitions, metadata and folders; absent ones are fine.

    The catalog keeps the folders of an external table, so those are removed here."""
    external = spark.catalog.getTable(quoted(name)).tableType == "EXTERNAL"
    root = table_location(spark, name) if external else ""
    for at in range(0, len(specs), DROP_AT_ONCE):
        portion = list(specs[at: at + DROP_AT_ONCE])
        args = {f"p{i}_{k}": v for i, s in enumerate(portion) for k, v in enumerate(s.values()) if v is not None}
        clauses = ["PARTITION (" + ", ".join(f"`{c}` = " + ("NULL" if v is None else f":p{i}_{k}") for k, (c, v) in enumerate(s.items())) + ")"
                   for i, s in enumerate(portion)]
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS {', '.join(clauses)}", args=args or None)
        for s in portion if external else ():
            folder = partition_path(spark, root, s)
            if path_exists(spark, folder):
                remove_path(spark, folder)


def folder_partitions(spark: SparkSession, path: str, schema: T.StructType, cols: Sequence[str]) -> DataFrame:
    """Partition folders below ``path`` with typed values and their ``__path``: names only, no file is read."""
    base = path.rstrip("/")
    found = [p for p, _ in list_paths(spark, base + "/*=*" * len(cols))]
    rows = [("/".join(p.rsplit("/", len(cols))[1:]), p) for p in found]
    listed = spark.createDataFrame(rows, "partition string, __path string")
    return partition_specs(listed, schema, cols).join(listed, F.col("__spec") == F.col("partition")).drop("__spec", "partition")
