"""Partitioned tables: static / dynamic insert and overwrite, staged publish,
chunked bulk loads, partition-scoped merges (W7, W8, W13, W14).

Dynamic overwrite is set on every write (``partitionOverwriteMode=dynamic``):
with Spark's default (static) an overwrite empties every partition that is
not in the data.
"""

from __future__ import annotations

import uuid
from typing import Any, Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.functions.timefmt import ntz_text
from dockhand.operators.chunks import chunk_start
from dockhand.operators.quality import observed_counts, wrote_rows
from dockhand.session import cut_lineage, list_paths, move_path, path_exists, remove_path, scratch_path


def partition_path(spark: SparkSession, path: str, spec: Mapping[str, Any]) -> str:
    """Folder of a partition, its values written and escaped as Spark does.

    ``spec`` names the partition columns in folder order; leading columns only
    give the folder that holds all their sub-partitions.
    """
    text = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in spec.items()]).first()
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join([path.rstrip("/"), *(escape(k, text[k]) for k in spec)])


def drop_partition(spark: SparkSession, path: str, spec: Mapping[str, Any]) -> None:
    """Remove a partition's folder, with all below it; absent is fine."""
    folder = partition_path(spark, path, spec)
    if path_exists(spark, folder) and not remove_path(spark, folder):
        raise OSError(f"could not remove partition folder {folder}")


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a partitioned folder; with ``schema`` the partition types are fixed
    (no type inference from folder names)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def insert_static(df: DataFrame, path: str, partition: Mapping[str, Any], overwrite: bool = False,
                  compression: str = "snappy") -> str:
    """Rows go to the named partition; values are constants.

    Overwrite replaces exactly that partition (empty input empties it); the
    other partitions are untouched.
    """
    spark = df.sparkSession
    cols = [c for c in df.columns if c not in partition]
    staged = df.select(*[F.col(f"`{c}`") for c in cols],
                       *[(F.lit(None).cast("string") if v is None else F.lit(v)).alias(k) for k, v in partition.items()])
    staged, seen = observed_counts(staged, f"rows-{uuid.uuid4().hex}")
    (staged.write.mode("overwrite" if overwrite else "append")
     .option("partitionOverwriteMode", "dynamic").option("compression", compression)
     .partitionBy(*partition.keys()).parquet(path))
    if overwrite and not wrote_rows(staged, seen):  # nothing was written, so nothing was replaced
        drop_partition(spark, path, partition)
    return path


def insert_dynamic(df: DataFrame, path: str, partition_cols: Sequence[str], overwrite: bool = False,
                   compression: str = "snappy", cluster: bool = True) -> str:
    """Partition values come from the data.

    Overwrite replaces only the partitions present in the data.  ``cluster``
    groups rows by the partition columns first (a ``rebalance`` hint) so each
    partition is written by few tasks (few files) instead of every task
    writing to every one; AQE splits a partition value that holds a third of
    the rows into several tasks instead of funnelling it through one.
    """
    out = df.hint("rebalance", *partition_cols) if cluster else df
    (out.write.mode("overwrite" if overwrite else "append")
     .option("partitionOverwriteMode", "dynamic").option("compression", compression)
     .partitionBy(*partition_cols).parquet(path))
    return path


def stage_and_publish(df: DataFrame, path: str, partitions: Mapping[str, Any] | Sequence[str] | None = None,
                      overwrite: bool = False, partitions_generator: Callable[..., Any] | None = None,
                      staging: str | None = None, **generator_kwargs: Any) -> str:
    """Write a staging copy, publish it into the target, drop the staging.

    Partition spec: dict = static values, list = dynamic columns, None =
    unpartitioned.  The target is only written from the finished staging
    copy, so a target that the incoming rows were derived from is never
    overwritten while read.  An unpartitioned overwrite is written beside the
    target and swapped in.  The staging copy goes after success only: when
    publishing fails, the error names the folder that keeps it.
    """
    spark = df.sparkSession
    if partitions_generator is not None:
        partitions = partitions_generator(**generator_kwargs)
    if partitions is not None and not isinstance(partitions, (dict, list, tuple)):
        raise TypeError("partitions must be a dict (static) or a list (dynamic)")
    stage = staging or scratch_path(spark, "staging")
    df.write.mode("overwrite").parquet(stage)
    staged = spark.read.schema(df.schema).parquet(stage)
    try:
        if isinstance(partitions, dict) and partitions:
            insert_static(staged, path, partitions, overwrite)
        elif partitions:
            insert_dynamic(staged, path, list(partitions), overwrite)
        elif overwrite:
            replace_table(staged, path)
        else:
            staged.write.mode("append").parquet(path)
    except Exception as e:
        raise RuntimeError(f"publishing to {path} failed; the complete staging copy is kept in {stage}") from e
    remove_path(spark, stage)
    return path


def restore_table(spark: SparkSession, path: str) -> bool:
    """Finish or undo a replacement that died between its two renames: the newest old copy
    comes back when the table's folder is not there.  True if one did."""
    path = path.rstrip("/")
    if path_exists(spark, path):
        return False
    kept = list_paths(spark, f"{path}__old_*")
    if kept:
        move_path(spark, max(kept, key=lambda p: p[1])[0], path)
    return bool(kept)


def replace_table(df: DataFrame, path: str) -> str:
    """Replace an unpartitioned folder: write a new location beside it, then
    swap by renaming.  The old rows stay readable until the new ones are complete."""
    spark, path = df.sparkSession, path.rstrip("/")
    restore_table(spark, path)
    tag = uuid.uuid4().hex[:12]
    fresh, old = f"{path}__new_{tag}", f"{path}__old_{tag}"
    df.write.parquet(fresh)
    had = path_exists(spark, path)
    if had:
        move_path(spark, path, old)
    try:
        move_path(spark, fresh, path)
    except OSError:
        if had:
            move_path(spark, old, path)
        raise
    if had:
        remove_path(spark, old)
    return path


def bulk_load_chunks(df: DataFrame, path: str, ts_col: str, granularity: str = "day",
                     chunk_col: str = "chunk", overwrite: bool = True) -> str | None:
    """Load a file set into a time-chunked table, one partition per chunk.

    Each chunk present in the data is replaced; an empty input is a no-op.
    """
    spark, had = df.sparkSession, path_exists(df.sparkSession, path)
    counted, seen = observed_counts(df.withColumn(chunk_col, ntz_text(chunk_start(ts_col, granularity))), f"rows-{uuid.uuid4().hex}")
    insert_dynamic(counted, path, [chunk_col], overwrite)
    if wrote_rows(df, seen):
        return path
    if not had:
        remove_path(spark, path)  # the writer made an empty folder
    return None


def _among(rows: DataFrame, parts: DataFrame, cols: Sequence[str]) -> Column:
    """Prunes ``rows`` to the folders of ``parts`` by the first partition column
    (its values are no more than the folders that the driver lists anyway)."""
    values = [r[0] for r in parts.select(cols[0]).distinct().collect()]
    return F.col(cols[0]).isin([v for v in values if v is not None]) | (F.col(cols[0]).isNull() if None in values else F.lit(False))


def _in_partitions(rows: DataFrame, parts: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    other = parts.select(*[F.col(f"`{c}`").alias(f"__p_{c}") for c in cols])
    same = F.lit(True)
    for c in cols:
        same = same & rows[c].eqNullSafe(F.col(f"__p_{c}"))
    return rows.join(other, same, how)


def merge_partitions(spark: SparkSession, path: str, schema: T.StructType, incoming: DataFrame,
                     partition_cols: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame],
                     keys: Sequence[str] | None = None) -> str:
    """Run a next-snapshot merge only over the partitions the incoming rows touch.

    The incoming rows are staged once.  Their partitions are read (pruned by the
    first partition column), merged, staged, then dynamically overwritten: the
    rest of a huge table is neither read nor rewritten.  With ``keys``, other
    partitions that hold an incoming key are found by a key-only semi join and
    join the rewrite, so a key that moves leaves no old row behind; without,
    the caller vouches that keys do not move.  A partition that the merge leaves without rows is dropped.
    """
    cols = list(partition_cols)
    incoming = cut_lineage(incoming)
    target = read_partitioned(spark, path, schema)
    parts = cut_lineage(incoming.select(*[F.col(f"`{c}`").cast(schema[c].dataType).alias(c) for c in cols]).distinct())
    if parts.isEmpty():
        return path
    if keys:
        wanted = incoming.select(*keys).distinct()
        elsewhere = _in_partitions(target.select(*dict.fromkeys([*keys, *cols])), parts, cols, "left_anti")
        parts = cut_lineage(parts.unionByName(elsewhere.join(wanted, list(keys), "left_semi").select(*cols)).distinct())
    touched = _in_partitions(target.where(_among(target, parts, cols)), parts, cols, "left_semi")
    # folders as they are: a value may be spelt otherwise than Spark writes it (m=01 of an int is read as 1)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
    spelt = target.select(*cols, folder.alias("__folder"))
    folders = _in_partitions(spelt.where(_among(spelt, parts, cols)), parts, cols, "left_semi").distinct().collect()
    result = cut_lineage(merge(touched, incoming))
    emptied = _in_partitions(parts, result.select(*cols).distinct(), cols, "left_anti").collect()
    stage_and_publish(result, path, cols, overwrite=True)
    for row in emptied:
        drop_partition(spark, path, {c: row[c] for c in cols})
    for row in folders:  # rows of a folder of another spelling were rewritten under Spark's own
        own = partition_path(spark, "", {c: row[c] for c in cols})
        if not unquote(row["__folder"]).endswith(own):
            remove_path(spark, unquote(row["__folder"]))
    return path
