"""Upserts into an unpartitioned folder that rewrite only the files they touch.

A key-only scan finds the files that hold an incoming key; only these are read
whole, merged and rewritten, the others keep their names, times and bytes.  For
a daily delta into a table of many files that are laid out by key or by time of
insert, that is a small part of the table.

The swap is journalled: the new files are written complete into a hidden folder
of the target, then a journal names them and the old files, then they are moved in and the
old ones removed.  A crash before the journal leaves the target as it was; a
crash after it is finished by ``finish_swaps``, which every call runs first.
Between the move and the removal readers may see a row twice, as with any folder of plain files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.operators.merge import fits_broadcast
from dockhand.session import cut_lineage, list_paths, move_path, path_exists, remove_path

JOURNAL = "_swap-"



def touched_files(spark: SparkSession, path: str, schema: T.StructType, incoming: DataFrame, keys: Sequence[str],
                  broadcast_rows: int | None = None) -> list[str]:
    """Files of the folder that hold one of the incoming keys (NULL keys match nothing).

    Only the key columns are read.  The keys are broadcast if their measured size allows
    it; beyond that the scan is joined by shuffle, where Spark filters it by a
    Bloom filter of the keys at run time.  The list is no longer than the folder's own listing.
    """
    known = None
    for k in keys:
        c = F.col(f"`{k}`").isNotNull()
        known = c if known is None else known & c
    wanted = cut_lineage(incoming.where(known).select(*[F.col(f"`{k}`").cast(schema[k].dataType).alias(k) for k in keys]).distinct())
    side = F.broadcast(wanted) if fits_broadcast(wanted, broadcast_rows) else wanted
    rows = spark.read.schema(schema).parquet(path).select(*[F.col(f"`{k}`") for k in keys], F.col("_metadata.file_path").alias("__file"))
    return [unquote(r[0]) for r in rows.join(side, list(keys), "left_semi").select("__file").distinct().collect()]


def merge_touched_files(spark: SparkSession, path: str, schema: T.StructType, incoming: DataFrame, keys: Sequence[str],
                        merge: Callable[[DataFrame, DataFrame], DataFrame], broadcast_rows: int | None = None) -> list[str]:
    """Run a next-snapshot merge over the touched files only; returns the files that it replaced.

    ``merge(rows of the touched files, incoming)`` is any keyed load (``upsert_update``, ...):
    no file left out holds an incoming key, so the rest of the table cannot change.
    """
    path = path.rstrip("/")
    finish_swaps(spark, path)
    incoming = cut_lineage(incoming)
    old = touched_files(spark, path, schema, incoming, keys, broadcast_rows)
    target = spark.read.schema(schema).parquet(*old) if old else spark.createDataFrame([], schema)
    tag = uuid.uuid4().hex[:12]
    fresh = f"{path}/_new-{tag}"
    merge(target, incoming).hint("rebalance").write.parquet(fresh)
    _write_journal(spark, f"{path}/{JOURNAL}{tag}", {"fresh": fresh, "old": old})
    finish_swaps(spark, path)
    return old


def append_unseen(spark: SparkSession, path: str, schema: T.StructType, incoming: DataFrame, keys: Sequence[str],
                  ignore: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """W2 rewrites nothing: the rows that ``ignore(empty, incoming)`` would insert and whose keys the
    folder does not hold are added as new files; existing files are only read, key columns alone."""
    finish_swaps(spark, path.rstrip("/"))
    rows = cut_lineage(ignore(spark.createDataFrame([], schema), incoming))
    held = spark.read.schema(schema).parquet(path).select(*[F.col(f"`{k}`") for k in keys])
    if fits_broadcast(rows):  # only the keys that the incoming rows hit leave the scan
        held = held.join(F.broadcast(rows.select(*keys)), list(keys), "left_semi")
    unseen = cut_lineage(rows.join(held, list(keys), "left_anti").select(*schema.names))
    unseen.write.mode("append").parquet(path)


def _write_journal(spark: SparkSession, name: str, content: dict) -> None:
    """Complete or absent: written aside, then renamed."""
    spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.text(f"{name}.part")
    move_path(spark, f"{name}.part", name)


def finish_swaps(spark: SparkSession, path: str) -> int:
    """Finish every journalled swap of the folder; safe to repeat.  Staged files without a journal are dropped."""
    done = 0
    for journal, _ in list_paths(spark, f"{path}/{JOURNAL}*"):
        if journal.endswith(".part"):
            continue
        told = json.loads(spark.read.text(journal).first()[0])
        tag = journal.rsplit("-", 1)[1]
        for found, _ in list_paths(spark, f"{told['fresh']}/part-*"):
            # the tag keeps names apart and shows a repeated run what has been moved
            move_path(spark, found, f"{path}/{found.rsplit('/', 1)[1].replace('part-', f'part-{tag}-', 1)}")
        for old in told["old"]:
            if path_exists(spark, old):
                remove_path(spark, old)
        remove_path(spark, told["fresh"])
        remove_path(spark, journal)
        done += 1
    for leftover, _ in list_paths(spark, f"{path}/_new-*"):
        remove_path(spark, leftover)
    return done
