"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.session import cut_lineage, remove_path

BROADCAST_ROWS = 1_000_000  # narrow id rows: about 16 MB on an executor
BATCH_ROWS = 1000           # rows of text in an Arrow batch: a few MB, not Spark's default of 10,000 rows


def text_batches(df: DataFrame) -> DataFrame:
    """Keep Arrow batches of texts small in this session (they are held by the
    JVM and by each Python worker at once); a smaller setting stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


@contextmanager
def small_batches(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> Iterator[None]:
    """Small Arrow batches for the jobs run inside; the session's setting is put back."""
    conf, key = spark.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(batch_rows if int(before) <= 0 else min(batch_rows, int(before))))
    try:
        yield
    finally:
        conf.set(key, before)


def settle_texts(df: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """``settle`` a frame whose Python stage reads texts, in small Arrow batches."""
    with small_batches(df.sparkSession, batch_rows):
        return cut_lineage(df)


def read_file(spark: SparkSession, path: str) -> bytes:
    """One small file (a vocabulary, a model): a local file of the driver, or any path that Spark reads."""
    try:
        with open(path, "rb") as f:
            return f.read()
    except OSError:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def settle(df: DataFrame, release: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.  ``release`` after
    a large shuffle: let go of its files now (Spark's cleaner removes those
    whose owners were collected)."""
    out = cut_lineage(df)
    if release:
        gc.collect()
        out.sparkSession.sparkContext._jvm.System.gc()
    return out


def discard(settled: DataFrame) -> None:
    """Delete the files of a settled frame that nothing reads any more."""
    files = settled.inputFiles()
    if files:
        remove_path(settled.sparkSession, files[0].rsplit("/", 1)[0])


def small_side(df: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a settled frame of narrow rows for broadcast if its counted rows
    stay within ``most_rows``; beyond that the join shuffles."""
    return F.broadcast(df) if df.count() <= most_rows else df


def take_rows(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose key is in ``ids`` (one settled column)."""
    return docs.join(small_side(ids), key, "left_semi")


def drop_rows(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``ids``; null keys stay."""
    return docs.join(small_side(ids), key, "left_anti")
