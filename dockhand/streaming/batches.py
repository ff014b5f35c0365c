"""Apply a partition-scoped load to each micro-batch of a stream."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dockhand.sinks.partitions import insert_dynamic, merge_partitions
from dockhand.session import path_exists


def load_each_batch(stream: DataFrame, path: str, schema: T.StructType, partition_cols: Sequence[str],
                    checkpoint: str, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
                    trigger_once: bool = True, keys: Sequence[str] | None = None) -> StreamingQuery:
    """Merge every micro-batch into a partitioned table (or append it).

    Each batch only reads and rewrites the partitions it touches; the first one is merged
    into an empty table.  The stream's checkpoint (in the shared folder) makes restarts resume at the
    last committed batch.  A batch whose load completed is marked under
    ``<checkpoint>/loaded`` and skipped when it is replayed.  If the job dies between
    the load and its mark, the batch is loaded again: harmless for merges that can be
    repeated (replace, do nothing), but an append, or a merge that adds up, then counts it twice.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        spark, mark = batch.sparkSession, f"{checkpoint.rstrip('/')}/loaded/{epoch}"
        if batch.isEmpty() or path_exists(spark, mark):
            return
        if merge is None:
            insert_dynamic(batch, path, partition_cols, overwrite=False)
        elif not path_exists(spark, path):
            insert_dynamic(merge(spark.createDataFrame([], schema), batch), path, partition_cols, overwrite=True)
        else:
            merge_partitions(spark, path, schema, batch, partition_cols, merge, keys)
        spark.createDataFrame([(epoch,)], "epoch long").write.mode("overwrite").json(mark)

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
