"""Bulk database writes."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Commit batch sizes of the row loaders.
COMMIT_EVERY = 10_000


def jdbc_write(df: DataFrame, url: str, table: str, *, mode: str = "append", batch_size: int = COMMIT_EVERY,
               num_partitions: int | None = None, isolation: str = "READ_COMMITTED",
               **options: str) -> None:
    """Partitions write in parallel, ``batch_size`` rows per round trip.

    A JDBC write commits per task, so it is not atomic across the job: write
    into an empty staging table and publish with one statement afterwards.
    ``num_partitions`` caps concurrent connections.
    """
    out = df.coalesce(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)).option("isolationLevel", isolation))
    for k, v in options.items():
        w = w.option(k, v)
    w.save()
