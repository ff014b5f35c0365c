"""Exact dedup against a persistent digest index.

The index is a table of distinct text digests on shared storage, bucketed and sorted by
digest.  New data is deduplicated against it by a sort-merge anti-join of its
own distinct digests (the index side is read in its buckets, without a
shuffle), and the digests not yet known are appended with the doc_id that stays.

Two texts are equal when identical after every run of white space
(space, 0x09-0x0D) is replaced by one space; the digest is SHA-256 of that in
UTF-8.  A null text counts as empty; empty texts are equal to each other.  Of
equal texts the first batch's smallest doc_id stays; ``dedupe`` adds a table in
batches of ascending doc_id, so the smallest of all stays.  Rows with a null
doc_id never displace others; a group of only such rows has a null keep_id.  One
row of a group is kept: of rows that repeat the smallest doc_id, the first read.  Other
columns are ignored.  An empty table gives an empty result and leaves the index alone.

Adding is safe to repeat: a batch added twice finds all its digests known.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.llm.common import settle
from dockhand.session import path_exists

_SCHEMA = "digest binary, keep_id long"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


class DigestIndex:
    """Distinct digests at ``root``, in ``buckets`` buckets sorted by digest.

    The bucket count (the session's shuffle partitions unless given) is kept
    beside the table, so an index opened again, by another session without a
    catalog, finds its own.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        marker = f"{root.rstrip('/')}/_buckets"
        if path_exists(spark, marker):
            buckets = spark.read.json(marker).first()["buckets"]
        else:
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.json(marker)
        self.buckets, self.location = buckets, f"{root.rstrip('/')}/digests"
        self.table = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.table} ({_SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                  f"INTO {buckets} BUCKETS LOCATION '{self.location}'")

    def known(self) -> DataFrame:
        """The index as a bucketed table."""
        return self.spark.table(self.table)

    def close(self) -> None:
        """Take the index out of the session's catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def entries(self) -> DataFrame:
        """The index as plain files, for a session without its table."""
        return self.spark.read.schema(_SCHEMA).parquet(self.location)

    def add(self, digests: DataFrame) -> None:
        """Append the digests (digest, doc_id) not yet known, each with its smallest doc_id."""
        # settled, or the optimiser moves the join below the aggregate and shuffles every copy
        distinct = settle(digests.groupBy("digest").agg(F.min("doc_id").alias("keep_id")))
        new = distinct.hint("merge").join(self.known().select("digest").hint("merge"), "digest", "left_anti")
        staged = settle(new.select("digest", "keep_id"))  # read fully before the table it came from grows
        (staged.repartition(self.buckets, "digest").write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))


def digests_of(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row; one pass over the texts."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("digest"))


def dedupe(docs: DataFrame, index: DigestIndex, batches: int = 2) -> DataFrame:
    """Add ``docs`` to the index; (doc_id, keep_id, group_size, kept, text_sha256), one row per row."""
    found = settle(digests_of(docs).withColumn("row", F.monotonically_increasing_id()))
    low, high = found.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        index.add(found)
    else:
        cuts = [low + (high - low + 1) * k // batches for k in range(batches)] + [high + 1]
        for k in range(batches):  # ascending doc_id
            part = found.where((F.col("doc_id") >= cuts[k]) & (F.col("doc_id") < cuts[k + 1]))
            index.add(part.unionByName(found.where("doc_id is null")) if k == batches - 1 else part)
    # the row that may stay of each digest: the first of those with the smallest doc_id
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row")))
    sizes = settle(found.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), first.getField("row").alias("first_row")))
    # settled, so that the index is met in its buckets and not shuffled
    groups = settle(sizes.hint("merge").join(index.known().hint("merge"), "digest").select("digest", "keep_id", "group_size", "first_row"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row") == F.col("first_row"))
    return found.join(groups, "digest").select("doc_id", "keep_id", "group_size", stays.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
