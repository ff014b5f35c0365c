"""Shards of near equal bytes by Karmarkar-Karp differencing.

Documents with equal texts are indivisible groups.  Differencing keeps, for
every partial partition, k sums; it repeatedly takes the two of largest spread
and adds them in opposite order, so their differences cancel.

One task cannot hold all groups of a large corpus, so differencing runs in
levels.  A level deals its items to chunks of about ``CHUNK`` by hash, and
differences every chunk into ``BUNDLES`` bundles of near equal bytes in a
task of its own (an item heavier than its share ends up alone in a bundle);
the bundles are the next level's items.  When at most ``TOP`` items are left, one
last differencing deals them to the shards.  Each level divides the items by
about CHUNK / BUNDLES and no task ever sees more than a bounded number.

Sizes are UTF-8 bytes plus 1 (a null text: 1).  Null texts are a group of
their own, apart from empty ones.  Rows with null doc_ids and repeated rows are
dealt like others.  Other columns are ignored.  With fewer groups than shards,
some shards stay empty.  A group larger than a shard's share makes its shard larger: it is not split.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.common import settle

SHARDS = 16
CHUNK = 20_000
BUNDLES = 256
TOP = 20_000
SLOT_BLOCK = 100_000


def karmarkar_karp(sizes: np.ndarray, k: int) -> np.ndarray:
    """Part (0 to k-1) of every item; parts have near equal sums."""
    n = len(sizes)
    if n == 0:
        return np.zeros(0, np.int64)
    # a partial partition: its k sums, ascending, less the least; and how it came about
    sums: dict[int, np.ndarray] = {}
    made: list[tuple[int, int, np.ndarray]] = []  # (left, right, order of the added sums)
    heap = []
    for i, size in enumerate(sizes):
        row = np.zeros(k, np.int64)
        row[-1] = size
        sums[i] = row
        heap.append((-int(size) if k > 1 else 0, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        added = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(added, kind="stable")
        node = n + len(made)
        made.append((a, b, order))
        row = added[order]
        sums[node] = row - row[0]
        heapq.heappush(heap, (-int(row[-1] - row[0]), node))
    # walk back: where the sums at each position of a node went
    part = np.empty(n, np.int64)
    place = {heap[0][1]: np.arange(k)}
    for j in range(len(made) - 1, -1, -1):
        a, b, order = made[j]
        own = np.empty(k, np.int64)
        own[order] = place.pop(n + j)
        for child, places in ((a, own), (b, own[::-1])):
            if child < n:
                part[child] = places[-1]
            else:
                place[child] = places
    if len(made) == 0:
        part[0] = place[heap[0][1]][-1]
    return part


def _dealt(items: DataFrame, chunk, parts: int) -> DataFrame:
    """(item, size, chunk, part): every chunk differenced in its own task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item", ignore_index=True)
        return pdf.assign(part=karmarkar_karp(pdf["size"].to_numpy(np.int64), parts))

    item = items.schema["item"].dataType.simpleString()
    return (items.withColumn("chunk", chunk).groupBy("chunk")
            .applyInPandas(run, f"item {item}, size long, chunk long, part long"))


def shard_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(item, shard) for groups (item, size)."""
    items, levels = settle(groups.select("item", F.col("size").cast("long").alias("size"))), []
    while (n := items.count()) > TOP:
        chunks = -(-n // CHUNK)
        level = settle(_dealt(items, F.pmod(F.xxhash64("item", F.lit(len(levels))), F.lit(chunks)), BUNDLES)
                       .withColumn("bundle", F.col("chunk") * BUNDLES + F.col("part")).select("item", "size", "bundle"))
        levels.append(level)
        items = settle(level.groupBy("bundle").agg(F.sum("size").alias("size")).withColumnRenamed("bundle", "item"))
    out = settle(_dealt(items, F.lit(0).cast("long"), shards).select("item", F.col("part").cast("int").alias("shard")))
    for level in reversed(levels):
        out = level.select("item", "bundle").join(out.withColumnRenamed("item", "bundle"), "bundle").select("item", "shard")
    return out


def number_slots(rows: DataFrame, by: str, total: int, order: list[str]) -> DataFrame:
    """``slot``: gapless numbers from 0 within each ``by``, counted in blocks of a bounded number of rows."""
    blocks = max(1, total // SLOT_BLOCK)
    blocked = rows.withColumn("block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    counts = blocked.groupBy(by, "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(by, "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy(by, "block").orderBy(*order))
    return (blocked.withColumn("at", inside).join(offsets, [by, "block"])
            .withColumn("slot", F.col("offset") + F.col("at") - 1).drop("block", "at", "offset"))


def _item(text):
    """Key of a group of equal texts; a null text is an empty one."""
    return F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.unhex(F.sha2(F.lit("").cast("binary"), 256)))


def _size(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``."""
    text = F.col("text")
    rows = settle(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit(b"")).alias("item")))
    groups = rows.groupBy("item").agg(F.sum("size").alias("size"))
    placed = settle(rows.join(shard_groups(groups, shards), "item"))
    numbered = number_slots(placed, "shard", placed.count(), ["doc_id", "text_crc32", "item"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write every row of ``docs`` once, with its columns, as Parquet, one folder per shard.

    Rows meet their shard by the digest of their text, which decides it, so null
    and repeated doc_ids lose and multiply nothing.  A column ``shard`` of the input gives way."""
    groups = docs.select(_item(F.col("text")).alias("item"), _size(F.col("text")).alias("size")).groupBy("item").agg(F.sum("size").alias("size"))
    place = settle(shard_groups(groups, shards).select(F.col("item").alias("__item"), "shard"))
    (docs.drop("shard").withColumn("__item", _item(F.col("text"))).join(place, "__item").drop("__item")
     .write.partitionBy("shard").parquet(path))
