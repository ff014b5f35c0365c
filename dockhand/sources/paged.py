"""Paged scans with shard accounting (S6, S7, Q4), as a Python data source.

A scan is cut into slices; every slice is a chain of pages, each naming the
next one by its cursor, and is read by one task, a page at a time.  A page is a JSON envelope:

    {"_scroll_id": "next page or null",
     "hits": {"total": {"value": hits that the whole scan matches}, "hits": [{"_id": ..., "_source": {...}}, ...]},
     "_shards": {"total": 5, "successful": 4, "skipped": 1}}

A chain ends at a page without a cursor or without hits.  A page is partial
when successful + skipped shards are fewer than all: strict scans fail there,
tolerant ones go on, and ``page_report`` shows what was missed.

Pages lie in files: ``start-<slice>.json`` begins a chain, a cursor names a file of
the same folder.  Another transport needs another ``load``.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from dockhand.operators.batching import fixed_size_batches
from dockhand.sinks.batched import FolderSink, batched_write, open_folder
from dockhand.sources.documents import PAGE_SIZE

HITS = "_id string, _source string, slice int, page int"
PAGES = "slice int, page int, hits long, matched long, shards int, successful int, skipped int"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class PartialScanError(RuntimeError):
    """Some shards did not answer."""


@dataclass
class Slice(InputPartition):
    number: int
    folder: str
    first: str


class _Pages(DataSourceReader):
    def __init__(self, path: str, as_pages: bool, strict: bool):
        self.path, self.as_pages, self.strict = path, as_pages, strict

    def partitions(self) -> list[Slice]:
        """One partition a slice: the listing has a name for each start, not for each page."""
        from pyarrow import fs

        filesystem, root = open_folder(self.path)
        out = []
        for found in filesystem.get_file_info(fs.FileSelector(root, recursive=True)):
            stem = found.base_name.removesuffix(".json")
            if stem.startswith("start-") and "/_" not in found.path[len(root):]:
                out.append(Slice(int(stem[6:]), found.path.rsplit("/", 1)[0], stem))
        return out

    def load(self, at: Slice, cursor: str) -> dict:
        filesystem, _ = open_folder(self.path)
        with filesystem.open_input_stream(f"{at.folder}/{cursor}.json") as f:
            return json.loads(f.read())

    def read(self, partition: Slice) -> Iterator[tuple]:
        cursor, number = partition.first, 0
        while cursor:
            page = self.load(partition, cursor)
            hits, shards = page["hits"]["hits"], page["_shards"]
            if not hits:
                break
            if self.strict and shards["successful"] + shards["skipped"] < shards["total"]:
                raise PartialScanError(f"page {number} of slice {partition.number}: only {shards['successful']} "
                                       f"(+{shards['skipped']} skipped) of {shards['total']} shards answered")
            if self.as_pages:
                yield (partition.number, number, len(hits), page["hits"]["total"]["value"], shards["total"], shards["successful"], shards["skipped"])
            else:
                for hit in hits:
                    yield hit.get("_id"), json.dumps(hit.get("_source"), ensure_ascii=False), partition.number, number
            cursor, number = page.get("_scroll_id"), number + 1


def _scan(spark: SparkSession, path: str, as_pages: bool, strict: bool) -> DataFrame:
    name = f"dockhand_pages_{uuid.uuid4().hex[:12]}"

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return PAGES if as_pages else HITS

        def reader(self, schema) -> DataSourceReader:
            return _Pages(path, as_pages, strict)

    spark.dataSource.register(Source)
    return spark.read.format(name).load()


def paged_hits(spark: SparkSession, path: str, tolerant: bool = True) -> DataFrame:
    """(_id, _source as JSON text, slice, page) of every hit of every chain."""
    return _scan(spark, path, False, not tolerant)


def page_report(spark: SparkSession, path: str) -> DataFrame:
    """(slice, page, hits, matched, shards, successful, skipped, failed): one row a page."""
    pages = _scan(spark, path, True, False)
    return pages.withColumn("failed", F.greatest(F.lit(0), F.col("shards") - F.col("successful") - F.col("skipped")))


class _PageFiles(FolderSink):
    """Rows (name, body) as one file each; all chains of a write share a folder, so tasks' own folders are merged."""

    def open(self, part: int, attempt: int) -> str:
        super().open(part, attempt)
        return f"{part:05d}-{attempt}"

    def insert(self, handle: str, number: int, rows, columns) -> None:
        filesystem, root = open_folder(self._staged())
        for name, body in rows:
            with filesystem.open_output_stream(f"{root}/{handle}/{name}.json") as out:
                out.write(body.encode())

    def publish(self, handles, overwrite: bool) -> None:
        filesystem, root = open_folder(self._staged())
        merged = f"{root}/pages"
        filesystem.create_dir(merged, recursive=True)
        from pyarrow import fs

        for handle in handles:
            for found in filesystem.get_file_info(fs.FileSelector(f"{root}/{handle}")):
                filesystem.move(found.path, f"{merged}/{found.base_name}")
        super().publish([merged], overwrite)


def write_pages(spark: SparkSession, hits: DataFrame, path: str, order_by: list[str], source: Column, doc_id: Column, slices: int = 8,
                page_size: int = PAGE_SIZE, shards: Callable[[Column], Column] | None = None) -> str:
    """Write ``hits`` as chains of pages: ``page_size`` rows a page in ``order_by`` order, pages dealt to slices in turn.

    ``shards`` maps the page's number to its ``_shards`` struct (all successful by default)."""
    numbered = fixed_size_batches(hits.select(*order_by, doc_id.alias("__id"), source.alias("__source")), page_size, order_by)
    pages = numbered.groupBy("batch_id").agg(F.sort_array(F.collect_list(F.struct("batch_row", "__id", "__source"))).alias("rows"))
    last, matched = numbered.agg(F.max("batch_id"), F.count(F.lit(1))).first()
    n = F.col("batch_id")
    full = F.struct(F.lit(1).alias("total"), F.lit(1).alias("successful"), F.lit(0).alias("skipped"))
    body = F.to_json(F.struct(
        F.when(n + slices <= F.lit(last), F.concat(F.lit("page-"), (n + slices).cast("string"))).alias("_scroll_id"),
        F.struct(F.struct(F.lit(matched).alias("value")).alias("total"),
                 F.transform("rows", lambda r: F.struct(r["__id"].alias("_id"), r["__source"].alias("_source"))).alias("hits")).alias("hits"),
        (shards(n) if shards else full).alias("_shards")))
    name = F.when(n < slices, F.concat(F.lit("start-"), n.cast("string"))).otherwise(F.concat(F.lit("page-"), n.cast("string")))
    batched_write(pages.select(name.alias("name"), body.alias("body")), _PageFiles(path), batch_size=64)
    return path
