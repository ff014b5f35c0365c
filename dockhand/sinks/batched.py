"""Batched two-phase writes through Spark's Python data source API (W11 without a database).

Every task hands its rows to a sink in batches of ``batch_size``; what it
wrote stays staged and is reported in one commit message.  Only when all
tasks have succeeded does the driver publish the staged work, in one step;
when any task fails for good, it discards it, so readers see all rows of a
write or none.  A task that is retried or runs twice stages its rows under
another name, and only the attempt whose message arrived is published.

A sink is any picklable object with the methods of ``FolderSink``: a database
sink would stage into a side table and publish by one transaction.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from typing import Any

from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


BATCH_SIZE = 10_000  # rows of one call to the sink

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package


def open_folder(uri: str):
    """(file system, path) of a folder, for processes that have no JVM."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def json_lines(rows: Sequence[tuple], columns: Sequence[str]) -> bytes:
    """One JSON object a row; values that JSON lacks are written as text."""
    return "".join(json.dumps(dict(zip(columns, r, strict=True)), default=str) + "\n" for r in rows).encode()


class FolderSink:
    """Batches as files under ``path``, each write in a folder of its own.

    Staged files lie in a folder whose name begins with ``_``, which Spark's
    readers skip; publishing is one rename of that folder.
    """

    def __init__(self, path: str, encode: Callable[[Sequence[tuple], Sequence[str]], bytes] = json_lines, suffix: str = "json"):
        self.path, self.encode, self.suffix = path.rstrip("/"), encode, suffix
        self.write_id = uuid.uuid4().hex[:12]

    def _staged(self) -> str:
        return f"{self.path}/_staged-{self.write_id}"

    def open(self, part: int, attempt: int) -> str:
        """Where an attempt of a task stages its batches."""
        filesystem, root = open_folder(self._staged())
        at = f"{root}/{part:05d}-{attempt}"
        filesystem.create_dir(at, recursive=True)
        return at

    def insert(self, handle: str, number: int, rows: Sequence[tuple], columns: Sequence[str]) -> None:
        """One batch."""
        filesystem, _ = open_folder(self.path)
        with filesystem.open_output_stream(f"{handle}/batch-{number:06d}.{self.suffix}") as out:
            out.write(self.encode(rows, columns))

    def publish(self, handles: Sequence[str], overwrite: bool) -> None:
        """Show the work of these attempts, and of no others; ``overwrite`` drops what was published before."""
        from pyarrow import fs

        filesystem, root = open_folder(self.path)
        _, staged = open_folder(self._staged())
        kept = {h.rsplit("/", 1)[1] for h in handles}
        filesystem.create_dir(staged, recursive=True)
        for found in filesystem.get_file_info(fs.FileSelector(staged)):
            if found.base_name not in kept:  # an attempt that failed, or one of two that ran
                filesystem.delete_dir(found.path)
        old = [f.path for f in filesystem.get_file_info(fs.FileSelector(root)) if f.base_name.startswith("write-")]
        filesystem.move(staged, f"{root}/write-{self.write_id}")
        for path in old if overwrite else ():
            filesystem.delete_dir(path)

    def discard(self) -> None:
        filesystem, staged = open_folder(self._staged())
        if filesystem.get_file_info(staged).type.name == "Directory":
            filesystem.delete_dir(staged)


@dataclass
class Staged(WriterCommitMessage):
    """What one task reports."""

    handle: Any
    rows: int
    batches: int


class _Writer(DataSourceWriter):
    def __init__(self, sink: Any, batch_size: int, columns: list[str], overwrite: bool):
        self.sink, self.batch_size, self.columns, self.overwrite = sink, batch_size, columns, overwrite

    def write(self, iterator: Iterator) -> Staged:
        context = TaskContext.get()
        handle = self.sink.open(context.partitionId(), context.taskAttemptId())
        rows = batches = 0
        rest = (tuple(r) for r in iterator)
        while batch := list(islice(rest, self.batch_size)):
            self.sink.insert(handle, batches, batch, self.columns)
            rows, batches = rows + len(batch), batches + 1
        return Staged(handle, rows, batches)

    def commit(self, messages: list) -> None:
        self.sink.publish([m.handle for m in messages if m is not None], self.overwrite)

    def abort(self, messages: list) -> None:
        self.sink.discard()


def batched_write(df: DataFrame, sink: Any, batch_size: int = BATCH_SIZE, mode: str = "append") -> None:
    """Write ``df`` through ``sink`` in batches; all rows become visible together, or none."""
    if batch_size < 1:
        raise ValueError("batch size must be >= 1")
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be append or overwrite")
    columns, name = df.columns, f"dockhand_batched_{uuid.uuid4().hex[:12]}"

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return _Writer(sink, batch_size, columns, overwrite)

    df.sparkSession.dataSource.register(Source)
    df.write.format(name).mode(mode).save()
