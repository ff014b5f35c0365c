"""Token ids packed into fixed-length rows by best-fit decreasing.

Each document is tokenised (byte-level BPE, vocabulary file given by path),
closed with the end token, and cut into pieces of at most ``CONTEXT`` tokens,
so nothing is lost of an overlong one.  Pieces are packed by best-fit
decreasing: longest first, into the open row with the least room that still
suffices, found in a segment tree over remaining capacities.

A packed row holds the ids as little-endian binary (``uint16`` for
vocabularies up to 65,536, else ``uint32``), padded to ``CONTEXT`` with the end
token; ``cu_seqlens``, the cumulative segment lengths from 0; and, per segment, the
doc_id, the piece number and the position reset (where in the row position
ids start over from 0).  ``position_ids`` expands the resets.

Packing is local to a task: every task packs its own rows of the input in
windows of about ``WINDOW`` tokens, so the corpus is not shuffled and memory
is bounded whatever a partition holds.  A row is named by (part, row); part is
the task's input partition, so a task that runs again writes the same rows.

Null and empty texts give one piece with the end token only.  Null doc_ids
and repeated rows are packed like others.  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from dockhand.llm.common import text_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CONTEXT = 2048
WINDOW = 1 << 20
# Fixed value: the vocabulary's published split pattern.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SCHEMA = ("part int, row long, n_tokens int, input_ids binary, cu_seqlens array<int>, position_resets array<int>, "
          "doc_ids array<long>, pieces array<int>")
_ARROW = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()),
          pa.list_(pa.int64()), pa.list_(pa.int32())]
_NAMES = ["part", "row", "n_tokens", "input_ids", "cu_seqlens", "position_resets", "doc_ids", "pieces"]


def read_vocabulary(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes to id, from a local file of the driver or any path Spark reads."""
    try:
        with open(path, "rb") as f:
            lines = f.read().splitlines()
    except OSError:
        lines = [r[0].encode() for r in spark.read.text(path).collect()]  # one vocabulary file: bounded
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x)}


class CapacityTree:
    """Open rows by remaining capacity; a segment tree finds the least sufficient one."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def _add(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the fullest row that has room for ``need``, or None."""
        at = need + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):  # climb to a right sibling that holds rows
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indexes of the lengths in each row; every length is at most ``capacity``."""
    tree, rows = CapacityTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = tree.take(lengths[i])
        room, row = found if found else (capacity, len(rows))
        if not found:
            rows.append([])
        rows[row].append(i)
        if room > lengths[i]:
            tree.put(room - lengths[i], row)
    return rows


def _packed(part: int, first: int, window: list[tuple], context: int, end: int, dtype) -> pa.RecordBatch:
    rows = best_fit_decreasing([len(ids) for _, _, ids in window], context)
    out: list[tuple] = []
    for k, members in enumerate(rows):
        matrix, ends = np.full(context, end, dtype), [0]
        for i in members:
            ids = window[i][2]
            matrix[ends[-1]: ends[-1] + len(ids)] = ids
            ends.append(ends[-1] + len(ids))
        out.append((part, first + k, ends[-1], matrix.tobytes(), ends, ends[:-1],
                    [window[i][0] for i in members], [window[i][1] for i in members]))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ARROW, strict=True)], names=_NAMES)


def pack_batches(batches: Iterable[pa.RecordBatch], part: int, vocabulary: dict[bytes, int], context: int,
                 window_tokens: int) -> Iterator[pa.RecordBatch]:
    import tiktoken

    encoding = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
    end = max(vocabulary.values()) + 1
    dtype = np.dtype("<u2") if end < 1 << 16 else np.dtype("<u4")
    window: list[tuple] = []
    held = row = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = np.array([*encoding.encode_ordinary(text.as_py() or ""), end], dtype)
            for piece, lo in enumerate(range(0, len(ids), context)):
                window.append((doc_id, piece, ids[lo: lo + context]))
                held += len(window[-1][2])
                if held >= window_tokens:
                    done = _packed(part, row, window, context, end, dtype)
                    row, held, window = row + done.num_rows, 0, []
                    yield done
    if window:
        yield _packed(part, row, window, context, end, dtype)


def pack_tokens(docs: DataFrame, vocabulary_path: str = VOCABULARY, context: int = CONTEXT,
                window_tokens: int = WINDOW) -> DataFrame:
    """Packed rows (see ``SCHEMA``) of all documents (doc_id, text, ...)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_vocabulary(spark, vocabulary_path))

    def run(batches):
        yield from pack_batches(batches, TaskContext.get().partitionId(), shared.value, context, window_tokens)

    return text_batches(docs).selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, SCHEMA)


def position_ids(resets: list[int], context: int) -> np.ndarray:
    """Position of each token in its segment (the padding counts on)."""
    at = np.zeros(context, np.int64)
    at[resets] = resets
    return np.arange(context) - np.maximum.accumulate(at)
