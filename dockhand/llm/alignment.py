"""Cross-tokenizer alignment by galloping intersection of token ends.

Two tokenizers cut the same bytes (a space and the text).  Each one's token
ends are a rising list of byte offsets.  The shorter list drives the search:
for a block of its ends, an exponential search in the longer list finds a
window that reaches the block's last end, and a binary search inside the
window places every end.  Ends found in both lists are common; they cut both
token sequences into groups.  The rank of a token's start and end in the
other list gives the range of the other's tokens that it overlaps.

A link is a pair of token occurrences whose byte ranges end together.  The
count of an id pair is the number of links that hold it in the whole corpus:
distinct pairs of each text are counted by the task that reads it, summed by a
shuffled aggregate, and looked up per text.  Pairs with more than one link in ``HOT`` are
fewer than ``HOT``, so they are broadcast; the rest meet their counts by a
shuffled join, where none of them is frequent enough to weigh on a task.

Null and empty texts, and texts whose joined token bytes differ from space+text
in either tokenizer (such as those that hold U+2581), have no tokens: zeros and an empty
digest.  Every row gives a row, repeated rows and null doc_ids included.  Very
long texts hand over their links in slices of ``SLICE`` pairs.  Other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import read_file, settle, settle_texts
from dockhand.llm.shingles import slices
from dockhand.llm.tokenizers_io import load_encoder

FIRST = "/opt/tokenizers/byte_bpe_50k.json"
SECOND = "/opt/tokenizers/piece_bpe_32k.model"
HOT = 1 << 18    # pairs with more than a HOT-th of all links: fewer than HOT rows of 17 bytes
BLOCK = 1 << 12  # ends placed by one exponential step
SLICE = 1 << 16  # id pairs in one record


def galloping_intersection(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in both rising lists of the values they share."""
    at_short, at_long = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    low = 0
    for at in range(0, len(short), BLOCK):
        block = short[at: at + BLOCK]
        step = len(block)
        while low + step < len(long) and long[low + step - 1] < block[-1]:
            step *= 2
        rank = low + np.searchsorted(long[low: low + step], block)
        inside = np.flatnonzero(rank < len(long))
        same = inside[long[rank[inside]] == block[inside]]
        at_short.append(at + same)
        at_long.append(rank[same])
        low = int(rank[-1])
    return np.concatenate(at_short), np.concatenate(at_long)


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the A and B tokens that end together, group by group."""
    if len(a_ends) <= len(b_ends):
        return galloping_intersection(a_ends, b_ends)
    b, a = galloping_intersection(b_ends, a_ends)
    return a, b


def overlap_ranges(ends: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token, the first and the last token of the other list that shares a byte with it."""
    starts = np.concatenate([[0], ends[:-1]])
    return np.searchsorted(other, starts, "right"), np.searchsorted(other, ends)


def _shown(ids: int) -> np.ndarray:
    """Each id in decimal before ``,``, ``|`` and ``;`` (entry 3 id + k): eight bytes, zero-filled, as one number."""
    if ids > 10_000_000:
        raise ValueError("ids of more than seven digits")
    return np.array([b"%d%s" % (i, mark) for i in range(ids) for mark in (b",", b"|", b";")], "S8").view(np.uint64)


class Aligner:
    """Both encoders, and the alignment of one text."""

    def __init__(self, first: tuple[str, bytes], second: tuple[str, bytes]):
        self.first, self.second = load_encoder(*first), load_encoder(*second)
        self._widths = [np.array([len(t) for t in e.token_bytes], np.int64) for e in (self.first, self.second)]
        self._bytes = [(np.frombuffer(b"".join(e.token_bytes), np.uint8), np.cumsum(w) - w)
                       for e, w in zip((self.first, self.second), self._widths, strict=True)]
        self._shown = [_shown(len(e.token_bytes)) for e in (self.first, self.second)]
        self.span = len(self.second.token_bytes)

    def _holds(self, side: int, ids: np.ndarray, wanted: np.ndarray) -> bool:
        """Whether the joined bytes of the tokens are ``wanted``."""
        blob, starts = self._bytes[side]
        widths = self._widths[side][ids]
        last = np.cumsum(widths)
        if not len(ids) or last[-1] != len(wanted):
            return False
        return bool((blob[np.arange(len(wanted)) + np.repeat(starts[ids] - last + widths, widths)] == wanted).all())

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(A ids, B ids, A group ends, B group ends) of each text: token indexes at which each group ends."""
        none = np.zeros(0, np.int64)
        given = [t or "" for t in texts]
        out = []
        for text, a, b in zip(given, self.first.encode(given), self.second.encode(given), strict=True):
            wanted = np.frombuffer(b" " + text.encode(), np.uint8)
            if text and self._holds(0, a, wanted) and self._holds(1, b, wanted):
                out.append((a, b, *common_ends(*self.ends(a, b))))
            else:
                out.append((none, none, none, none))
        return out

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(self._widths[0][a]), np.cumsum(self._widths[1][b])

    def groups_digest(self, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> str:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3``; nothing without tokens."""
        if not len(a):
            return ""
        sizes_a, sizes_b = np.diff(ga, prepend=-1), np.diff(gb, prepend=-1)
        # A's tokens of a group follow B's of all groups before; B's follow A's of the same group
        at_a = np.arange(len(a)) + np.repeat(gb + 1 - sizes_b, sizes_a)
        at_b = np.arange(len(b)) + np.repeat(ga + 1, sizes_b)
        laid = np.empty(len(a) + len(b), np.uint64)
        for at, ids, ends, close, shown in ((at_a, a, ga, 1, self._shown[0]), (at_b, b, gb, 2, self._shown[1])):
            code = ids * 3
            code[ends] += close
            laid[at] = shown[code]
        flat = laid.view(np.uint8)
        return hashlib.sha256(flat[flat != 0][:-1].tobytes()).hexdigest()  # no separator after the last group

    def pairs(self, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked id pairs (A id times the number of B ids, plus B id) and their links."""
        return np.unique(a[ga] * self.span + b[gb], return_counts=True)


_ALIGNED = ("doc_id long, a_ids array<int>, b_ids array<int>, a_group_ends array<int>, b_group_ends array<int>, "
            "b_first array<int>, b_last array<int>")


def align_tokens(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """Both tokenizations of every row's text, the token index at which each group ends on
    either side, and the range of B tokens that each A token overlaps."""
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast([(p, read_file(spark, p)) for p in (first, second)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*files.value)
        for batch in batches:
            for piece in slices(batch, "text"):
                rows = []
                for a, b, ga, gb in aligner.tokens(piece.column(1).to_pylist()):
                    rows.append((a, b, ga, gb, *overlap_ranges(*aligner.ends(a, b))))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *(pa.array([x.astype(np.int32) for x in c], pa.list_(pa.int32())) for c in zip(*rows, strict=True))],
                    names=["doc_id", "a_ids", "b_ids", "a_group_ends", "b_group_ends", "b_first", "b_last"])

    return settle_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ALIGNED))


_LINKED = ("row_id long, part_no int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
           "pairs array<long>, times array<int>")
_LINKED_ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
_LINKED_NAMES = [x.split()[0] for x in _LINKED.split(", ")]


def _linked(docs: DataFrame, first: str, second: str) -> tuple[DataFrame, int]:
    """Settled records (see ``_LINKED``), one or more for each row, and the number of B ids."""
    spark = docs.sparkSession
    files = [(p, read_file(spark, p)) for p in (first, second)]
    span = Aligner(*files).span
    shared = spark.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in slices(batch, "text"):
                out: list[tuple] = []
                found_all = aligner.tokens(piece.column(1).to_pylist())
                for doc_id, found in zip(piece.column(0).to_pylist(), found_all, strict=True):
                    keys, times = aligner.pairs(*found)
                    a, b, ga, _ = found
                    for k in range(0, max(1, len(keys)), SLICE):
                        facts = (len(a), len(b), len(ga), aligner.groups_digest(*found)) if not k else (None,) * 4
                        out.append((row_id, k // SLICE, doc_id, *facts, keys[k: k + SLICE], times[k: k + SLICE].astype(np.int32)))
                    row_id += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _LINKED_ARROW, strict=True)], names=_LINKED_NAMES)

    return settle_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _LINKED)), span


def _pair_counts(links: DataFrame, span: int) -> DataFrame:
    """(pair, count, best): links that hold each id pair, and whether no other pair of its B id has more."""
    counts = settle(links.groupBy("pair").agg(F.sum("n").alias("count")))
    b_id = F.pmod(F.col("pair"), F.lit(span))
    top = counts.groupBy(b_id.alias("b_id")).agg(F.max("count").alias("top"))  # a row for each B id: within the vocabulary
    return settle(counts.join(F.broadcast(top), b_id == F.col("b_id")).select("pair", "count", (F.col("count") == F.col("top")).alias("best")))


def align_corpus(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``."""
    records, span = _linked(docs, first, second)
    links = records.select("row_id", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("n"))))
    counts = _pair_counts(links.select("pair", F.col("n").cast("long").alias("n")), span)
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("count") * HOT > total))  # fewer than HOT rows by the threshold
    known = links.join(hot, "pair")
    rest = links.join(hot.select("pair"), "pair", "left_anti").join(counts.where(F.col("count") * HOT <= total), "pair")
    sums = [F.sum(x).alias(c) for c, x in (
        ("n_links", F.col("n").cast("long")), ("n_best", F.when(F.col("best"), F.col("n").cast("long")).otherwise(F.lit(0).cast("long"))),
        ("count_sum", F.col("n") * F.col("count")))]
    sides = [x.groupBy("row_id").agg(*sums) for x in (known, rest)]
    both = sides[0].unionByName(sides[1]).groupBy("row_id").agg(*(F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")))
    found = records.where("part_no = 0").select("row_id", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256").join(both, "row_id", "left")
    return found.select("doc_id", "n_a", "n_b", "n_groups",
                        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_links", "n_best", "count_sum")), "groups_sha256")
