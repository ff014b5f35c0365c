"""Word-shingle hashing over Arrow string batches, vectorised with NumPy.

Words are maximal runs of bytes other than space and 0x09-0x0D, after
lower-casing A-Z.  A document's set is its distinct n-word shingles; a
document with fewer than n words (but at least one) has its whole sequence
as the one shingle; without words the set is empty.  Shingles are 64-bit
hashes of the word sequence, so equal sequences agree whatever white space
separated the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
_B = np.uint64(0x9E3779B97F4A7C15)
_B_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < size:
        grown = np.ones((2, max(size, CHUNK + 1)), np.uint64)
        grown[0, 1:], grown[1, 1:] = _B, _B_INV
        _POWERS["up"], _POWERS["down"] = np.cumprod(grown, axis=1, dtype=np.uint64)
    return _POWERS["up"][:size], _POWERS["down"][:size]


def _separators(raw: np.ndarray) -> np.ndarray:
    return (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))


def _hash_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial prefix hash of each [start, end) byte range, mixed."""
    low = raw + np.where((raw >= 0x41) & (raw <= 0x5A), np.uint8(32), np.uint8(0))
    up, down = _powers(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=prefix[1:])
    body = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(body ^ ((ends - starts).astype(np.uint64) * _MIX2))


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the concatenated texts, and words per text.

    Works through ``raw`` in pieces cut at word boundaries, so the per-byte
    arrays stay small however long a text is.
    """
    sep = _separators(raw)
    first = np.zeros(len(raw), bool)
    first[offsets[:-1][offsets[:-1] < len(raw)]] = True
    begins = ~sep
    begins[1:] &= sep[:-1] | first[1:]
    closes = ~sep
    closes[:-1] &= sep[1:] | first[1:]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, lo + CHUNK, "right")))
        hi = int(ends[to - 1])
        hashes[at:to] = _hash_words(raw[lo:hi], starts[at:to] - lo, ends[at:to] - lo)
        at = to
    bounds = np.searchsorted(starts, offsets)
    return hashes, np.diff(bounds)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct sorted shingle hashes of one text's word hashes."""
    if not len(words):
        return words
    width = min(n, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        total += words[k: len(words) - width + 1 + k] * _POW_ODD[k % len(_POW_ODD)]
    return np.unique(mix(total + np.uint64(width)))


_POW_ODD = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null reads as empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 * CHUNK) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``most_bytes`` of text (one text at least)."""
    _, offsets = text_buffers(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def shingle_sets(column: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of the column."""
    words, counts = word_hashes(*text_buffers(column))
    for part in np.split(words, np.cumsum(counts)[:-1]) if len(counts) else ():
        yield shingle_hashes(part, n)
