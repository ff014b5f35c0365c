"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

* **Terms** of a text are of two sorts.  Hashed trigrams of character shapes (letters
  fold to ``a``/``A``, digits to ``0``, everything else stays) read layout, case, symbols and
  punctuation; one term more counts words equal to the word before.  Hashed trigrams of its letters
  (A-Z lower-cased, bytes from 128 as they are, all else a space) read the language: random
  letters have the shapes of words, not their trigrams.
* **Vectors** are log-scaled shape counts and square roots of letter counts, each times inverse document
  frequency and scaled to length one, side by side, projected on the leading singular directions of the
  labelled sample and scaled to length one again.
* **Model.** A bounded sample of labelled rows: at most ``PER_CLASS`` of each
  class, the first by a hash of doc_id.  Of the good ones, one in ``SCRAMBLE`` is also learnt from
  with its letters a-z replaced at random, as a bad text: otherwise texts like none of the
  sample would pass at the base rate.  The sample does not grow with the
  corpus (some 4,250 vectors of ``RANK`` floats, 2 MB), so it is broadcast.
* **Score.** Every document's cosine products with all sample vectors are
  computed exactly, block by block; the ``NEIGHBOURS`` nearest vote with
  weight similarity ** ``POWER``, plus a vote of weight ``PRIOR`` for the base
  rate of all labelled rows (which decides texts that are near nothing).

Null and empty texts have no terms and score the base rate.  Without usable
labels, or with labels of one class only, every score is the base rate (0.5
without labels).  Of references that tie at the last neighbour any may vote.  Rows with a null label or doc_id teach nothing; a doc_id
with contradicting labels counts as its lowest.  Repeated rows score alike.
Labels, lang, source and doc_id never enter a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from dockhand.llm.common import text_batches
from dockhand.llm.shingles import slices, text_buffers, word_hashes

PER_CLASS = 2000
RANK = 96
SCRAMBLE = 8
SHAPE_SHARE = 0.6
NEIGHBOURS = 25
POWER = 8
PRIOR = 0.5
THRESHOLD = 0.7
TERMS = 1024
_SHAPES = TERMS + 1  # the last shape term: words that repeat the word before
_WIDTH = _SHAPES + TERMS
_NOISE = 2  # label of a scrambled text until it joins the bad ones
_BLOCK = 512
_PIECE = 1 << 20

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a"):ord("z") + 1] = _SHAPE[128:] = ord("a")
_SHAPE[ord("A"):ord("Z") + 1] = ord("A")
_SHAPE[ord("0"):ord("9") + 1] = ord("0")
_SHAPE[[9, 11, 12, 13]] = 32
_LETTER = np.full(256, 32, np.uint8)
_LETTER[128:] = np.arange(128, 256)
_LETTER[ord("a"):ord("z") + 1] = _LETTER[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


@dataclass
class QualityModel:
    idf: np.ndarray
    projection: np.ndarray
    references: np.ndarray
    labels: np.ndarray
    base_rate: float


def _trigrams(folded: np.ndarray) -> np.ndarray:
    """Counts of hashed trigrams of a text's folded bytes; those of three spaces are none."""
    out = np.zeros(TERMS, np.float32)
    for lo in range(0, max(0, len(folded) - 2), _PIECE):
        b = folded[lo: lo + _PIECE + 2].astype(np.uint32)
        h = b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(22)
        out += np.bincount(h[(b[:-2] != 32) | (b[1:-1] != 32) | (b[2:] != 32)], minlength=TERMS)
    return out


def term_counts(column: pa.Array) -> np.ndarray:
    """Counts of each text's terms, one row per text: shapes, repeated words, letters."""
    raw, offsets = text_buffers(column)
    out = np.zeros((len(column), _WIDTH), np.float32)
    words, per_text = word_hashes(raw, offsets)
    same = np.concatenate([[False], words[1:] == words[:-1]]) if len(words) else np.zeros(0, bool)
    at = 0
    for i in range(len(column)):
        text = raw[offsets[i]: offsets[i + 1]]
        out[i, :TERMS], out[i, _SHAPES:] = _trigrams(_SHAPE[text]), _trigrams(_LETTER[text])
        out[i, TERMS] = same[at + 1: at + per_text[i]].sum()
        at += per_text[i]
    return out


def scrambled(text: str) -> str:
    """The text with every letter a-z replaced by a random one (the same each time)."""
    raw = np.frombuffer(text.encode(), np.uint8).copy()
    small = (raw >= ord("a")) & (raw <= ord("z"))
    raw[small] = np.random.RandomState(zlib.crc32(raw.tobytes())).randint(ord("a"), ord("z") + 1, small.sum())
    return raw.tobytes().decode()


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Term vectors of length one; ``SHAPE_SHARE`` of its square is shapes, the rest letters."""
    shapes, letters = _unit(np.log1p(counts[:, :_SHAPES]) * idf[:_SHAPES]), _unit(np.sqrt(counts[:, _SHAPES:]) * idf[_SHAPES:])
    return _unit(np.concatenate([np.sqrt(SHAPE_SHARE) * shapes, np.sqrt(1 - SHAPE_SHARE) * letters], axis=1)).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            labels, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            noise = [scrambled(t) for y, t in zip(labels, texts, strict=True) if y == 1 and t and zlib.crc32(t.encode()) % SCRAMBLE == 0]
            packed = [zlib.compress(row.tobytes(), 1) for row in term_counts(pa.array(texts + noise, pa.string()))]
            yield pa.RecordBatch.from_arrays([pa.array(labels + [_NOISE] * len(noise), pa.int64()), pa.array(packed, pa.binary())], names=["label", "terms"])


def _unpacked(rows: list) -> np.ndarray:
    return np.frombuffer(b"".join(zlib.decompress(r["terms"]) for r in rows), np.float32).reshape(len(rows), _WIDTH)


def held_out(key: str = "doc_id"):
    """True for the quarter of ids that no label is learnt from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> QualityModel:
    """Fit on at most ``per_class`` labelled documents of each class, outside the held-out quarter."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
             .groupBy("doc_id").agg(F.min("quality").alias("label")))
    base = known.agg(F.avg("label")).first()[0]
    present = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    ids = None
    for label in (0, 1):  # bounded: the first per_class ids by hash
        some = present.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = some if ids is None else ids.unionByName(some)
    sample = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label")
              .agg(F.max("text").alias("text")).select(F.col("label").cast("long").alias("label"), "text"))
    # counts are mostly zeros: they travel compressed and are laid out a block of rows at a time
    rows = sample.mapInArrow(_counts_of, "label long, terms binary").collect()
    rows.sort(key=lambda r: (r["label"], r["terms"]))
    y = np.array([r["label"] for r in rows], np.float32)
    if not len(y) or not {0, 1} <= set(y.tolist()):
        return QualityModel(np.ones(_WIDTH, np.float32), np.zeros((_WIDTH, 1), np.float32),
                            np.zeros((0, 1), np.float32), np.zeros(0, np.float32), 0.5 if base is None else float(base))
    blocks = [slice(at, at + _BLOCK) for at in range(0, len(rows), _BLOCK)]
    seen = np.zeros(_WIDTH, np.int64)
    for block in blocks:
        seen += (_unpacked(rows[block])[y[block] != _NOISE] > 0).sum(0)
    idf = (np.log((1 + (y != _NOISE).sum()) / (1 + seen)) + 0.1).astype(np.float32)
    x = np.empty((len(rows), _WIDTH), np.float32)
    for block in blocks:
        x[block] = weighted(_unpacked(rows[block]), idf)
    y[y == _NOISE] = 0
    # right singular vectors of the sample, from its small Gram matrix
    _, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    projection = np.ascontiguousarray(vectors[:, ::-1][:, :RANK]).astype(np.float32)
    return QualityModel(idf, projection, _unit(x @ projection).astype(np.float32), y, float(base))


def score_texts(column: pa.Array, model: QualityModel) -> np.ndarray:
    """Scores (0 to 1) of the texts of an Arrow column."""
    counts = term_counts(column)
    if not len(model.labels):
        return np.full(len(counts), model.base_rate)
    vectors = _unit(weighted(counts, model.idf) @ model.projection).astype(np.float32)
    near, out = min(NEIGHBOURS, len(model.labels)), np.empty(len(counts))
    for at in range(0, len(counts), _BLOCK):
        cosine = vectors[at: at + _BLOCK] @ model.references.T
        top = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
        weight = np.maximum(np.take_along_axis(cosine, top, 1).astype(np.float64), 0) ** POWER
        votes = (weight * model.labels[top]).sum(1) + PRIOR * model.base_rate
        out[at: at + _BLOCK] = votes / (weight.sum(1) + PRIOR)
    out[counts.sum(1) == 0] = model.base_rate
    return np.clip(out, 0.0, 1.0)


def with_score(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """``docs`` with its columns and a double column ``name`` (which must be new)."""
    if name in docs.columns:
        raise ValueError(f"column {name} exists")
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        known = QualityModel(**shared.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                scores = score_texts(batch.column(batch.schema.get_field_index("text")), known)
                yield batch.append_column(name, pa.array(scores, pa.float64()))

    return text_batches(docs).mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``."""
    model = fit_quality(docs, labels)
    scored = with_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the classifier accepts, with their columns."""
    name = "__quality_score"
    return with_score(docs, fit_quality(docs, labels), name).where(F.col(name) >= THRESHOLD).drop(name)
