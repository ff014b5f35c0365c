"""LM scoring by subword lattice likelihood.

A word (lower-cased A-Z, runs of bytes other than space and 0x09-0x0D) is a
space and its bytes.  Every way to cut these bytes into pieces of an existing
vocabulary is a path of a lattice; a path's probability is the product of its
pieces' weights.  A forward recursion in log space sums over all paths, so a
word gets its marginal probability, and a text that of its words and one end.
No piece used here holds a space after another character, so the lattice of a
text is the chain of its words' lattices, and each distinct word of the corpus
is scored once.

Pieces have their vocabulary's bytes and segmentation; their weights are
learned from all training documents: every distinct word counts its pieces as
often as it occurs, half a count is added to every piece and to the end.  Every
byte is a piece, so any word has a path.  (The files at hand hold merge ranks,
no probabilities, so there are no scores to take over.)

Scale: each task merges the words of the rows it reads before the shuffle, and
the table of distinct words, with its training counts and lattice scores,
grows with the corpus.  Words with more than a ``HOT``-th of all occurrences
are fewer than ``HOT``, so they are broadcast and added up while a text is read; the
others are joined by word, where none is frequent enough to weigh on a task.
Piece weights are bounded by the vocabulary.

A null text is empty: one end, no words.  A null doc_id is hashed as an empty
text, so its row is learned from.  Every row gives a row, repeated ones too.
Other columns are ignored; an empty table gives no rows.  Without training
documents every token is unknown and the pieces weigh the same.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.llm.common import read_file, settle_texts
from dockhand.llm.tokenizers_io import SPACE

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
HOT = 1 << 18      # words with more than a HOT-th of all occurrences: fewer than HOT
FLUSH = 1 << 17    # distinct words a task holds before it hands their counts on
PORTION = 1 << 14  # rows of an output batch


def held_out(doc_id: Column, folds: int = 5, held: int = 1) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == held


def words_of(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 bytes: both methods know only A-Z, space and 0x09-0x0D."""
    return text.lower().split() if text else []


def _portions(columns: dict[str, list], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(next(iter(columns.values()))), PORTION):
        yield pa.RecordBatch.from_arrays([pa.array(c[at: at + PORTION], t) for c, t in zip(columns.values(), types, strict=True)],
                                         names=list(columns))


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c, n): occurrences of every distinct word in training rows and in all rows of (text, held_out)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt: Counter = Counter()
        other: Counter = Counter()

        def flush():
            words = [*learnt, *(w for w in other if w not in learnt)]
            kinds = [pa.binary(), pa.int64(), pa.int64()]
            yield from _portions({"word": words, "c": [learnt[w] for w in words], "n": [learnt[w] + other[w] for w in words]}, kinds)

        for batch in batches:
            for text, held in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                (other if held else learnt).update(words_of(text.as_py()))
                if len(learnt) + len(other) > FLUSH:
                    yield from flush()
                    learnt, other = Counter(), Counter()
        yield from flush()

    found = docs.select(F.col("text").cast("binary").alias("text"), "held_out").mapInArrow(run, "word binary, c long, n long")
    return settle_texts(found.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")))


class Lattice:
    """Piece weights (natural logarithms, by bytes) and the forward recursion."""

    def __init__(self, weights: dict[bytes, float], end: float):
        self.weights, self.end = weights, end
        self.heads = {w[:k] for w in weights for k in range(1, len(w) + 1)}

    def log_probability(self, word: bytes) -> float:
        """Logarithm of the sum over all paths of space + ``word``."""
        body, weights, heads = b" " + word, self.weights, self.heads
        size = len(body)
        arcs: list[list[float] | None] = [None] * (size + 1)
        forward = 0.0
        for i in range(size):
            if i:
                into = arcs[i]
                arcs[i] = None
                if into is None:  # no path ends here
                    continue
                top = max(into)
                forward = top + math.log(sum([math.exp(x - top) for x in into])) if len(into) > 1 else top
            for j in range(i + 1, size + 1):
                piece = body[i:j]
                if piece not in heads:
                    break
                if piece in weights:
                    if arcs[j] is None:
                        arcs[j] = [forward + weights[piece]]
                    else:
                        arcs[j].append(forward + weights[piece])
        into = arcs[size]
        top = max(into)
        return top + math.log(sum(math.exp(x - top) for x in into))


def piece_bytes(model) -> dict[int, bytes]:
    """Bytes of the pieces a word may use: none that is special, none with a space after its start."""
    out = {}
    for i in range(model.vocab_size()):
        if model.is_byte(i):
            out[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            piece = model.id_to_piece(i)
            if SPACE not in piece[1:]:
                out[i] = piece.replace(SPACE, " ").encode()
    return out


def weigh(pieces: dict[int, bytes], counts: dict[int, int], ends: int) -> Lattice:
    """Weights with half a count added; pieces of the same bytes are one."""
    total = sum(counts.get(i, 0) for i in pieces) + ends + 0.5 * (len(pieces) + 1)
    share: dict[bytes, float] = {}
    for i, piece in pieces.items():
        share[piece] = share.get(piece, 0.0) + (counts.get(i, 0) + 0.5) / total
    return Lattice({w: math.log(p) for w, p in share.items()}, math.log((ends + 0.5) / total))


def fit_lattice(words: DataFrame, ends: int, data: bytes) -> Lattice:
    """Piece weights from the training counts of all distinct words."""
    import sentencepiece

    shared = words.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        counts: Counter = Counter()
        for batch in batches:
            texts = batch.column(0).cast(pa.string()).to_pylist()
            for ids, c in zip(model.encode(texts, num_threads=1), batch.column(1).to_pylist(), strict=True):
                for i in ids:
                    counts[i] += c
        yield from _portions({"id": list(counts), "c": list(counts.values())}, [pa.int32(), pa.int64()])

    found = words.where("c > 0").select("word", "c").mapInArrow(run, "id int, c long").groupBy("id").agg(F.sum("c").alias("c"))
    counts = {r["id"]: r["c"] for r in found.collect()}  # a row for each piece met: within the vocabulary
    return weigh(piece_bytes(sentencepiece.SentencePieceProcessor(model_proto=data)), counts, ends)


def score_words(words: DataFrame, lattice: Lattice) -> DataFrame:
    """(word, c, n, score) with the natural logarithm of each distinct word's marginal probability."""
    shared = words.sparkSession.sparkContext.broadcast((lattice.weights, lattice.end))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lattice(*shared.value)
        for batch in batches:
            scores = [own.log_probability(w.as_py()) for w in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=["word", "c", "n", "score"])

    return settle_texts(words.mapInArrow(run, "word binary, c long, n long, score double"))


_READ = ("row_id long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, "
         "words array<binary>, times array<int>")
_READ_ARROW = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32())]
_READ_NAMES = [x.split()[0] for x in _READ.split(", ")]


def _read_texts(docs: DataFrame, frequent: dict[bytes, tuple[int, float, float]]) -> DataFrame:
    """One settled record per row: the sums over frequent words, and the other words with their occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value.get
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for doc_id, text, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                found = words_of(text.as_py())
                known, base, score, rare, times = 0, 0.0, 0.0, [], []
                for word, n in Counter(found).items():
                    facts = of(word)
                    if facts is None:
                        rare.append(word)
                        times.append(n)
                    else:
                        known += n * facts[0]
                        base += n * facts[1]
                        score += n * facts[2]
                out.append((row_id, doc_id, held, len(found) + 1, known, base, score, rare, times))
                row_id += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _READ_ARROW, strict=True)], names=_READ_NAMES)

    return settle_texts(docs.select("doc_id", F.col("text").cast("binary").alias("text"), "held_out").mapInArrow(run, _READ))


def lattice_scores(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    ``base_score`` is the word model's smoothed log10 probability, ``score`` the lattice's."""
    spark: SparkSession = docs.sparkSession
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    words = count_words(given)
    ends = given.where("not held_out").count()
    sums = words.agg(F.sum("c"), F.sum("n"), F.count_if(F.col("c") > 0)).first()
    train_tokens, occurrences, kinds = (sums[0] or 0) + ends, sums[1] or 0, sums[2] + (ends > 0)
    lattice = fit_lattice(words, ends, read_file(spark, vocabulary))
    scored = score_words(words, lattice)

    room = train_tokens + 0.5 * (kinds + 1)
    known = (F.col("c") > 0).cast("int")
    base = F.log10((F.col("c") + F.lit(0.5)) / F.lit(room))
    facts = scored.select("word", "n", known.alias("known"), base.alias("base"), "score")
    hot = facts.where(F.col("n") * HOT > occurrences).drop("n").collect()  # fewer than HOT rows by the threshold
    read = _read_texts(given, {bytes(r["word"]): (r["known"], r["base"], r["score"]) for r in hot})

    rare = read.select("row_id", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("times"))))
    met = rare.join(facts.where(F.col("n") * HOT <= occurrences).drop("n"), "word")
    added = met.groupBy("row_id").agg(*(F.sum(F.col("times") * F.col(c)).alias(f"more_{c}") for c in ("known", "base", "score")))
    whole = read.drop("words", "times").join(added, "row_id", "left")

    def total(c: str) -> Column:
        return F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))

    return whole.select(
        "doc_id", "held_out", "n_tokens", (total("known") + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (total("base") + F.lit(math.log10((ends + 0.5) / room))).alias("base_score"),
        ((total("score") + F.lit(lattice.end)) / F.lit(math.log(10))).alias("score"))

