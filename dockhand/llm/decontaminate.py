"""Benchmark decontamination: size-partitioned MinHash containment search.

Short test items are looked up inside long documents.  An item is contained
in a document when at least ``CONTAINMENT`` of the item's distinct five-word
shingles occur in it (the document's length does not matter).

* Items are partitioned by the size of their shingle set, into classes
  (2^(c-1), 2^c].  A class has one sketch length, floor((1 - CONTAINMENT) *
  2^c) + 1: an item's sketch is that many of its smallest shingle hashes
  (bottom-k MinHash).  A document that holds the required share of an item
  misses fewer shingles than the sketch holds, so it holds one of the
  sketch: the search loses nothing, however long the document.
* Documents are not sketched: fixed-size signatures of both sides miss a
  30-shingle item in a 20,000-word document most of the time.  Each of their
  shingles is probed against the sketches instead, which is one pass over the
  texts and an equi-join (broadcast only while the counted sketch rows stay
  under a bound).
* Candidate (document, item) pairs are verified by exact shingle containment.

All of it is DataFrame functions.  Words are runs of letters and digits,
lower-cased, so case, punctuation and spacing do not hide a copy.  An item of
one to four words is one shingle of its own width and is probed with the documents' runs of
that width (done only for widths that items have); a null, empty or word-less item or document matches
nothing.  Rows that share a doc_id (or item_id) are one document (item), found if any of its
texts is; rows with a null id are not reported.  Repeated rows change
nothing.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import drop_rows, settle, small_side, take_rows

WORDS = 5
CONTAINMENT = 0.75


def _word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _runs(words: str, width: int) -> Column:
    """Hashes of all runs of ``width`` words of a materialised word-hash column, repeats included; shorter than
    ``WORDS``, they are hashed with their width, so runs of different widths never meet."""
    n = F.size(words)
    mark = [] if width == WORDS else [F.lit(width)]
    runs = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*mark, *[F.get(words, i + k) for k in range(width)]))
    return F.when(n >= width, runs).otherwise(F.array().cast("array<long>"))


def _words(rows: DataFrame, key: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).select(key, _word_hashes(F.col("text")).alias("words"))


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, width, item): the distinct shingle hashes of each text; one to four words are one shingle of their own width."""
    words = _words(benchmark.select("item_id", "text"), "item_id").withColumn("width", F.least(F.size("words"), F.lit(WORDS)))
    item = F.array().cast("array<long>")
    for width in range(1, WORDS + 1):
        item = F.when(F.col("width") == width, _runs("words", width)).otherwise(item)
    return words.select("item_id", "width", F.array_sort(F.array_distinct(item)).alias("item")).distinct()


def _with_shingles(rows: DataFrame, key: str, widths: list[int]) -> DataFrame:
    """(key, hashes) of rows with a key and a text: the runs of the widths that items have."""
    hashes = [_runs("words", w) for w in widths] or [F.array().cast("array<long>")]
    return _words(rows, key).select(key, (F.concat(*hashes) if len(hashes) > 1 else hashes[0]).alias("hashes"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, shared, item_size, containment) of every contained item."""
    items = settle(_items(benchmark)).where(F.size("item") > 0)
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # 1 to WORDS
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("item").cast("double"))))
    length = (F.floor(upper * (1 - CONTAINMENT)) + 1).cast("int")
    sketches = settle(items.select("item_id", F.explode(F.slice("item", F.lit(1), length)).alias("hash")))
    docs = docs.select("doc_id", "text")
    # explode_outer: for a plain explode the optimizer infers a filter on the array and pushes it below the
    # materialised words, where they would be split again for every shingle
    probes = _with_shingles(docs, "doc_id", widths).select("doc_id", F.explode_outer("hashes").alias("hash"))
    candidates = settle(probes.join(small_side(sketches), "hash").select("doc_id", "item_id").distinct())

    ids = settle(candidates.select("doc_id").distinct())
    held = (_with_shingles(take_rows(docs, ids, "doc_id"), "doc_id", widths)
            .join(candidates, "doc_id").join(items, "item_id"))
    shared = F.size(F.array_intersect("item", "hashes")).cast("long")
    return (held.select("doc_id", "item_id", shared.alias("shared"), F.size("item").cast("long").alias("item_size"))
            .where(F.col("shared") >= F.col("item_size") * CONTAINMENT)
            .groupBy("doc_id", "item_id").agg(F.max(F.struct("shared", "item_size")).alias("best"))
            .select("doc_id", "item_id", "best.shared", "best.item_size",
                    (F.col("best.shared") / F.col("best.item_size")).alias("containment")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item, with their columns.

    Rows are dropped by doc_id; those without one by their own text."""
    kept = drop_rows(docs, settle(contaminated(docs, benchmark).select("doc_id").distinct()), "doc_id")
    loose = docs.where("doc_id is null")
    if loose.isEmpty():
        return kept
    digest = F.xxhash64("text")
    bad = settle(contaminated(loose.select(digest.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__text")).distinct())
    named = kept.where("doc_id is not null")
    return named.unionByName(drop_rows(loose.withColumn("__text", digest), bad, "__text").select(*docs.columns))
