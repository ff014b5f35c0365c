"""N-gram Jaccard join by PartEnum signatures (Arasu, Ganti, Kaushik 2006).

Documents whose distinct five-word shingle sets have a Jaccard similarity of
at least ``PERCENT`` / 100 are linked; the operator returns each document's
connected component.  The steps, all of them on distributed tables:

0. **Common shingles.** A hashed sample of the documents (one in ``SAMPLE``)
   names the shingles that are frequent (at most ``MOST_COMMON`` of them).  Which
   ones they are only decides the cost: any list gives the same links.
1. **Sets.** One pass over the texts gives, per document, the set's size, a
   128-bit key of the whole set, its signatures and a parity sketch.
   Documents with equal sets are one node, the smallest doc_id, from here on.
2. **Signatures.** Sets are dealt into size bands (2^(j-1), 2^j].  A band cuts
   the shingle domain into cells by hash; common shingles are left out of them.
   Sets at Jaccard 3/4 differ in at most (|u|+|v|)/7 <= |u|/3 shingles (u
   the smaller), each of which spoils one cell.  So if u fills more than |u|/3
   of the first c(|u|) cells, one filled cell must be equal in both sets: the
   content of a cell is a signature.  c grows with the size, so the larger set emits all
   that the smaller one relies on.  A set within 3/4 of its band's upper
   edge also emits for the next band, so any two sets that can be similar share
   a band.  A set that fills too few cells (mostly common shingles) emits all of them, which
   is enough when the other set of the pair fills its share, and goes to step 5 for the case
   that neither does.  Bands up to ``SMALL`` shingles use few cells, keep common shingles and
   enumerate the subsets of each cell that a similar set may share, which
   holds for any filling.
3. **Buckets.** Equal (band, cell, content) rows meet; each member is paired
   with the bucket's smallest id.  Pairs are refuted by size and by the parity
   sketch (a lower bound of the set difference), the rest compared exactly,
   and the links merged into components.
4. **The rest of a bucket.** Members of one component need no comparison.
   Buckets with several components and at most ``PAIR_CAP`` members compare
   their members across components.
5. **What is left**, that is larger buckets with several components and the sets set
   aside in step 2, is never paired up bucket by bucket: these documents go through a
   prefix filter (rarest shingles among them first), an exact way to every similar
   pair among them, whose buckets follow steps 3 and 4 without a cap; pairs
   that rare shingles alone put too far apart are not made.

Null and empty texts have no shingles, ``n_shingles`` 0 and link with
nothing.  Rows that share a doc_id are one document.  A null doc_id is
allowed: such a row takes the component of an equal set, else null.  Other
columns are ignored.  Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.common import discard, drop_rows, settle, small_batches, small_side, take_rows
from dockhand.llm.graph import connected_components
from dockhand.llm.shingles import mix, shingle_sets, slices

WORDS = 5
PERCENT = 75
SMALL = 64      # up to here a band's cells are enumerated, not only compared
CELL = 2        # shingles a cell holds on average at a band's upper edge
PAIR_CAP = 32   # larger mixed buckets go through the prefix filter
LOOSE = 1 << 62  # names of rows without a doc_id begin here
SALT = 16       # ways a very full bucket is first cut into, at least
PART_ROWS = 4096  # rows that such a part has on average, at most
SHARE = 16      # one set in so many is counted to find the very full buckets
SAMPLE = 32     # one document in so many is read for common shingles
MOST_COMMON = 2_000_000
_PLAIN = 0.88   # share of a set's shingles that the number of cells allows to be not common
_MIN_BITS, _MAX_BITS = 64, 1 << 16

FEATURES = "doc_id long, n_shingles long, set_hi long, set_lo long, unsafe boolean, sketch binary, sigs array<long>"


def _cells_emitted(size: int, cells: int) -> int:
    """Of ``cells``, the first so many hold more than size/3 filled ones (with
    a margin of several standard deviations) for a set of this size."""
    need = size / 3 + 1
    return min(cells, int(np.ceil((need + 3 * np.sqrt(need)) / -np.expm1(-_PLAIN * size / cells))))


def _bands(size: int) -> list[int]:
    band = max(1, int(size - 1).bit_length())
    return [band, band + 1] if 4 * size >= 3 * (1 << band) else [band]


def _cell_contents(hashes: np.ndarray, cells: int, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Filled cells and the sum of mixed members of each."""
    if not len(hashes):
        return np.zeros(0, np.int64), hashes
    seed = np.uint64(0xA5A5A5A5 * band + 7)
    cell = (mix(hashes ^ seed) >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)
    order = np.argsort(cell, kind="stable")
    cell, member = cell[order].astype(np.int64), mix(hashes[order] + seed)
    at = np.flatnonzero(np.diff(cell, prepend=-1))
    return cell[at], np.add.reduceat(member, at)


def is_common(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which hashes are in the sorted list ``common``."""
    if not len(common):
        return np.zeros(len(hashes), bool)
    return common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes


def signatures(hashes: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, bool]:
    """Signatures of a set, and whether it fills too few cells to rely on them alone."""
    size, out, unsafe = len(hashes), [], False
    plain = hashes[~is_common(hashes, common)]
    for band in _bands(size):
        upper = 1 << band
        tag = np.uint64(band << 48)
        if upper <= SMALL:
            cells = max(1, upper // (2 * CELL))
            seed = np.uint64(0xA5A5A5A5 * band + 7)
            cell = (mix(hashes ^ seed) >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)
            member = mix(hashes + seed)
            for c in np.unique(cell):
                own = [int(x) for x in member[cell == c]]
                total = sum(own)
                sums = [total - sum(gone) for k in range(len(own) // 4 + 1) for gone in combinations(own, k)]
                out.append(mix(np.array([x & 0xFFFFFFFFFFFFFFFF for x in sums], np.uint64) + tag + np.uint64(int(c) + 1)))
            continue
        cells = upper // CELL
        at, total = _cell_contents(plain, cells, band)
        kept = at < _cells_emitted(size, cells)
        if 3 * int(kept.sum()) <= size:
            unsafe, kept = True, np.ones(len(at), bool)
        out.append(mix(total[kept] + tag + at[kept].astype(np.uint64) + np.uint64(1)))
    return np.unique(np.concatenate(out)), unsafe


def parity_sketch(hashes: np.ndarray) -> bytes:
    """Parity of the members falling on each bit: two sketches (the longer one
    folded) differ in at most as many bits as the sets differ in members."""
    bits = min(_MAX_BITS, max(_MIN_BITS, 1 << int(len(hashes) - 1).bit_length()))
    at = (hashes & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    folded = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(folded ^ y).sum())


def _features(common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, rows = batch.column(0).to_pylist(), []
                for doc_id, hashes in zip(ids, shingle_sets(batch.column(1), WORDS), strict=True):
                    if not len(hashes):
                        rows.append((doc_id, 0, 0, 0, False, b"", []))
                        continue
                    key = xxhash.xxh3_128_intdigest(hashes.tobytes())
                    sigs, unsafe = signatures(hashes, common.value)
                    rows.append((doc_id, len(hashes), _signed(key >> 64), _signed(key & 0xFFFFFFFFFFFFFFFF), unsafe,
                                 parity_sketch(hashes), sigs.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW, strict=True)], names=_NAMES)

    return run


_NAMES = ["doc_id", "n_shingles", "set_hi", "set_lo", "unsafe", "sketch", "sigs"]
_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.int64())]


_MEMBERS = "id long, set long, n long, key long"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets = [h.tobytes() for h in shingle_sets(batch.column(1), WORDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "members"])


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(list(shingle_sets(batch.column(0), WORDS))).view(np.int64))], names=["key"])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets = list(shingle_sets(batch.column(1), WORDS))
            yield _exploded(batch.column(0), np.zeros(len(sets), np.int64), sets)


def _keyed_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets = [h.tobytes() for h in shingle_sets(batch.column(1), WORDS)]
            keys = [_signed(xxhash.xxh3_128_intdigest(x) >> 64) for x in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], names=["id", "set", "members"])


def _members_of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(2)]
        if sets:
            yield _exploded(batch.column(0), batch.column(1).to_numpy(zero_copy_only=False), sets)


def _exploded(ids: pa.Array, keys: np.ndarray, sets: list[np.ndarray]) -> pa.RecordBatch:
    sizes = np.array([len(s) for s in sets], np.int64)
    ids = ids.to_numpy(zero_copy_only=False).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, sizes)), pa.array(np.repeat(keys, sizes)), pa.array(np.repeat(sizes, sizes)),
                                       pa.array(np.concatenate(sets).view(np.int64))], names=["id", "set", "n", "key"])


def _near_by_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, na, nb, sa, sb = (batch.column(i).to_pylist() for i in range(6))
        keep = [sketch_distance(x, y) * 7 <= m + k for m, k, x, y in zip(na, nb, sa, sb, strict=True)]
        out = batch.filter(pa.array(keep, pa.bool_()))
        yield out.select(["a", "b"])


def _near_exactly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(u, v, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(u) + len(v) - both) and both > 0)
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def _linked(docs: DataFrame, meta: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of the candidate pairs (a, b), those that are similar."""
    left = meta.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    right = meta.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    sized = (pairs.join(left, "a").join(right, "b")
             .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT)
             .select("a", "b", "na", "nb", "sa", "sb"))
    near = settle(sized.mapInArrow(_near_by_sketch, "a long, b long"))
    if near.isEmpty():
        return near
    ids = settle(near.select(F.col("a").alias("doc_id")).unionByName(near.select(F.col("b").alias("doc_id"))).distinct())
    sets = settle(take_rows(docs, ids, "doc_id").select("doc_id", "text").mapInArrow(_sets, "id long, members binary"))
    full = (near.join(sets.toDF("a", "ma"), "a").join(sets.toDF("b", "mb"), "b").select("a", "b", "ma", "mb"))
    links = settle(full.mapInArrow(_near_exactly, "a long, b long").distinct(), release=True)
    discard(sets)
    return links


def _shared(rows: DataFrame, sample: DataFrame) -> DataFrame:
    """(key, id, leader) of every row whose key has another id.  The leader is the
    smallest id, or, where rows have an ``r`` (shingles that few other sets have), the
    id of least r: the set nearest to what its group has in common.  Keys that are frequent in ``sample``
    (of one id in ``SHARE``) are first cut into parts by id, as many as the count asks for, so that no task takes
    a whole hot bucket however large the corpus is; the parts' leaders are then brought together."""
    hot = settle(sample.groupBy("key").count().where("count >= 64"))
    if hot.isEmpty():
        return _led(rows, ["key"]).select("key", "id", F.col("lead.id").alias("leader"))
    parts = settle(_led(_salted(rows, hot), ["key", "salt"], keep_single=F.col("salt") >= 0), release=True)
    heads = settle(parts.where("salt >= 0").groupBy("key").agg(F.min("lead").alias("head")))
    return (parts.join(small_side(heads), "key", "left")
            .select("key", "id", F.coalesce("head.id", "lead.id").alias("leader")))


def _salted(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with the number of their part of a hot key, else -1; ``hot`` is (key, count in the sample)."""
    ways = F.greatest(F.lit(SALT), F.ceil(F.col("count") * SHARE / PART_ROWS))
    return (rows.join(small_side(hot.select("key", ways.cast("long").alias("ways"))), "key", "left")
            .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), F.col("ways")), F.lit(-1))).drop("ways"))


def _led(rows: DataFrame, by: list[str], keep_single=None) -> DataFrame:
    order = [c for c in ("r", "id") if c in rows.columns]
    w = Window.partitionBy(*by).orderBy(*order)
    led = rows.select(*by, "id", F.first(F.struct(*order)).over(w).alias("lead"), F.lead("id").over(w).alias("nxt"))
    met = (F.col("id") != F.col("lead.id")) | F.col("nxt").isNotNull()
    return led.where(met if keep_single is None else met | keep_single).drop("nxt")


def _pairs_with_leader(shared: DataFrame) -> DataFrame:
    return shared.where("id != leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()


def _labelled(shared: DataFrame, comp: DataFrame) -> DataFrame:
    """(key, id, comp) of the buckets that hold several components."""
    tagged = shared.join(comp, "id", "left").select("key", "id", "leader", F.coalesce("component", "id").alias("comp"))
    tagged = settle(tagged)
    mixed = settle(tagged.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                             F.count(F.lit(1)).alias("members")).where("lo < hi").select("key", "members"))
    return settle(tagged.join(small_side(mixed), "key"))


def _pairs_across(mixed: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """Pairs of a bucket's members in different components; those with the leader were compared before.

    ``own`` (id, n, r): sizes and how many shingles at most ``PAIR_CAP`` sets have.
    Give it for the large buckets of a prefix filter whose small buckets are paired in full: a
    pair met only in large ones shares none of those r (they stand before in the prefix), and the other
    shingles differ at least by their counts; the pair is possible only if that
    leaves the difference within 1/7 of both sizes.
    """
    mixed = mixed.where("id != leader")
    possible = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
    if own is not None:
        # a pair that shares several keys is made at the least of them only
        keys = mixed.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("keys"))
        mixed = mixed.join(own, "id").join(keys, "id")
        possible &= (F.col("ra") + F.col("rb") + F.abs(F.col("na") - F.col("ra") - F.col("nb") + F.col("rb"))) * 7 <= F.col("na") + F.col("nb")
    one, two = (mixed.select("key", F.col("id").alias(side), F.col("comp").alias(f"c{side}"),
                             *[F.col(c).alias(c + side) for c in ("n", "r", "keys") if c in mixed.columns]) for side in "ab")
    possible = (one["key"] == two["key"]) & possible
    if own is not None:
        possible &= F.array_min(F.array_intersect("keysa", "keysb")) == one["key"]
    return one.join(two, possible).select("a", "b").distinct()


def _rare_first(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefix rows (key, id, r): of each set, the rarest shingles (within ``ids``) of
    which any similar set has one; and (id, n, r) for ``_pairs_across``.

    An id that stands in several rows counts once per distinct set: each has its own
    prefix, and its own row of (id, n, r)."""
    rows = take_rows(docs, ids, "doc_id").select("doc_id", "text")
    several = settle(rows.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    repeated = not several.isEmpty()
    once = drop_rows(rows, several, "doc_id") if repeated else rows
    members = once.mapInArrow(_members, _MEMBERS)
    if repeated:
        sets = take_rows(rows, several, "doc_id").mapInArrow(_keyed_sets, "id long, set long, members binary")
        members = members.unionByName(sets.dropDuplicates(["id", "set"]).mapInArrow(_members_of_sets, _MEMBERS))
    members = settle(members)
    often = members.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    known = settle(members.join(often, "key", "left"))
    own = settle(known.groupBy("id", "set").agg(F.max("n").alias("n"), F.count_if(F.col("df").isNull()).alias("alone"),
                                                F.count_if(F.coalesce("df", F.lit(1)) <= PAIR_CAP).alias("r")))
    # shingles that no other set has stand first in the order: they use up the prefix without rows
    length = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - F.col("alone")
    rank = F.row_number().over(Window.partitionBy("id", "set").orderBy("df", "key"))
    ranked = known.where("df is not null").drop("n").withColumn("rank", rank).join(own, ["id", "set"]).where(F.col("rank") <= length)
    prefix = ranked.groupBy("key", "id").agg(F.min("r").alias("r")) if repeated else ranked.select("key", "id", "r")
    return settle(prefix), own.select("id", "n", "r").distinct() if repeated else own.select("id", "n", "r")


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the shingles frequent in the sample; the count they must
    reach rises with the sample, so that no more than ``MOST_COMMON`` can."""
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(SAMPLE)) == 0)
    counts = settle(sample.select("text").mapInArrow(_shingles, "key long").groupBy("key").count().where("count >= 4"))
    rows = counts.agg(F.sum("count")).first()[0] or 0
    least = max(4, -(-rows // MOST_COMMON))
    keys = counts.where(F.col("count") >= least).select("key").toArrow().column("key").to_numpy()
    return np.sort(keys.astype(np.int64).view(np.uint64))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs`` (doc_id, text, ...)."""
    with small_batches(docs.sparkSession):  # every step that reads texts is settled in here
        return _components(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))


def _components(docs: DataFrame) -> DataFrame:
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs))
    found = settle(docs.mapInArrow(_features(common), FEATURES))
    key = ["set_hi", "set_lo", "n_shingles"]
    # settled apart, so that the join below is a plain one whose hot sets Spark can split
    groups = settle(found.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep")))
    member = settle(found.select("doc_id", *key).join(groups, key, "left")
                    .select("doc_id", "n_shingles", "set_hi", F.coalesce("rep", "doc_id").alias("rep")))
    others = settle(member.where("doc_id != rep").select("doc_id", "set_hi", "rep").distinct())
    nodes = (found.where("n_shingles > 0 and doc_id is not null")
             .join(small_side(others.select("doc_id", "set_hi")), ["doc_id", "set_hi"], "left_anti"))
    meta = settle(nodes.select("doc_id", "n_shingles", "sketch", "unsafe"))
    # a doc_id with several texts is one document: it ties their sets together
    several = others.select("doc_id").unionByName(meta.select("doc_id")).groupBy("doc_id").count().where("count > 1")
    tied = settle(others.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    rows = nodes.select(F.explode("sigs").alias("key"), F.col("doc_id").alias("id"))
    sample = (nodes.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(SHARE)) == 0)
              .select(F.explode("sigs").alias("key")))
    shared = settle(_shared(rows, sample), release=True)
    discard(found)  # the signatures are the largest table; all that is read from here on was settled apart

    node_docs = docs.where("doc_id is not null")
    links = tied.unionByName(_linked(node_docs, meta, _pairs_with_leader(shared)))
    comp = connected_components(links)

    def with_links(*pairs: DataFrame) -> DataFrame:
        """Components after the similar ones among further candidate pairs."""
        nonlocal links
        more = [x for x in (_linked(node_docs, meta, p) for p in pairs) if not x.isEmpty()]
        for x in more:
            links = links.unionByName(x)
        return connected_components(links) if more else comp

    mixed = _labelled(shared, comp)
    few = F.col("members") <= PAIR_CAP
    crowd = settle(mixed.where(~few).select(F.col("id").alias("doc_id")).unionByName(meta.where("unsafe").select("doc_id")).distinct())
    if not mixed.isEmpty():
        comp = with_links(_pairs_across(mixed.where(few)))
    if not crowd.isEmpty():
        prefix, own = _rare_first(node_docs, crowd)
        shared = settle(_shared(prefix, prefix.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(SHARE)) == 0).select("key")))
        comp = with_links(_pairs_with_leader(shared))
        mixed = _labelled(shared, comp)
        if not mixed.isEmpty():
            comp = with_links(_pairs_across(mixed.where(few)).unionByName(_pairs_across(mixed.where(~few), own)).distinct())
    return (member.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")))


def keep_one_per_component(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` but those whose document links to a smaller doc_id.
    Repeated rows of the document that stays are kept once per row.

    A row without a doc_id is taken as a document named by its text, after all with an id;
    equal texts among such rows leave one."""
    loose = docs.where("doc_id is null")
    if loose.isEmpty():
        gone = settle(jaccard_components(docs).where("component_id < doc_id").select("doc_id").distinct())
        return drop_rows(docs, gone, "doc_id")
    by_text = F.xxhash64("text").bitwiseAND(F.lit(LOOSE - 1)).bitwiseOR(F.lit(LOOSE))
    keyed = settle(docs.withColumn("__doc", F.coalesce(F.col("doc_id").cast("long"), by_text)))
    gone = settle(jaccard_components(keyed.select(F.col("__doc").alias("doc_id"), "text")).where("component_id < doc_id")
                  .select(F.col("doc_id").alias("__doc")).distinct())
    kept = drop_rows(keyed, gone, "__doc")
    return kept.where("doc_id is not null").unionByName(kept.where("doc_id is null").dropDuplicates(["__doc"])).select(*docs.columns)
