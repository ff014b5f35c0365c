import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from helpers import awkward, docs

from conftest import SF_SMALL
from dockhand.llm import sharding
from dockhand.llm.digest_index import DigestIndex, dedupe, digests_of
from dockhand.llm.sharding import karmarkar_karp, shard_documents, write_shards


def _plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_dedupe_awkward_rows(spark, tmp_dir):
    index = DigestIndex(spark, f"{tmp_dir}/i", buckets=4)
    got = dedupe(awkward(spark), index, batches=3).collect()
    rows = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got), key=str)
    assert rows == sorted([(1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True), (None, None, 1, True), (4, 4, 1, True),
                           (5, 5, 2, True), (5, 5, 2, False), (6, 6, 1, True), (7, 7, 1, True)], key=str)
    assert next(r for r in got if r["doc_id"] == 1)["text_sha256"] == hashlib.sha256(b"").hexdigest()


def test_index_persists_and_adding_again_changes_nothing(spark, tmp_dir):
    first = docs(spark, ["a b", "a  b", "c"])
    index = DigestIndex(spark, f"{tmp_dir}/i", buckets=4)
    dedupe(first, index)
    again = DigestIndex(spark, f"{tmp_dir}/i", buckets=9)
    assert again.buckets == 4 and again.known().count() == 2
    again.add(digests_of(first))
    assert again.entries().count() == 2
    later = dedupe(docs(spark, ["c", "d"], first=10), again).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in later} == {(10, 2, False), (11, 11, True)}
    assert dedupe(first.where("false"), again).count() == 0 and again.entries().count() == 3


def test_one_row_of_equal_rows_is_kept(spark, tmp_dir):
    table = spark.createDataFrame([(5, "x")] * 3 + [(None, "y")] * 2 + [(9, "x")], "doc_id long, text string").repartition(3)
    index = DigestIndex(spark, f"{tmp_dir}/i", buckets=4)
    got = dedupe(table, index).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == Counter(
        {(5, 5, 4, True): 1, (5, 5, 4, False): 2, (9, 5, 4, False): 1, (None, None, 2, True): 1, (None, None, 2, False): 1})
    index.close()
    assert not spark.catalog.tableExists(index.table)
    assert DigestIndex(spark, f"{tmp_dir}/i").known().count() == 2


def test_anti_join_reads_the_index_in_its_buckets(spark, tmp_dir):
    index = DigestIndex(spark, f"{tmp_dir}/i", buckets=8)
    index.add(digests_of(docs(spark, ["a", "b"])))
    batch = digests_of(docs(spark, ["b", "c"])).groupBy("digest").count().repartition(8, "digest").hint("merge")
    plan = batch.join(index.known().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    sizes = batch.select("digest", "count")
    plan = sizes.join(index.known().hint("merge"), "digest")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # that of the new digests: the index is not shuffled


def test_karmarkar_karp_balances():
    rng = np.random.RandomState(1)
    for n, k in ((0, 3), (1, 4), (3, 5), (500, 16), (2000, 7)):
        sizes = rng.lognormal(7, 1.5, n).astype(np.int64)
        part = karmarkar_karp(sizes, k)
        assert len(part) == n and (n == 0 or 0 <= part.min() and part.max() < k)
        sums = np.bincount(part, sizes, minlength=k)
        if n >= 500:
            assert sums.max() - sums.min() <= max(1, sizes.sum() // k // 1000)
    assert sorted(np.bincount(karmarkar_karp(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])) == [14, 16]


def plain_differencing(sizes, k):
    """Sums of the parts by Karmarkar-Karp on plain lists."""
    parts = [sorted([0] * (k - 1) + [int(x)]) for x in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[-1] - p[0])
        a, b = parts.pop(), parts.pop()
        parts.append(sorted(x + y for x, y in zip(a, reversed(b), strict=True)))
    return parts[0] if parts else [0] * k


def test_karmarkar_karp_equals_the_plain_rule():
    rng = np.random.RandomState(3)
    for n, k in ((2, 2), (9, 2), (40, 3), (200, 5), (300, 16)):
        sizes = rng.choice(10 ** 9, n, replace=False)  # no ties
        part = karmarkar_karp(sizes, k)
        got = sorted(int(x) for x in np.bincount(part, sizes, minlength=k))
        want = plain_differencing(sizes, k)
        assert [x - got[0] for x in got] == [x - want[0] for x in want]


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TOP", 60)
    monkeypatch.setattr(sharding, "CHUNK", 50)
    monkeypatch.setattr(sharding, "BUNDLES", 8)
    monkeypatch.setattr(sharding, "SLOT_BLOCK", 20)
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = shard_documents(table, 4).collect()
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    assert len(got) == len(texts)
    by_shard, by_text = defaultdict(list), defaultdict(set)
    for r in got:
        data = texts[r["doc_id"]].encode()
        assert r["size"] == len(data) + 1 and r["text_crc32"] == zlib.crc32(data) and r["law"] == "bytes" and r["grown_shard"] is None
        by_shard[r["shard"]].append((r["slot"], r["size"]))
        by_text[data].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s for s, _ in rows) == list(range(len(rows))) for rows in by_shard.values())
    sums = [sum(b for _, b in rows) for rows in by_shard.values()]
    assert len(sums) == 4 and max(sums) - min(sums) < 0.05 * max(sums)


def test_shards_of_awkward_rows(spark, tmp_dir):
    got = shard_documents(awkward(spark)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter([1, 2, 3, None, 4, 5, 5, 6, 7])
    assert next(r for r in got if r["doc_id"] == 1)["size"] == 1 and len({r["shard"] for r in got if r["doc_id"] == 5}) == 1
    assert len({(r["shard"], r["slot"]) for r in got}) == 9
    assert shard_documents(awkward(spark).where("false")).count() == 0
    write_shards(docs(spark, ["a", "b", "c"]), f"{tmp_dir}/s", 2)
    assert spark.read.parquet(f"{tmp_dir}/s").count() == 3
    rows = [(1, "a", "k"), (None, "b", "k"), (None, None, "k"), (2, "c", "k"), (2, "dd", "k")]
    write_shards(spark.createDataFrame(rows, "doc_id long, text string, shard string"), f"{tmp_dir}/t", 2)
    back = spark.read.parquet(f"{tmp_dir}/t").select("doc_id", "text").collect()
    assert Counter(map(tuple, back)) == Counter(r[:2] for r in rows)
