import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, components, docs, shingles, words
from hypothesis import given, settings
from hypothesis import strategies as st

from dockhand.llm import jaccard_join as J
from dockhand.llm.graph import connected_components
from dockhand.llm.shingles import shingle_sets, word_hashes, text_buffers


def _edited(rng, base, share):
    return [f"n{rng.randrange(10**6)}" if rng.random() < share else w for w in base]


def _corpus(seed=3):
    """Near copies at many distances and lengths, a passage shared by most, exact copies, short and empty texts."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for length in (3, 5, 6, 8, 12, 20, 40, 70, 150, 400):
        base = [f"b{length}_{i}" for i in range(length)]
        for share in (0, 0, 0.01, 0.02, 0.03, 0.05, 0.1):
            texts.append(" ".join(_edited(rng, base, share)))
    for k in range(60):  # a passage in unlike documents
        own = [f"o{k}_{i}" for i in range(rng.randrange(20, 120))]
        at = rng.randrange(len(own))
        texts.append("\n".join([" ".join(own[:at]), " ".join(passage), " ".join(own[at:])]))
    for k in range(12):  # mostly the passage: neither set fills its cells
        texts.append(" ".join(passage + [f"q{k}_{i}" for i in range(k)]))
    base = [f"c{i}" for i in range(200)]
    for _ in range(45):  # one large group of near copies
        texts.append(" ".join(_edited(rng, base, 0.012)))
    return texts + ["", None, "one", "ONE", "  one "]


@pytest.mark.parametrize("cap", [1, 32])
def test_components_equal_brute_force(spark, monkeypatch, cap):
    monkeypatch.setattr(J, "PAIR_CAP", cap)
    texts = _corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(docs(spark, texts)).collect()}
    sets = {i: shingles(words(t)) for i, t in enumerate(texts)}
    want = components(sets)
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_common_list_does_not_change_links(spark, monkeypatch):
    texts = _corpus(5)
    common = {h for t in texts[70:130] for s in shingle_sets(pa.array([t])) for h in s.tolist()}
    monkeypatch.setattr(J, "common_shingles", lambda docs: np.sort(np.array(list(common), np.uint64)))
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(docs(spark, texts)).collect()}
    assert got == components({i: shingles(words(t)) for i, t in enumerate(texts)})


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 200), st.integers(0, 200), st.booleans(), st.integers(0, 2**31))
def test_similar_sets_share_a_signature(both, a, b, marked, seed):
    rng = np.random.RandomState(seed)
    pool = np.unique(rng.randint(0, 2**63, both + a + b, dtype=np.int64).view(np.uint64))
    rng.shuffle(pool)
    u, v = np.sort(pool[: both + a]), np.sort(np.concatenate([pool[:both], pool[both + a:]]))
    common = np.sort(pool[: both // 3]) if marked else np.zeros(0, np.uint64)
    inter = len(np.intersect1d(u, v))
    (su, weak_u), (sv, weak_v) = J.signatures(u, common), J.signatures(v, common)
    if 100 * inter >= 75 * (len(u) + len(v) - inter):
        assert len(np.intersect1d(su, sv)) or (weak_u and weak_v)
    assert J.sketch_distance(J.parity_sketch(u), J.parity_sketch(v)) <= len(u) + len(v) - 2 * inter


def test_awkward_rows(spark):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_components(awkward(spark)).collect()), key=str)
    assert len(got) == 9
    by_id = {g[0]: g[1:] for g in got}
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[3] == (0, 3)
    assert by_id[5] == by_id[6] == (2, 5) and by_id[None] == (1, None) and by_id[7] == (1, 7)
    empty = awkward(spark).where("false")
    assert J.jaccard_components(empty).count() == 0


def test_rows_that_share_a_doc_id_are_one_document(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abc"}
    near = {k: t + " tail" for k, t in text.items()}
    rows = [(1, text["a"]), (5, text["a"]), (5, text["b"]), (7, near["b"]), (8, text["c"]), (5, near["c"]), (9, "x y z")]
    got = {(r["doc_id"], r["component_id"]) for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (5, 1), (7, 1), (8, 1), (9, 9)}


@pytest.mark.parametrize("cap", [1, 32])
def test_repeated_rows_lose_no_link_of_unsafe_sets(spark, monkeypatch, cap):
    rows, common, want = [], [], set()
    for k, times in enumerate((1, 2, 5, 1)):
        both = [f"s{k}_{i}" for i in range(90)]  # 86 shingles of both, 14 of each alone: 86 / 114
        x, y = (" ".join(both + [f"{name}{k}_{i}" for i in range(14)]) for name in "xy")
        rows += [(10 * k, x)] * times + [(10 * k + 1, y)]
        want |= {(10 * k, 10 * k), (10 * k + 1, 10 * k)}
        common += shingle_sets(pa.array([" ".join(both)]))
    other = " ".join([f"s3_{i}" for i in range(30)] + [f"z{i}" for i in range(74)])  # a second set of one doc_id
    rows += [(31, other), (32, other)]
    monkeypatch.setattr(J, "PAIR_CAP", cap)
    monkeypatch.setattr(J, "common_shingles", lambda docs: np.sort(np.concatenate(common)))
    got = {(r["doc_id"], r["component_id"]) for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want | {(32, 30)}


def test_repeated_rows_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(J, "PAIR_CAP", 1)
    texts = _corpus(7)
    rows = [(i, t) for i, t in enumerate(texts) for _ in range(1 + i % 3)]
    got = {(r["doc_id"], r["component_id"]) for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == set(components({i: shingles(words(t)) for i, t in enumerate(texts)}).items())


def test_one_of_each_group_stays_with_all_columns(spark):
    kept = J.keep_one_per_component(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 2, 3, 4, 5, 5, 7, None]


def test_a_hot_bucket_is_cut_by_its_count(spark, monkeypatch):
    monkeypatch.setattr(J, "PART_ROWS", 100)
    rows = spark.range(8000).selectExpr("id % 10 = 0 as rare", "id").selectExpr("if(rare, id % 7, -5) as key", "id")
    sample = rows.where(J.F.pmod(J.F.xxhash64("id", J.F.lit("sample")), J.F.lit(J.SHARE)) == 0).select("key")
    hot = sample.groupBy("key").count().where("count >= 64")
    salted = J._salted(rows, hot)
    parts = {(r["key"], r["salt"]): r["count"] for r in salted.groupBy("key", "salt").count().collect()}
    hot_parts = [n for (key, _), n in parts.items() if key == -5]
    assert sum(hot_parts) == 7200 and len(hot_parts) > 60 and max(hot_parts) < 200
    assert all(salt == -1 for key, salt in parts if key != -5)
    got = J._shared(rows, sample).collect()
    least = {-5: 1, **{k: min(i for i in range(0, 8000, 10) if i % 7 == k) for k in range(7)}}
    assert sorted(r["id"] for r in got) == list(range(8000)) and all(r["leader"] == least[r["key"]] for r in got)


def test_the_join_leaves_the_session_as_it_was(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "5000")
        assert J.jaccard_components(docs(spark, ["a b c d e f", "a b c d e f", "x"])).count() == 3
        assert spark.conf.get(key) == "5000"
    finally:
        spark.conf.set(key, before)


def test_word_hashes_follow_word_boundaries():
    column = pa.array(["a b", None, "", "A\tB", "ab", " a  b\n"])
    hashes, counts = word_hashes(*text_buffers(column))
    assert counts.tolist() == [2, 0, 0, 2, 1, 2]
    assert hashes[0] == hashes[2] == hashes[5] and hashes[1] == hashes[3] == hashes[6] and hashes[4] not in hashes[:2]


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    column = pa.array([" ".join(f"word{i}" for i in range(500)), "x" * 3000, "y z"])
    whole = word_hashes(*text_buffers(column))[0]
    monkeypatch.setattr("dockhand.llm.shingles.CHUNK", 64)
    assert (word_hashes(*text_buffers(column))[0] == whole).all()


def test_connected_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 300), (200, 301)] + [(500, k) for k in range(501, 560)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 300: 200, 301: 200, **{k: 500 for k in range(500, 560)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
