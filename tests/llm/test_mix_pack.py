import math
from collections import Counter

import numpy as np
import pytest
import tiktoken
from helpers import awkward, docs, duck_folders
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockhand.llm import packing
from dockhand.llm.mixing import poisson_mix, source_rates
from dockhand.llm.packing import best_fit_decreasing, pack_tokens, position_ids, read_vocabulary
from dockhand.llm.queries import OP4_SQL, op4_poisson_mix
from oracle import compare


def test_rates_hit_the_target_shares(spark):
    table = docs(spark, ["x" * (50 + i % 7) for i in range(6000)])
    mixed = poisson_mix(table, weights={"s0": 0.6, "s1": 0.3, "s2": 0.1})
    share = Counter()
    for r in mixed.select("source", "text").collect():
        share[r["source"]] += len(r["text"]) + 1
    total = sum(share.values())
    assert abs(share["s0"] / total - 0.6) < 0.03 and abs(share["s2"] / total - 0.1) < 0.02
    assert abs(total / sum(51 + i % 7 for i in range(6000)) - 1) < 0.05


def test_counts_are_poisson_and_stable(spark):
    table = docs(spark, ["t"] * 9000)
    counts = Counter(r["doc_id"] for r in poisson_mix(table, epochs=1.5).collect())
    drawn = Counter(counts.get(i, 0) for i in range(9000))
    for k in range(5):
        p = math.exp(-1.5) * 1.5 ** k / math.factorial(k)
        assert abs(drawn[k] / 9000 - p) < 0.02
    assert Counter(r["doc_id"] for r in poisson_mix(table.repartition(7), epochs=1.5).collect()) == counts


def test_large_rates_do_not_underflow(spark):
    rates = source_rates(docs(spark, ["a"] * 3), weights={"s0": 1.0}, epochs=400.0).collect()
    assert len(rates) == 1 and rates[0]["rate"] == pytest.approx(1200)
    cdf = rates[0]["cdf"]
    assert cdf == sorted(cdf) and cdf[-1] == pytest.approx(1, abs=1e-9) and cdf[1200] == pytest.approx(0.5, abs=0.02)


def test_rows_without_an_own_id_are_drawn_one_by_one(spark):
    rows = [(None, f"text {i % 40}", "en", "a", 9) for i in range(2000)] + [(7, "same", "en", "b", 4)] * 2000 + [(100 + i, "own", "en", "c", 3) for i in range(2000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("replica", F.lit("mine"))
    for seed in ("x", "y", "z"):
        mixed = poisson_mix(table, epochs=1.0, seed=seed, weights={"a": 8.0, "b": 5.0, "c": 4.0})
        got = Counter(r["source"] for r in mixed.select("source").collect())
        total = sum({"a": 8.9, "b": 5.0, "c": 4.0}[s] * 2000 for s in "abc")
        for source, weight, size in (("a", 8, 8.75), ("b", 5, 5), ("c", 4, 4)):
            assert abs(got[source] * size / (total * weight / 17) - 1) < 0.12
        in_parts = mixed.groupBy("source", F.spark_partition_id().alias("part")).count().where("count > 0")
        assert mixed.rdd.getNumPartitions() == 1 or {r["source"]: r["n"] for r in in_parts.groupBy("source").agg(F.count("part").alias("n")).collect()}["b"] > 1
    again = poisson_mix(table.repartition(5), seed="x")
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, poisson_mix(table, seed="x").collect()))
    kept = poisson_mix(table, replica="copy")
    assert kept.columns == [*table.columns, "copy"] and {r["replica"] for r in kept.select("replica").distinct().collect()} == {"mine"}


def test_sql_of_the_mix_names_rows_alike(spark, tmp_path):
    rows = [(None, f"t{i % 5}", "en", "a", i % 2) for i in range(60)] + [(i % 30, "x\n" * (i % 3), None, "b", 1) for i in range(90)] + [(500, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    ok, message = compare(op4_poisson_mix(spark, str(tmp_path)), duck_folders(tmp_path, "documents"), OP4_SQL)
    assert ok, message


def test_mix_of_awkward_rows(spark):
    table = awkward(spark)
    mixed = poisson_mix(table, epochs=50.0)
    assert mixed.columns == [*table.columns, "replica"]
    assert {r["doc_id"] for r in mixed.select("doc_id").distinct().collect()} == {None, 1, 2, 3, 4, 5, 6, 7}
    assert poisson_mix(table.where("false")).count() == 0
    assert poisson_mix(table, weights={"absent": 1.0}).count() == 0
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_decreasing_equals_the_plain_rule(lengths):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else 64) - n)
    got = best_fit_decreasing(lengths, 64)
    assert sorted(i for row in got for i in row) == list(range(len(lengths)))
    assert sorted(64 - sum(lengths[i] for i in row) for row in got) == sorted(rooms)


def test_packed_rows_decode_to_the_texts(spark):
    table = docs(spark, ["Hello there, world.", "", None, "é ñ 漢字 \n\n tab\t", "long " * 900, "z" * 9000, "<|endoftext|>"] * 3)
    rows = pack_tokens(table, context=256, window_tokens=2000).collect()
    ranks = read_vocabulary(spark, packing.VOCABULARY)
    encoding = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces, end = {}, max(ranks.values()) + 1
    for r in rows:
        ids = np.frombuffer(bytes(r["input_ids"]), "<u2")
        cut = r["cu_seqlens"]
        assert len(ids) == 256 and cut[0] == 0 and cut[-1] == r["n_tokens"] and r["position_resets"] == cut[:-1]
        assert (ids[r["n_tokens"]:] == end).all()
        for k, (doc, piece) in enumerate(zip(r["doc_ids"], r["pieces"], strict=True)):
            assert (doc, piece) not in pieces
            pieces[doc, piece] = ids[cut[k]: cut[k + 1]].tolist()
    texts = {}
    for doc, piece in sorted(pieces):
        texts.setdefault(doc, []).extend(pieces[doc, piece])
    assert all(ids[-1] == end for ids in texts.values())
    assert {d: encoding.decode(ids[:-1]) for d, ids in texts.items()} == {r["doc_id"]: r["text"] or "" for r in table.collect()}
    assert len({(r["part"], r["row"]) for r in rows}) == len(rows)


def test_positions_and_awkward_rows(spark):
    assert position_ids([0, 3], 6).tolist() == [0, 1, 2, 0, 1, 2]
    rows = pack_tokens(awkward(spark)).collect()
    assert Counter(d for r in rows for d, p in zip(r["doc_ids"], r["pieces"], strict=True) if p == 0) == Counter([1, 2, 3, None, 4, 5, 5, 6, 7])
    assert pack_tokens(awkward(spark).where("false")).count() == 0


def test_long_runs_without_white_space_are_encoded_whole(spark):
    texts = ["hello,world;function(returned)" * 1000, "文字" * 5000, "Zm9vYmFy" * 3000]
    encoding = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=read_vocabulary(spark, packing.VOCABULARY), special_tokens={})
    got = {i: [] for i in range(len(texts))}
    found = [(d, p, np.frombuffer(bytes(r["input_ids"]), "<u2")[a:b].tolist()) for r in pack_tokens(docs(spark, texts)).collect()
             for d, p, a, b in zip(r["doc_ids"], r["pieces"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False)]
    for d, _, ids in sorted(found):
        got[d] += ids
    assert [got[i][:-1] for i in range(len(texts))] == [encoding.encode_ordinary(t) for t in texts]
