import os
import random
from collections import Counter

import pytest
from helpers import DOCS

import corpus_pipeline
from conftest import SF_SMALL
from dockhand.llm.packing import pack_tokens
from dockhand.session import read_table


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of tables: clean prose, junk, near copies, benchmark passages."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("aeiourstln") for _ in range(rng.randrange(2, 9))) for _ in range(4000)]

    def prose(n):
        ws = [rng.choice(vocabulary) for _ in range(n)]
        return " ".join(w.capitalize() if i % 11 == 0 else w + "." if i % 11 == 10 else w for i, w in enumerate(ws))

    clean = [prose(rng.randrange(60, 200)) for _ in range(120)]
    junk = [" | ".join(prose(80).split()) for _ in range(30)] + ["!! ".join(prose(80).upper().split()) for _ in range(30)]
    copies = [c.replace(" ", "  ", 3) + " tail" for c in clean[:10]]
    items = [prose(30) for _ in range(5)]
    leaks = [f"{prose(60)}\n{item}\n{prose(60)}" for item in items]
    texts = clean + junk + copies + leaks + ["", None]
    root = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, int(not 120 <= i < 180), 0) for i in range(len(texts)) if i % 2], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, texts


def test_each_stage_takes_effect(spark, tables):
    root, texts = tables
    docs = read_table(spark, root, "documents")
    names, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, root).cache()
        assert docs.columns == names
        ids[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
    after = iter(ids.values())
    first = set(next(after))
    assert not first & set(range(120, 180)) and set(range(120)) <= first
    second = set(next(after))
    assert second == first - set(range(180, 190))
    third = set(next(after))
    assert third == second - set(range(190, 195))
    mixed = Counter(next(after))
    assert set(mixed) <= third and 0.6 < sum(mixed.values()) / len(third) < 1.5
    assert all(r["text"] == texts[r["doc_id"]] for r in docs.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, root).collect()
    pieces = Counter(d for r in packed for d, p in zip(r["doc_ids"], r["pieces"], strict=True) if p == 0)
    assert pieces == mixed


def test_run_equals_the_stages(spark, tables):
    root, _ = tables
    tokens = lambda rows: sum(r["n_tokens"] for r in rows)
    docs = read_table(spark, root, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, root)
    assert tokens(corpus_pipeline.run(spark, root).collect()) == tokens(docs.collect())


def test_order_and_empty_documents(spark, tables, tmp_path):
    root, _ = tables
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination",
                                                      "mixing sources to target weights", "token-ID / binary output"]
    empty = str(tmp_path)
    read_table(spark, root, "documents").where("false").write.parquet(os.path.join(empty, "documents.parquet"))
    for t in ("labels", "benchmark"):
        read_table(spark, root, t).write.parquet(os.path.join(empty, f"{t}.parquet"))
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_runs_on_the_given_tables(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL)
    whole = pack_tokens(read_table(spark, SF_SMALL, "documents"))
    assert 0 < rows.count() and rows.columns == whole.columns


def test_rows_without_a_doc_id_are_decided_by_their_text(spark, tables):
    from dockhand.llm.decontaminate import drop_contaminated
    from dockhand.llm.jaccard_join import keep_one_per_component
    root, texts = tables
    rows = [(1, texts[0]), (None, texts[0]), (None, texts[0]), (None, texts[0] + " end"), (None, texts[1]), (None, texts[1]), (None, texts[190]), (2, texts[2])]
    docs = spark.createDataFrame([(i, t, "en", None, 0) for i, t in rows], DOCS)
    kept = keep_one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=str) == sorted(
        [(1, texts[0]), (2, texts[2]), (None, texts[1]), (None, texts[190])], key=str)
    clean = drop_contaminated(docs, read_table(spark, root, "benchmark"))
    assert clean.count() == 7 and clean.where(docs["text"] == texts[190]).count() == 0
