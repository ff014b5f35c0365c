import random
import re

from helpers import awkward, docs, shingles

from dockhand.llm.decontaminate import contaminated, drop_contaminated


def _words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def test_equals_brute_force_containment(spark):
    rng = random.Random(1)
    items = [" ".join(f"i{k}w{j}" for j in range(n)) for k, n in enumerate((1, 2, 4, 5, 9, 12, 30, 33, 64, 200))]
    texts = []
    for item in items:
        ws = item.split()
        for cut in (1.0, 0.9, 0.8, 0.7, 0.5):
            part = ws[: max(1, int(len(ws) * cut))]
            for noise in (0, 40, 3000):
                pad = [f"z{rng.randrange(10**6)}" for _ in range(noise)]
                texts.append(" ".join(pad[: noise // 2]) + "\n" + ", ".join(part).upper() + ". " + " ".join(pad[noise // 2:]))
    bench = spark.createDataFrame(list(enumerate([*items, "", None])), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["shared"], r["item_size"]) for r in contaminated(docs(spark, texts), bench).collect()}
    want = {}
    for d, text in enumerate(texts):
        for k, item in enumerate(items):
            width = min(5, len(_words(item)))
            have, need = shingles(_words(text), width), shingles(_words(item), width)
            if len(_words(text)) < width:
                have = set()
            if len(need & have) >= 0.75 * len(need):
                want[d, k] = (len(need & have), len(need))
    assert got == want and len(want) > 40


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "one TWO three, four five six", "a"), (1, "other text of the same item id", "a"), (2, None, "a"), (3, "", "b"),
                                   (None, "one two three four five six", "c"), (4, "some words", "d")], "item_id long, text string, lang string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(awkward(spark), bench).collect()}
    assert got == {(5, 1), (6, 1)}
    kept = drop_contaminated(awkward(spark), bench)
    assert kept.columns == awkward(spark).columns and kept.count() == 5  # the row without a doc_id holds item 4
    assert contaminated(awkward(spark).where("false"), bench).count() == 0
    assert drop_contaminated(awkward(spark), bench.where("false")).count() == 9


def test_short_items_inside_documents(spark):
    from conftest import SF_SMALL
    from dockhand.llm.queries import OP1_SQL
    from oracle import compare, duck
    bench = spark.createDataFrame([(1, "Paris is the capital"), (2, "Paris"), (3, "one two three four five six"), (4, "capital of")], "item_id long, text string")
    table = docs(spark, ["well, paris is THE capital of it all", "paris", "is the capital", "zero one two three four five six seven", "the capital"])
    got = contaminated(table, bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(0, 1), (0, 2), (0, 4), (1, 2), (3, 3)}
    con = duck(SF_SMALL)
    for name, frame in (("documents", table), ("benchmark", bench)):
        pdf = frame.toPandas()  # noqa: F841  (read by name)
        con.execute(f"CREATE OR REPLACE TEMP TABLE t_{name} AS SELECT * FROM pdf")
    ok, why = compare(got, con, OP1_SQL.replace("FROM documents", "FROM t_documents").replace("FROM benchmark", "FROM t_benchmark"))
    assert ok, why


def test_no_python_on_the_main_path(spark):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    plan = contaminated(awkward(spark), bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
