import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from dockhand.operators.keyed import latest_per_key
from dockhand.operators.merge import (append_load, delete_then_insert, upsert_accumulate, upsert_expr,
                                      upsert_ignore, upsert_update)

SCHEMA = "id bigint, name string, amount double, updated timestamp_ntz"


@pytest.fixture(params=["broadcast", "shuffle"], autouse=True)
def join_path(request, spark):
    """Run every merge test on both join paths (size check passes / fails)."""
    from dockhand.operators.merge import BROADCAST_ROWS_CONF
    spark.conf.set(BROADCAST_ROWS_CONF, "1000000" if request.param == "broadcast" else "0")
    yield request.param
    spark.conf.unset(BROADCAST_ROWS_CONF)
D = dt.datetime(2024, 1, 1)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([
        (1, "a", 10.0, D), (2, "b", 20.0, D), (3, "c", None, D), (None, "tnull", 1.0, D)], SCHEMA)


@pytest.fixture
def incoming(spark):
    # matched (1), matched with NULL value (2), new (4), NULL key, duplicate key 5 (ord 1, 2)
    return spark.createDataFrame([
        (1, "A", 11.0, D, 1), (2, "B", None, D, 1), (4, "D", 40.0, D, 1), (None, "snull", 2.0, D, 1),
        (5, "E1", 50.0, D, 1), (5, "E2", None, D, 2)], SCHEMA + ", ord bigint")


def test_append_by_name(spark, target):
    inc = spark.createDataFrame([(9.0, 9, "z")], "amount double, id bigint, name string")
    out = append_load(target, inc)
    assert out.count() == 5 and rows(out.where("id = 9"), "id", "name", "amount") == [(9, "z", 9.0)]


def test_upsert_ignore_keeps_first_and_nulls(target, incoming):
    out = upsert_ignore(target, incoming.drop("ord") if False else incoming, ["id"], order_by=["ord"])
    got = rows(out, "id", "name", "amount")
    assert got == [(1, "a", 10.0), (2, "b", 20.0), (3, "c", None), (4, "D", 40.0), (5, "E1", 50.0),
                   (None, "snull", 2.0), (None, "tnull", 1.0)]


def test_upsert_update_listed_columns(target, incoming):
    out = upsert_update(target, incoming, ["id"], ["amount"], order_by=["ord"])
    got = rows(out, "id", "name", "amount")
    # 1: amount updated, name kept; 2: matched with NULL -> NULL; 5: first row's name, last row's amount
    assert got == [(1, "a", 11.0), (2, "b", None), (3, "c", None), (4, "D", 40.0), (5, "E1", None),
                   (None, "snull", 2.0), (None, "tnull", 1.0)]


def test_duplicates_without_order_raise(target, incoming):
    with pytest.raises(Exception, match="duplicate keys"):
        upsert_update(target, incoming.drop("ord"), ["id"], ["amount"]).collect()
    with pytest.raises(Exception, match="duplicate keys"):
        upsert_ignore(target, incoming.drop("ord"), ["id"]).collect()


def test_unique_incoming_needs_no_order(target, incoming):
    inc = incoming.where("id is null or id <> 5").drop("ord")
    out = upsert_update(target, inc, ["id"], ["name", "amount"])
    assert rows(out, "id", "name") == [(1, "A"), (2, "B"), (3, "c"), (4, "D"), (None, "snull"), (None, "tnull")]


def test_upsert_expr_rule(target, incoming):
    inc = incoming.where("id is null or id <> 5").drop("ord")
    out = upsert_expr(target, inc, ["id"], {"amount": "coalesce(t.amount, 0) + coalesce(s.amount, 0)",
                                            "name": "concat(t.name, s.name)"})
    assert rows(out, "id", "name", "amount") == [(1, "aA", 21.0), (2, "bB", 20.0), (3, "c", None), (4, "D", 40.0),
                                                 (None, "snull", 2.0), (None, "tnull", 1.0)]
    with pytest.raises(ValueError):
        upsert_expr(target, inc, ["id"], {})
    with pytest.raises(Exception, match="duplicate keys"):
        upsert_expr(target, incoming.drop("ord"), ["id"], {"amount": "s.amount"}).collect()


def test_upsert_accumulate_policies(spark):
    t = spark.createDataFrame([(1, 10.0, "n1"), (2, None, None), (3, 5.0, "keep")],
                              "id bigint, total double, last_note string")
    s = spark.createDataFrame([(1, 1.0, None, 1), (1, 2.0, "x", 2), (1, None, None, 3), (2, 4.0, "y", 1),
                               (9, None, "new", 1)], "id bigint, total double, last_note string, ord int")
    out = upsert_accumulate(t, s, ["id"], {"total": "sum", "last_note": "coalesce"}, order_by=["ord"])
    assert rows(out) == [(1, 13.0, "x"), (2, 4.0, "y"), (3, 5.0, "keep"), (9, None, "new")]
    rep = upsert_accumulate(t, s, ["id"], {"total": "sum", "last_note": "replace"}, order_by=["ord"])
    assert rows(rep, "id", "last_note")[0] == (1, None)
    only_sum = upsert_accumulate(t, s.drop("ord").drop("last_note"), ["id"], {"total": "sum"})
    assert rows(only_sum, "id", "total")[0] == (1, 13.0)
    with pytest.raises(ValueError):
        upsert_accumulate(t, s, ["id"], {"total": "avg"})


def test_delete_then_insert_rerun_is_stable(spark):
    t = spark.createDataFrame([("d1", 1, 1.0), ("d2", 2, 2.0), (None, 3, 3.0)], "run_date string, id bigint, v double")
    fresh = spark.createDataFrame([("d1", 10, 10.0)], "run_date string, id bigint, v double")
    once = delete_then_insert(t, fresh, "run_date = 'd1'")
    twice = delete_then_insert(once, fresh, "run_date = 'd1'")
    assert rows(once) == rows(twice) == [("d1", 10, 10.0), ("d2", 2, 2.0), (None, 3, 3.0)]


def test_extra_incoming_column_is_error(target, spark):
    inc = spark.createDataFrame([(1, "x")], "id bigint, zz string")
    with pytest.raises(KeyError):
        upsert_update(target, inc, ["id"], ["zz"])


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, None, 5), (2, "z", 4)],
                               "k int, v string, o int")
    assert rows(latest_per_key(df, ["k"], ["o"])) == [(1, "b", 3), (2, None, 5)]


def test_hot_key_is_pre_aggregated(spark):
    # one key holds a third of the rows: the plan reduces it before the shuffle
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                   F.col("id").alias("v"))
    out = latest_per_key(df, ["k"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(struct" in plan and "max_by" not in plan
    assert out.where("k = 0").first()["v"] == 29997


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 50)), max_size=8, unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.integers(0, 6), st.integers(0, 50)), max_size=8, unique_by=lambda t: t[0]))
def test_update_all_equals_ignore_swapped(spark, a, b):
    # W3(target, incoming) with every column listed == W2(incoming, target) for unique keys
    sa = spark.createDataFrame(a, "id bigint, v bigint")
    sb = spark.createDataFrame(b, "id bigint, v bigint")
    assert rows(upsert_update(sa, sb, ["id"], ["v"])) == rows(upsert_ignore(sb, sa, ["id"]))


def test_broadcast_path_does_not_shuffle_target(spark, join_path):
    t = spark.range(5000).select(F.col("id"), (F.col("id") * 2).alias("v"))
    s = spark.createDataFrame([(1, 100), (9999, 5)], "id bigint, v bigint")
    out = upsert_update(t, s, ["id"], ["v"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    if join_path == "broadcast":
        assert "BroadcastHashJoin" in plan and "FullOuter" not in plan
    else:
        assert "FullOuter" in plan
    assert out.count() == 5001 and out.where("id = 1").first()["v"] == 100


def test_mistyped_incoming_value_fails_the_load(spark, target):
    inc = spark.createDataFrame([(1, "x", "not a number")], "id bigint, name string, amount string")
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        with pytest.raises(Exception, match="cannot conform"):
            upsert_update(target, inc, ["id"], ["amount"]).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_ties_resolve_to_the_same_row(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "c", 5), (1, "a", 5)], "k int, v string, o int")
    # order_by ties on o: the other columns decide, on every run
    assert [tuple(latest_per_key(df.repartition(3), ["k"], ["o"]).first()) for _ in range(3)] == [(1, "c", 5)] * 3


def test_append_rejects_unknown_columns(spark, target):
    with pytest.raises(KeyError):
        append_load(target, spark.createDataFrame([(1, "x")], "id bigint, zz string"))
    with pytest.raises(ValueError):
        append_load(target, spark.createDataFrame([(1,)], "id bigint"), by_name=False)
