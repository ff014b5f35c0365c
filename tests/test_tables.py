"""Nested conform, catalog tables, partition retirement, scripts as one text, ordered rules, and the loads' repairs."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from dockhand.operators.chunks import list_segments, read_used, retire_by_interval
from dockhand.operators.conform import conform_schema
from dockhand.operators.merge import _is_scan, append_load, upsert_expr_ordered, upsert_ignore, upsert_update
from dockhand.operators.retention import retire_partitions
from dockhand.plans.script import run_script_text
from dockhand.session import path_exists
from dockhand.sinks.catalog_tables import (add_partition, create_table, drop_partitions, insert_table, list_partitions, partition_columns,
                                           publish_table, table_location)
from dockhand.sinks.partitions import bulk_load_chunks, insert_dynamic, merge_partitions, read_partitioned, replace_table
from dockhand.sources.files import inventory_with_rows

DDL = T.StructType.fromDDL


def one(df, name):
    return df.select(name).first()[0]


# nested conform

def test_nested_fields_go_by_name(spark):
    df = spark.sql("""SELECT named_struct('a', 'A', 'b', 'B') AS s, array(named_struct('a', 1, 'b', 2), NULL) AS l,
                      map('k', named_struct('a', 1, 'b', array(named_struct('y', '7', 'x', 8)))) AS m, CAST(NULL AS struct<a:int,b:int>) AS n""")
    target = DDL("s struct<b: string, a: string>, l array<struct<b: bigint, a: string>>, "
                 "m map<string, struct<b: array<struct<x: string, y: int>>, a: double>>, n struct<b: int, a: int>")
    out = conform_schema(df, target)
    assert [f.dataType.simpleString() for f in out.schema.fields] == [f.dataType.simpleString() for f in target.fields]
    r = out.first().asDict(recursive=True)
    assert r["s"] == {"b": "B", "a": "A"} and r["l"] == [{"b": 2, "a": "1"}, None]
    assert r["m"] == {"k": {"b": [{"x": "8", "y": 7}], "a": 1.0}} and r["n"] is None
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_nested_leaves_are_strict(spark):
    df = spark.sql("SELECT array(named_struct('v', 'x')) AS l")
    with pytest.raises(Exception, match="cannot conform column l"):
        conform_schema(df, DDL("l array<struct<v: int>>")).collect()
    assert conform_schema(df, DDL("l array<struct<v: int>>"), strict=False).first()["l"][0]["v"] is None


def test_nested_missing_extra_and_case(spark):
    df = spark.sql("SELECT named_struct('A', 1, 'more', 2) AS s")
    with pytest.raises(KeyError, match="lacks nested fields"):
        conform_schema(df, DDL("s struct<a: int, c: int>"))
    assert one(conform_schema(df, DDL("s struct<c: int, a: int>"), fill_missing=True), "s").asDict() == {"c": None, "a": 1}
    twice = spark.sql("SELECT named_struct('a', 1, 'A', 2) AS s")
    with pytest.raises(KeyError, match="ambiguous"):
        conform_schema(twice, DDL("s struct<a: bigint, b: int>"), fill_missing=True)


def test_loads_match_nested_fields_by_name(spark):
    target = spark.sql("SELECT 1 AS k, named_struct('a', 'A', 'b', 'B') AS s")
    swapped = spark.sql("SELECT 1 AS k, named_struct('b', 'y', 'a', 'x') AS s UNION ALL SELECT 2, named_struct('b', 'v', 'a', 'u')")
    expected = [(1, ("x", "y")), (2, ("u", "v"))]
    assert [(r[0], tuple(r[1])) for r in append_load(target, swapped).where("s.a <> 'A'").orderBy("k").collect()] == expected
    for bound in (1_000_000, 0):
        out = upsert_update(target, swapped, ["k"], ["s"], broadcast_rows=bound)
        assert [(r[0], tuple(r[1])) for r in out.orderBy("k").collect()] == expected
    short = spark.sql("SELECT 3 AS k, named_struct('b', 'only') AS s")
    assert one(append_load(target, short).where("k = 3"), "s").asDict() == {"a": None, "b": "only"}
    with pytest.raises(KeyError, match="target lacks nested fields"):
        append_load(target, spark.sql("SELECT 3 AS k, named_struct('c', 1) AS s"))


# repairs of the loads

def test_a_target_that_may_differ_between_reads_is_staged(spark):
    base = spark.range(100).selectExpr("id AS k", "id * 2 AS v")
    assert _is_scan(base) and _is_scan(base.where("k > 3").select("v")) and _is_scan(base.union(base))
    for other in (base.limit(5), base.sample(0.5, 3), base.withColumn("r", F.rand()), base.distinct(), base.orderBy("v"),
                  base.mapInPandas(lambda it: it, "k long, v long")):
        assert not _is_scan(other)
    inc = spark.createDataFrame([(1, 0), (1000, 0)], "k long, v long")
    out = upsert_ignore(base.limit(5), inc, ["k"])
    assert out.count() == len({r["k"] for r in out.collect()})


def test_partition_folders_of_another_spelling_are_replaced(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string").write.parquet(f"{path}/m=01")
    spark.createDataFrame([(9, "old")], "k int, v string").write.parquet(f"{path}/m=2")
    schema = DDL("k int, v string, m int")
    inc = spark.createDataFrame([(1, "new", 1)], schema)
    merge_partitions(spark, path, schema, inc, ["m"], lambda t, s: upsert_update(t, s, ["k"], ["v"]), keys=["k"])
    assert rows(read_partitioned(spark, path, schema)) == [(1, "new", 1), (2, "old", 1), (9, "old", 2)]
    assert not path_exists(spark, f"{path}/m=01")


def test_inventory_keeps_files_without_rows(spark, tmp_dir):
    for folder, n in (("a", 0), ("b", 3)):
        spark.range(n).coalesce(1).write.parquet(f"{tmp_dir}/raw-{folder}")
        import glob
        import os
        import shutil
        os.makedirs(f"{tmp_dir}/set/{folder} x", exist_ok=True)
        shutil.copy(glob.glob(f"{tmp_dir}/raw-{folder}/part-*.parquet")[0], f"{tmp_dir}/set/{folder} x/same.parquet")
    got = inventory_with_rows(spark, f"{tmp_dir}/set", glob="*.parquet").collect()
    assert sorted(r["rows"] for r in got) == [0, 3] and {r["file_name"] for r in got} == {"same.parquet"}


def test_a_replacement_that_died_between_its_renames_is_restored(spark, tmp_dir):
    import os
    path = f"{tmp_dir}/t"
    spark.range(3).write.parquet(path)
    os.rename(path, f"{path}__old_abc")  # the crash: the old copy aside, the new one not there yet
    with pytest.raises(Exception, match="(?i)divi"):
        replace_table(spark.range(2).selectExpr("raise_error('division') AS id"), path)
    assert spark.read.parquet(path).count() == 3
    replace_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


# catalog tables

@pytest.fixture
def name(spark):
    made = f"t_{uuid.uuid4().hex[:10]}"
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made}")


SCHEMA = "v bigint, d date, kind string, s struct<a: int, b: string>"


def test_create_is_repeatable_and_checked(spark, name, tmp_dir):
    create_table(spark, name, DDL(SCHEMA), ["kind", "d"], location=f"{tmp_dir}/t")
    create_table(spark, name, DDL(SCHEMA), ["kind", "d"], location=f"{tmp_dir}/t")
    assert spark.table(name).columns == ["v", "s", "kind", "d"] and partition_columns(spark, name) == ["kind", "d"]
    with pytest.raises(ValueError, match="partitioned by"):
        create_table(spark, name, DDL(SCHEMA), ["d"])
    with pytest.raises(KeyError, match="lacks columns"):
        create_table(spark, name, DDL("v bigint, d date, kind string, extra int"), ["kind", "d"])
    with pytest.raises(KeyError, match="not in the schema"):
        create_table(spark, f"{name}_x", DDL(SCHEMA), ["none"])


def test_insert_conforms_partitions_and_nested_columns(spark, name, tmp_dir):
    create_table(spark, name, DDL(SCHEMA), ["kind", "d"], location=f"{tmp_dir}/t")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    odd = "a b+c%/='é"
    df = spark.createDataFrame([("2024-01-05", odd, ("x", "1"), "7"), ("2024-01-06", None, ("y", "2"), "8")],
                               "d string, kind string, s struct<b: string, a: string>, v string")
    insert_table(df, name)
    assert rows(list_partitions(spark, name)) == sorted([(odd, dt.date(2024, 1, 5)), (None, dt.date(2024, 1, 6))], key=lambda t: (t[0] is None, t[0] or ""))
    assert spark.table(name).where("v = 7").first()["s"].asDict() == {"a": 1, "b": "x"}
    # one partition replaced, the other kept; a static value that needs escaping
    insert_table(df.where("v = '7'").withColumn("v", F.lit("70")), name, ["kind", "d"], overwrite=True)
    assert sorted(r["v"] for r in spark.table(name).collect()) == [8, 70]
    insert_table(df.where("v = '7'").drop("kind"), name, {"kind": odd}, overwrite=True)
    assert sorted(r["v"] for r in spark.table(name).collect()) == [7, 8]
    insert_table(df.where("false"), name, {"kind": odd, "d": dt.date(2024, 1, 5)}, overwrite=True)
    assert [r["v"] for r in spark.table(name).collect()] == [8]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    for spec, error in (({"kind": None}, ValueError), ({"no": 1}, KeyError), (["d"], ValueError), ("kind", TypeError), ({"d": "2024-01-05"}, ValueError)):
        with pytest.raises(error):
            insert_table(df, name, spec)
    with pytest.raises(Exception, match="cannot conform"):
        insert_table(df.withColumn("v", F.lit("x")), name)


def test_publish_from_the_table_itself_and_swap(spark, name, tmp_dir):
    create_table(spark, name, DDL("v bigint, w string"), location=f"{tmp_dir}/plain")
    publish_table(spark.range(4).selectExpr("cast(id as string) AS w", "id AS v"), name)
    first = table_location(spark, name)
    publish_table(spark.table(name).where("v > 1"), name, overwrite=True)  # derived from what it replaces
    assert rows(spark.table(name)) == [(2, "2"), (3, "3")]
    second = table_location(spark, name)
    assert second != first and not path_exists(spark, first)
    publish_table(spark.table(name).where("v > 2"), name, overwrite=True)
    assert rows(spark.table(name)) == [(3, "3")] and table_location(spark, name).count("__v_") == 1


def test_failed_publish_names_the_staging_copy(spark, name, tmp_dir, monkeypatch):
    from dockhand.sinks import catalog_tables
    create_table(spark, name, DDL("v bigint, d string"), ["d"], location=f"{tmp_dir}/t")

    def broken(*_):
        raise OSError("no catalog")

    monkeypatch.setattr(catalog_tables, "_insert", broken)
    with pytest.raises(RuntimeError, match="staging copy is kept in") as e:
        publish_table(spark.createDataFrame([(1, "x")], "v long, d string"), name)
    assert spark.read.parquet(str(e.value).rsplit(" ", 1)[1]).count() == 1


def test_added_and_dropped_partitions(spark, name, tmp_dir):
    create_table(spark, name, DDL("v bigint, d string"), ["d"], location=f"{tmp_dir}/t")
    spark.range(3).selectExpr("id AS v").write.parquet(f"{tmp_dir}/elsewhere")
    add_partition(spark, name, {"d": "it's"}, f"{tmp_dir}/elsewhere")
    insert_table(spark.createDataFrame([(9, "b")], "v long, d string"), name)
    assert spark.table(name).count() == 4
    drop_partitions(spark, name, [{"d": "b"}, {"d": "absent"}])
    assert spark.table(name).count() == 3 and not path_exists(spark, f"{tmp_dir}/t/d=b")


# retirement by partition

def test_retire_partitions_of_table_and_folder(spark, name, tmp_dir):
    schema = DDL("v bigint, kind string, d string")
    data = [(k, kind, d) for k, (kind, d) in enumerate([("error", "2024-01-26"), ("error", "2024-01-27"), ("view", "2024-01-14"), ("view", "2024-01-15"),
                                                        ("view", "not a date"), ("keep", "2020-01-01"), ("view", None)])]
    df = spark.createDataFrame(data, schema)
    rule = dict(date_col="d", class_col="kind", limits={"error": 3, "keep": None}, default_days=15, run_date="2024-01-30")
    create_table(spark, name, schema, ["kind", "d"], location=f"{tmp_dir}/t")
    insert_table(df, name)
    insert_dynamic(df, f"{tmp_dir}/f", ["kind", "d"])
    gone = [("error", "2024-01-26"), ("view", "2024-01-14")]
    folder = dict(schema=schema, partition_cols=["kind", "d"])
    assert rows(retire_partitions(spark, name, dry_run=True, **rule)) == gone
    assert spark.table(name).count() == 7
    assert rows(retire_partitions(spark, name, **rule)) == gone
    assert rows(retire_partitions(spark, f"{tmp_dir}/f", **rule, **folder)) == gone
    assert spark.table(name).count() == read_partitioned(spark, f"{tmp_dir}/f", schema).count() == 5
    assert rows(retire_partitions(spark, f"{tmp_dir}/f", **rule, **folder)) == []
    with pytest.raises(KeyError):
        retire_partitions(spark, name, "nothing")


@pytest.mark.parametrize("cut", [3, 40])
def test_read_used_prunes_folders(spark, tmp_dir, cut):
    e = spark.range(2000).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 50 as int)) AS ts")
    path = bulk_load_chunks(e, f"{tmp_dir}/c", "ts")
    segments = retire_by_interval(list_segments(e, "ts"), ("2024-01-01", f"{dt.date(2024, 1, 1) + dt.timedelta(days=cut)}"))
    segments.write.parquet(f"{tmp_dir}/segments")
    segments = spark.read.parquet(f"{tmp_dir}/segments")
    chunked = read_partitioned(spark, path, DDL("id bigint, ts timestamp_ntz, chunk string"))
    pruned = read_used(chunked, segments, chunk_col="chunk")
    assert "dynamicpruning" in pruned._jdf.queryExecution().executedPlan().toString()
    assert rows(pruned.drop("chunk")) == rows(read_used(e, segments, "ts"))
    assert pruned.count() == 40 * (50 - cut)
    with pytest.raises(ValueError):
        read_used(e, segments)


# scripts

def test_script_of_several_statements(spark):
    v = f"v_{uuid.uuid4().hex[:8]}"
    text = f"CREATE OR REPLACE TEMPORARY VIEW {v} AS SELECT :n AS n; -- first; then\n SELECT n + 1 AS n, 'a;b' AS t FROM {v}"
    for end in ("", ";", " ;\n", "  -- done;"):
        assert tuple(run_script_text(spark, text + end, {"n": 4}).first()) == (5, "a;b")
    assert run_script_text(spark, "BEGIN DECLARE x INT DEFAULT 3; SELECT x AS x; END;").first()[0] == 3
    assert run_script_text(spark, f"SELECT 1; SELECT n FROM {v}", {"n": 4}, validator=f"SELECT count(*) FROM {v}").first()["passed"]


def test_script_errors(spark):
    v = f"v_{uuid.uuid4().hex[:8]}"
    bad = f"DECLARE x INT DEFAULT 2; CREATE TEMPORARY VIEW {v} AS SELECT 1 AS a; SELECT x FROM no_such_table; SELECT 'not reached' AS r"
    with pytest.raises(AnalysisException):
        run_script_text(spark, bad)
    spark.sql(f"DROP VIEW IF EXISTS {v}")
    assert run_script_text(spark, bad, on_error="SELECT 'handled; yes' AS r").first()["r"] == "handled; yes"
    assert spark.catalog.tableExists(v)  # what ran before the error stays
    assert run_script_text(spark, "BEGIN SELECT 1 / 0; END", on_error="SELECT 0 AS r").first()[0] == 0
    with pytest.raises(ValueError):
        run_script_text(spark, " \n")
    with pytest.raises(TypeError):
        run_script_text(spark, "SELECT ?", [1])
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        run_script_text(spark, "SELEC 1")


# ordered rules

def plain_fold(target, incoming):
    """Row by row: the rule halves what is there, adds, and keeps the larger note."""
    held = {k: (v, note) for k, v, note in target if k is not None}
    for k, v, note, _ in sorted((r for r in incoming if r[0] is not None), key=lambda r: r[3]):
        held[k] = (v, note) if k not in held else (held[k][0] / 2 + v, max(held[k][1], note))
    loose = [(None, v, n) for k, v, n in target if k is None] + [(None, v, n) for k, v, n, _ in incoming if k is None]
    return sorted([(k, *x) for k, x in held.items()] + loose, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_ordered_rules_equal_row_by_row(spark, bound):
    rng = random.Random(11)
    target = [(k, float(k), "b") for k in range(0, 40, 2)] + [(None, 1.0, "z")]
    incoming = [(rng.choice([*range(30), None]), float(rng.randint(0, 50)), rng.choice("abc"), i) for i in range(300)]
    t = spark.createDataFrame(target, "k int, v double, note string")
    s = spark.createDataFrame(incoming, "k int, v double, note string, at int")
    rules = {"v": "t.v / 2 + s.v", "NOTE": "greatest(t.note, s.note)"}
    out = upsert_expr_ordered(t, s, ["k"], rules, ["at"], broadcast_rows=bound)
    got = sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == plain_fold(target, incoming)


def test_ordered_rules_on_a_hot_key(spark):
    t = spark.createDataFrame([(1, 0, "old"), (5, 5, "five")], "k int, v long, note string")
    s = spark.range(4000).selectExpr("cast(if(id % 3 = 0, 1, id) as int) AS k", "id AS v", "cast(id as string) AS note", "id AS at")
    rules = {"v": "t.v + s.v", "note": "s.note"}
    with pytest.raises(Exception, match="a key has more than 100 rows"):
        upsert_expr_ordered(t, s, ["k"], rules, ["at"], fold_rows=100).collect()
    for bound in (1_000_000, 0):
        out = {r["k"]: (r["v"], r["note"]) for r in
               upsert_expr_ordered(t, s, ["k"], rules, ["at"], associative=True, fold_rows=100, broadcast_rows=bound).collect()}
        ids = [i for i in range(4000) if i % 3 == 0 or i == 1]
        assert out[1] == (sum(ids), str(max(ids))) and out[5] == (10, "5") and out[7] == (7, "7")
        assert len(out) == 1 + len([i for i in range(4000) if i % 3 and i != 1])


def test_ordered_rules_refuse_bad_calls(spark):
    t = spark.createDataFrame([(1, 1)], "k int, v int")
    s = spark.createDataFrame([(1, 1, 1)], "k int, v int, at int")
    for rules, order, error in (({}, ["at"], ValueError), ({"v": F.col("s.v")}, ["at"], TypeError), ({"v": "s.v"}, [], ValueError),
                                ({"k": "s.k"}, ["at"], KeyError), ({"no": "s.v"}, ["at"], KeyError)):
        with pytest.raises(error):
            upsert_expr_ordered(t, s, ["k"], rules, order)
