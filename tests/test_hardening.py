"""Paths the fixtures do not reach: lost data, mixed input, zones, long lists, wide rows."""

import csv
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, rows
from dockhand.functions.jsonflat import json_flatten
from dockhand.operators import merge
from dockhand.operators.batching import fixed_size_batches, global_row_index
from dockhand.operators.chunks import chunk_start, list_segments, retire, retire_by_ids
from dockhand.operators.keyed import latest_per_key
from dockhand.operators.merge import fits_broadcast, upsert_accumulate, upsert_expr, upsert_update
from dockhand.operators.quality import CheckFailed, nonempty_guard
from dockhand.operators.retention import run_id_date
from dockhand.plans.compositions import dated_reload, dated_report, files_to_chunks, import_to_files, table_to_kv, table_to_partitions
from dockhand.sinks.partitions import (bulk_load_chunks, insert_dynamic, insert_static, merge_partitions, partition_path,
                                       read_partitioned, replace_table, stage_and_publish)
from dockhand.sources.tables import Source, import_table
from dockhand.streaming.batches import load_each_batch


@pytest.fixture
def zone(spark, request):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", old)


NEW_YORK = pytest.mark.parametrize("zone", ["America/New_York"], indirect=True)


# ---- partitions

@pytest.mark.parametrize("value", ["01", "a b/c", "x%y=z", None])
def test_empty_static_overwrite_of_odd_values(spark, tmp_dir, value):
    p = os.path.join(tmp_dir, "t")
    insert_dynamic(spark.createDataFrame([(1, value), (2, "keep")], "v bigint, m string"), p, ["m"], overwrite=True)
    insert_static(spark.createDataFrame([], "v bigint"), p, {"m": value}, overwrite=True)
    assert rows(read_partitioned(spark, p, T.StructType.fromDDL("v bigint, m string"))) == [(2, "keep")]


def test_empty_static_overwrite_of_a_leading_column_drops_all_below(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    insert_dynamic(spark.createDataFrame([(1, 2024, 1), (2, 2024, 2), (3, 2025, 1)], "v bigint, y int, m int"), p, ["y", "m"], overwrite=True)
    insert_static(spark.createDataFrame([], "v bigint"), p, {"y": 2024}, overwrite=True)
    assert rows(read_partitioned(spark, p, T.StructType.fromDDL("v bigint, y int, m int"))) == [(3, 2025, 1)]
    assert partition_path(spark, "/t", {"h": "2024-01-05T00:00:00"}) == "/t/h=2024-01-05T00%3A00%3A00"


def test_failed_publish_keeps_target_and_staging(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    spark.range(5).write.parquet(p)
    stage = os.path.join(tmp_dir, "stage")
    blocked = p + "/"  # publishing beside the target cannot create its folder
    os.chmod(tmp_dir, 0o755)
    import dockhand.sinks.partitions as m
    real = m.move_path
    calls = []

    def broken(spark_, a, b):
        calls.append((a, b))
        if len(calls) == 2:
            raise OSError("swap failed")
        real(spark_, a, b)
    m.move_path = broken
    try:
        with pytest.raises(RuntimeError, match="stage"):
            stage_and_publish(spark.read.parquet(p).withColumn("id", F.col("id") * 10), blocked, overwrite=True, staging=stage)
    finally:
        m.move_path = real
    assert rows(spark.read.parquet(p)) == [(i,) for i in range(5)]
    assert rows(spark.read.parquet(stage)) == [(i * 10,) for i in range(5)]


def test_unpartitioned_overwrite_from_itself(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    spark.range(5).write.parquet(p)
    stage_and_publish(spark.read.parquet(p).withColumn("id", F.col("id") + 100), p, overwrite=True)
    assert rows(spark.read.parquet(p)) == [(100 + i,) for i in range(5)]
    replace_table(spark.range(2), p)
    assert rows(spark.read.parquet(p)) == [(0,), (1,)] and os.listdir(tmp_dir) == ["t"]


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType()), T.StructField("d", T.StringType())])


def test_merge_moves_keys_between_partitions(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    insert_dynamic(spark.createDataFrame([(1, 1, "x"), (2, 2, "z"), (3, 3, "y")], SCHEMA), p, ["d"], overwrite=True)
    inc = spark.createDataFrame([(1, 10, "y")], SCHEMA)
    merge_partitions(spark, p, SCHEMA, inc, ["d"], lambda t, s: upsert_update(t, s, ["k"], ["v", "d"]), keys=["k"])
    assert rows(read_partitioned(spark, p, SCHEMA)) == [(1, 10, "y"), (2, 2, "z"), (3, 3, "y")]
    assert not glob.glob(os.path.join(p, "d=x", "*.parquet"))


def test_merge_of_thousands_of_partitions_and_null(spark, tmp_dir):
    p, n = os.path.join(tmp_dir, "t"), 3000
    base = spark.range(n).select(F.col("id").alias("k"), F.col("id").alias("v"), F.concat(F.lit("d"), F.col("id")).alias("d"))
    base = base.unionByName(spark.createDataFrame([(-1, -1, None)], SCHEMA))
    insert_dynamic(base.coalesce(4), p, ["d"], overwrite=True, cluster=False)
    merge_partitions(spark, p, SCHEMA, base.withColumn("v", F.col("v") + 1), ["d"], lambda t, s: upsert_update(t, s, ["k"], ["v"]))
    back = read_partitioned(spark, p, SCHEMA)
    assert back.count() == n + 1 and back.where("v != k + 1").count() == 0


# ---- files

def test_csv_keeps_microseconds_and_quotes(spark, tmp_dir):
    spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ '2024-01-01 00:00:00.123456' AS ts, 'a\"b, c' AS s").createOrReplaceTempView("csv_src")
    out = import_to_files(spark, os.path.join(tmp_dir, "c"), table="csv_src", file_type="csv")
    (path,) = glob.glob(os.path.join(out, "*.csv"))
    with open(path, newline="") as f:
        assert list(csv.reader(f)) == [["id", "ts", "s"], ["1", "2024-01-01 00:00:00.123456", 'a"b, c']]


def test_files_to_chunks_drops_only_loaded_files(spark, tmp_dir):
    root = os.path.join(tmp_dir, "in")
    for name, day in (("take", 1), ("leave", 2)):
        spark.createDataFrame([(dt.datetime(2024, 1, day), day)], "ts timestamp_ntz, v int").coalesce(1).write.parquet(os.path.join(root, name))
    (take,) = glob.glob(os.path.join(root, "take", "*.parquet"))
    out = files_to_chunks(spark, root, os.path.join(tmp_dir, "c"), "ts", glob="*.parquet", remove_after=True,
                          file_filter=lambda n: n == os.path.basename(take))
    assert spark.read.parquet(out).select("v").collect()[0]["v"] == 1
    assert not os.path.exists(take) and len(glob.glob(os.path.join(root, "leave", "*.parquet"))) == 1


def test_file_import_has_no_shuffle(spark):
    src = Source(format="parquet", path=SF_SMALL + "/{table}.parquet")
    df = import_table(spark, "orders", src, columns=["o_orderkey"], split_by="o_orderkey", num_partitions=4)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


# ---- batches

def test_row_numbers_do_not_depend_on_exchange_reuse(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("m", F.create_map(F.lit("a"), F.col("l_orderkey")))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = global_row_index(df, ["l_orderkey"], num_partitions=7).select("row_index", "l_orderkey").collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert sorted(r["row_index"] for r in out) == list(range(len(out)))
    ordered = [r["l_orderkey"] for r in sorted(out, key=lambda r: r["row_index"])]
    assert ordered == sorted(ordered)
    assert fixed_size_batches(df, 100, ["l_orderkey"]).groupBy("batch_id").count().agg(F.max("count")).first()[0] == 100


# ---- merge

def test_wide_rows_are_not_broadcast(spark, monkeypatch):
    wide = spark.range(50).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 10_000).alias("t"))
    monkeypatch.setattr(merge, "BROADCAST_BYTES", 100_000)
    assert not fits_broadcast(wide) and fits_broadcast(wide.select("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only a hint of ours could broadcast
    try:
        out = upsert_update(wide, wide, ["k"], ["t"])
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    out = upsert_update(wide, wide.withColumn("t", F.lit("y")), ["k"], ["t"])
    assert out.where("t = 'y'").count() == 50


def test_update_names_are_checked(spark):
    t = spark.createDataFrame([(1, "a")], "k bigint, v string")
    s = spark.createDataFrame([(1, "b")], "k bigint, v string")
    for call in (lambda: upsert_update(t, s, ["k"], ["vv"]), lambda: upsert_expr(t, s, ["k"], {"zz": "s.v"}),
                 lambda: upsert_accumulate(t, s, ["k"], {"zz": "replace"}), lambda: upsert_update(t, s, ["k"], ["k"])):
        with pytest.raises(KeyError):
            call()
    assert rows(upsert_update(t, s, ["k"], ["V"])) == [(1, "b")]
    assert rows(upsert_expr(t, s, ["k"], {"V": "concat(t.v, s.v)"})) == [(1, "ab")]
    assert rows(upsert_accumulate(t, s, ["k"], {"V": "replace"})) == [(1, "b")]


def test_target_that_is_no_scan_is_computed_once(spark):
    t = spark.range(100).groupBy((F.col("id") % 10).alias("k")).agg(F.count(F.lit(1)).alias("v"))
    s = spark.createDataFrame([(1, 5), (50, 6)], "k bigint, v bigint")
    out = upsert_update(t, s, ["k"], ["v"])
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()  # staged
    assert out.count() == 11


def test_accumulate_shares_order_aggregates(spark):
    t = spark.createDataFrame([], "k bigint, a bigint, b bigint, c bigint")
    s = spark.createDataFrame([(1, 1, 10, None, 1), (1, 2, None, 7, 2), (1, 3, 30, None, 3)], "k bigint, a bigint, b bigint, c bigint, o int")
    out = upsert_accumulate(t, s, ["k"], {"a": "replace", "c": "coalesce"}, order_by=["o"])
    assert rows(out) == [(1, 3, 10, 7)]


def test_latest_per_key_ships_each_column_once(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    plan = latest_per_key(df, ["l_orderkey"], ["l_shipdate"])._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan
    m = df.withColumn("m", F.create_map(F.lit("a"), F.col("l_tax")))
    assert latest_per_key(m, ["l_orderkey"], ["l_shipdate"]).count() == df.select("l_orderkey").distinct().count()


# ---- JSON

def test_json_flatten_with_records_that_are_no_object(spark):
    df = spark.createDataFrame([('{"a":1,"A":"x"}',), ("5",), ("[1]",), (None,)], "js string")
    out = json_flatten(df, "js")
    assert out.columns == ["A", "a"] or out.columns == ["a", "A"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert sum(r == (None, None) for r in got) == 3 and any(set(r) == {1, "x"} for r in got)
    with pytest.raises(Exception, match="JSON object"):
        json_flatten(df.where("js = '5' or js like '{%'"), "js", strict=True).collect()


# ---- zones

@NEW_YORK
def test_hour_chunks_keep_hours_that_the_session_zone_skips(spark, zone, tmp_dir):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00' AS ts UNION ALL SELECT TIMESTAMP_NTZ '2024-11-03 01:59:59.5'")
    got = sorted(r[0] for r in df.select(chunk_start("ts", "hour")).collect())
    assert got == [dt.datetime(2024, 3, 10, 2), dt.datetime(2024, 11, 3, 1)]
    assert sorted(r[0] for r in df.select(chunk_start("ts", "week")).collect()) == [dt.datetime(2024, 3, 4), dt.datetime(2024, 10, 28)]
    ids = sorted(r["segment_id"] for r in list_segments(df, "ts", "hour", "e").collect())
    assert ids[0] == "e_2024-03-10T02:00:00.000Z_2024-03-10T03:00:00.000Z"
    out = bulk_load_chunks(df, os.path.join(tmp_dir, "c"), "ts", "hour")
    assert sorted(os.listdir(out))[1] == "chunk=2024-03-10T02%3A00%3A00" or "chunk=2024-03-10T02%3A00%3A00" in os.listdir(out)


@NEW_YORK
def test_run_id_date_is_in_its_own_offset(spark, zone):
    ids = ["run_id=scheduled__2024-01-05T00:00:00+07:00", "run_id=scheduled__2024-01-05T23:59:59+0000", "2024-01-05T01:00:00Z",
           "2024-01-05", "manual__x"]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "s string").select(run_id_date("s")).collect()]
    assert got == [dt.date(2024, 1, 5)] * 4 + [None]


# ---- selectors, guards, compositions

def test_retire_selectors(spark):
    seg = spark.createDataFrame([(None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), True), ("b", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3), True)],
                                "segment_id string, chunk_start timestamp_ntz, chunk_end timestamp_ntz, used boolean")
    used = lambda df: [r["used"] for r in df.orderBy("chunk_start").collect()]
    assert used(retire_by_ids(seg, ["b"] + [str(i) for i in range(20_000)])) == [True, False] == used(retire_by_ids(seg, ["b", None]))
    assert used(retire(seg, interval_generator=lambda: ("2024-01-01", "2024-01-02"), segment_ids=["b"])) == [False, True]
    assert used(retire(seg, since="2024-01-01", until="2024-01-03")) == [False, False]
    assert used(retire(seg, segment_ids_generator=lambda n: [n], segment_ids_generator_kwargs={"n": "b"})) == [True, False]
    with pytest.raises(ValueError):
        retire(seg, since="2024-01-01")
    with pytest.raises(TypeError):
        retire(seg, interval_generator=lambda: "2024-01-01/2024-01-02")


def test_guard_and_reload_run_the_extract_once(spark):
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").createOrReplaceTempView("once_orders")
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b
    src = spark.table("once_orders")
    target = src.where("false")
    out = dated_reload(spark, target, None, "2024-01-01", transform=lambda s, d: src.mapInArrow(seen, src.schema))
    assert out.count() == src.count() == calls.value
    with pytest.raises(CheckFailed):
        nonempty_guard(target, "x")


def test_report_and_generators(spark, tmp_dir):
    spark.createDataFrame([(1, float("nan"), "a")], "id bigint, x double, d string").createOrReplaceTempView("rep_src")
    out = dated_report(spark, tmp_dir, "r", "2024-01-30", sql_builder=lambda d: "SELECT * FROM rep_src", file_format="parquet")
    assert out.endswith("r/run_date=2024-01-30") and spark.read.parquet(out).first()["x"] is None
    with pytest.raises(CheckFailed):
        dated_report(spark, tmp_dir, "r", "2024-01-30", transform=lambda s, d: s.table("rep_src").where("false"))
    path = table_to_partitions(spark, os.path.join(tmp_dir, "p"), T.StructType.fromDDL("key bigint, d string"),
                               sql_generator=lambda t: f"SELECT id, d FROM {t}", sql_generator_kwargs={"t": "rep_src"},
                               column_map={"id": "key"}, partitions_generator=lambda c: [c], partitions_generator_kwargs={"c": "d"})
    assert rows(spark.read.parquet(path)) == [(1, "a")]
    with pytest.raises(CheckFailed):
        table_to_kv(spark, ["id"], ["d"], table="rep_src", target="no_such_table")
    for when, name in (("before", "key"), ("after", "id")):
        kv = table_to_kv(spark, ["key"], ["d"], table="rep_src", column_map={"id": "key"}, rename=when,
                         transform=lambda df, n=name: df.where(F.col(n) == 1))
        assert kv.count() == 1


def test_stream_merges_its_first_batch_and_skips_replays(spark, tmp_dir):
    src, path, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "t", "ckpt"))
    spark.createDataFrame([(1, 1, "a"), (1, 2, "a")], SCHEMA).coalesce(1).write.parquet(src)
    keep = lambda t, s: upsert_update(t, s, ["k"], ["v"], order_by=["v"])
    load = lambda: load_each_batch(spark.readStream.schema(SCHEMA).parquet(src), path, SCHEMA, ["d"], ckpt, merge=keep, keys=["k"])
    load().awaitTermination(120)
    assert rows(read_partitioned(spark, path, SCHEMA)) == [(1, 2, "a")]
    spark.createDataFrame([(1, 5, "b"), (2, 6, "b")], SCHEMA).coalesce(1).write.mode("append").parquet(src)
    load().awaitTermination(120)
    assert rows(read_partitioned(spark, path, SCHEMA), "k", "v") == [(1, 5), (2, 6)]
    assert os.path.isdir(os.path.join(ckpt, "loaded", "0"))
