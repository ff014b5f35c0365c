import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from dockhand.functions.timefmt import resolve_run_date
from dockhand.operators.chunks import list_segments, retire
from dockhand.operators.merge import append_load
from dockhand.plans.compositions import (dated_accumulate, dated_reload, files_to_chunks, import_to_files,
                                         load, table_to_files, table_to_kv)
from dockhand.sources.tables import Source


def test_resolve_run_date_driver_side():
    ts = dt.datetime(2024, 1, 1, 17, 0)
    assert resolve_run_date("2024-05-05", "x", ts) == "2024-05-05"
    assert resolve_run_date(None, "None", ts) == "2024-01-02"
    assert resolve_run_date("None", None, dt.datetime(2024, 1, 1, 16, 59)) == "2024-01-01"


def test_retire_precedence(spark):
    ev = spark.createDataFrame([(dt.datetime(2024, 1, d, 1),) for d in range(1, 6)], "ts timestamp_ntz")
    seg = list_segments(ev, "ts", "day", "ds")
    gen = lambda: [("2024-01-01", "2024-01-02")]
    out = retire(seg, since="2024-01-02", until="2024-01-04", interval_generator=gen,
                 segment_ids=["ds_2024-01-05T00:00:00.000Z_2024-01-06T00:00:00.000Z"])
    assert [r[0].day for r in out.where(~F.col("used")).select("chunk_start").collect()] == [1]
    out = retire(seg, since="2024-01-02", until="2024-01-04")
    assert out.where(~F.col("used")).count() == 2
    out = retire(seg, segment_ids_generator=lambda: ["ds_2024-01-05T00:00:00.000Z_2024-01-06T00:00:00.000Z"])
    assert out.where(~F.col("used")).count() == 1
    with pytest.raises(ValueError):
        retire(seg)
    with pytest.raises(TypeError):
        retire(seg, interval_generator=lambda: "bad")


def test_positional_append(spark):
    t = spark.createDataFrame([(1, "a")], "id int, s string")
    s = spark.createDataFrame([("b", 2)], "s string, id int")
    assert rows(append_load(t, s)) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception):
        append_load(t, s, by_name=False).collect()  # 'b' cannot go into an int column by position


def test_load_dispatch(spark):
    t = spark.createDataFrame([(1, 1.0)], "id bigint, v double")
    s = spark.createDataFrame([(1, 2.0), (2, 3.0)], "id bigint, v double")
    assert load(t, s).count() == 3
    assert rows(load(t, s, keys=["id"])) == [(1, 1.0), (2, 3.0)]
    assert rows(load(t, s, keys=["id"], update_columns=["v"])) == [(1, 2.0), (2, 3.0)]
    assert rows(load(t, s, keys=["id"], rules={"v": "t.v + s.v"})) == [(1, 3.0), (2, 3.0)]
    assert rows(load(t, s, keys=["id"], policies={"v": "sum"})) == [(1, 3.0), (2, 3.0)]


def test_dated_accumulate_warns_on_empty(spark):
    t = spark.createDataFrame([(1, 1.0)], "id bigint, v double")
    spark.createDataFrame([("2024-01-02", 1, 5.0)], "d string, id bigint, v double").createOrReplaceTempView("acc_src")
    builder = lambda d: f"SELECT id, v FROM acc_src WHERE d = '{d}'"
    run_date, out = dated_accumulate(spark, t, builder, {"v": "sum"}, ["id"],
                                     own_run_date="None", execution_ts=dt.datetime(2024, 1, 1, 18))
    assert run_date == "2024-01-02" and rows(out) == [(1, 6.0)]
    run_date, out = dated_accumulate(spark, t, builder, {"v": "sum"}, ["id"], conf_run_date="2030-01-01")
    assert out is t


def test_dated_reload_with_keys(spark):
    spark.createDataFrame([(1, "d1", 10.0), (3, "d1", 30.0)], "id bigint, d string, v double").createOrReplaceTempView("rl_src")
    t = spark.createDataFrame([(1, "d1", 1.0), (2, "d1", 2.0), (4, "d0", 4.0)], "id bigint, d string, v double")
    out = dated_reload(spark, t, lambda d: f"SELECT * FROM rl_src WHERE d = '{d}'", "d1",
                       delete_predicate="d = 'd1' AND id = 2", keys=["id"], update_columns=["v"])
    assert rows(out) == [(1, "d1", 10.0), (3, "d1", 30.0), (4, "d0", 4.0)]


def test_table_to_files_renames_result(spark, tmp_dir):
    spark.range(6).createOrReplaceTempView("tf_src")
    paths = table_to_files(spark, tmp_dir, "out", table="tf_src",
                           transform=lambda d: [d.where("id < 2"), d.where("id >= 2")],
                           column_map={"id": "key"}, materialize=True)
    assert [spark.read.parquet(p).columns for p in paths] == [["key"], ["key"]]
    assert [spark.read.parquet(p).count() for p in paths] == [2, 4]


def test_table_to_kv_list(spark):
    spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, o int, v string").createOrReplaceTempView("kv_src")
    out = table_to_kv(spark, ["key"], ["o"], table="kv_src", transform=lambda d: [d, d.where("o = 1")],
                      column_map={"k": "key"})
    assert [rows(o, "key", "v") for o in out] == [[(1, "b")], [(1, "a")]]


def test_import_to_files(spark, tmp_dir):
    src = Source(format="parquet", path=f"{SF_SMALL}/{{table}}.parquet")
    p = import_to_files(spark, os.path.join(tmp_dir, "imp"), table="orders", source=src,
                        columns=["o_orderkey"], where="o_orderstatus = 'F'", file_type="csv")
    n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderstatus = 'F'").count()
    assert spark.read.option("header", "true").csv(p).count() == n
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").createOrReplaceTempView("imp_orders")
    q = import_to_files(spark, os.path.join(tmp_dir, "q"), query="SELECT count(*) AS n FROM imp_orders")
    assert spark.read.parquet(q).first()["n"] > 0
    with pytest.raises(ValueError):
        import_to_files(spark, tmp_dir, table="orders", query="SELECT 1")


def test_files_to_chunks(spark, tmp_dir):
    out = files_to_chunks(spark, SF_SMALL, os.path.join(tmp_dir, "c"), "ts", glob="events*.parquet")
    back = spark.read.parquet(out)
    assert back.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert back.select("chunk").distinct().count() == 30
