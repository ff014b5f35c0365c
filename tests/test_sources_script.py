import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, rows
from dockhand.operators.quality import CheckFailed
from dockhand.plans.script import run_script
from dockhand.plans.transforms import dated_transform, pandas_transform, user_transform
from dockhand.sources.documents import CORRUPT, read_hits, scan_counts, scan_documents, scan_output_path
from dockhand.sources.files import file_inventory, read_files
from dockhand.sources.tables import Source, dated_extract, import_table, resolve_source, time_window

SRC = T.StructType([T.StructField("a", T.LongType()), T.StructField("t", T.StringType())])


def test_hits_tolerant_and_strict(spark):
    txt = spark.createDataFrame([('{"_id":"1","_source":{"a":1,"t":"x"}}',), ("{broken",),
                                 ('{"_id":"3","_source":{"a":3,"t":"error"}}',)], "value string")
    hits = read_hits(None, SRC, text=txt)
    assert hits.where(F.col(CORRUPT).isNotNull()).count() == 1
    parse = lambda d: F.when(F.col("_source.t") != "error", F.struct(F.col("_id"), F.col("_source.a").alias("a")))
    assert rows(scan_documents(hits, parse, ["a"])) == [("1", "1")]
    assert tuple(scan_counts(hits, parse).first()) == (3, 1, 2, 1)
    with pytest.raises(Exception):
        read_hits(None, SRC, text=txt, tolerant=False).collect()


def test_hits_from_files(spark, tmp_dir):
    p = os.path.join(tmp_dir, "hits.json")
    with open(p, "w") as f:
        f.write('{"_id":"1","_source":{"a":1,"t":"x"}}\n{oops\n')
    assert read_hits(spark, SRC, path=p).count() == 2


def test_filtered_file_read(spark):
    o = read_files(spark, SF_SMALL, glob="*.parquet", file_filter=lambda n: n.startswith("orders"))
    assert o.count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    r = read_files(spark, SF_SMALL, glob="re*.parquet", name_predicate=lambda c: c == "region.parquet")
    assert r.count() == 5
    with pytest.raises(FileNotFoundError):
        read_files(spark, SF_SMALL, file_filter=lambda n: False)


def test_file_inventory_reads_no_content(spark):
    inv = file_inventory(spark, SF_SMALL, glob="*.parquet")
    assert inv.count() == 14 and "content" not in inv.columns
    assert "content" not in inv._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_import_table_pushes_filter_and_prunes(spark):
    src = Source(format="parquet", path=f"{SF_SMALL}/{{table}}.parquet")
    df = import_table(spark, "orders", src, columns=["o_orderkey", "o_totalprice"], where="o_orderstatus = 'F'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_resolve_source_precedence(spark):
    spark.range(3).createOrReplaceTempView("src_t")
    assert resolve_source(spark, table="src_t", sql="SELECT 1").count() == 3
    assert resolve_source(spark, sql="SELECT 1 AS x").first()["x"] == 1
    assert resolve_source(spark, sql_generator=lambda n: f"SELECT {n} AS x", n=5).first()["x"] == 5
    with pytest.raises(ValueError):
        resolve_source(spark)


def test_dated_extract_guards(spark):
    with pytest.raises(ValueError):
        dated_extract(spark, lambda d: "SELECT 1", None)
    with pytest.raises(CheckFailed):
        dated_extract(spark, lambda d: f"SELECT '{d}' AS d WHERE 1 = 0", "2024-01-01")
    assert dated_extract(spark, lambda d: "SELECT 1 WHERE 1 = 0", "2024-01-01", on_empty="warn").count() == 0


def test_time_window_half_open(spark):
    base = dt.datetime(2024, 1, 5)
    df = spark.createDataFrame([(base - dt.timedelta(seconds=1),), (base,), (base + dt.timedelta(hours=6),)],
                               "ts timestamp_ntz")
    out = time_window(df, "ts", "2024-01-05T00:00:00", 6)
    assert out.count() == 1 and tuple(out.first())[1:] == ("2024", "01", "05", "00")


def test_run_script(spark):
    out = run_script(spark, ["CREATE OR REPLACE TEMP VIEW s1 AS SELECT id FROM range(10)",
                             "SELECT count(*) AS n FROM s1 WHERE id >= :lo"], parameters={"lo": 4})
    assert out.first()["n"] == 6
    assert run_script(spark, "SELECT ? + 1 AS x", parameters=[1]).first()["x"] == 2
    assert run_script(spark, sql_generator=lambda: "SELECT 3 AS x").first()["x"] == 3
    with pytest.raises(ValueError):
        run_script(spark)
    with pytest.raises(CheckFailed):
        run_script(spark, "SELECT 1", validator="SELECT 0")


def test_user_hooks(spark):
    df = spark.range(4)
    assert user_transform(df, None) is df
    parts = user_transform(df, lambda d, k: [d.where(f"id < {k}"), d.where(f"id >= {k}")], k=1)
    assert [p.count() for p in parts] == [1, 3]
    with pytest.raises(TypeError):
        user_transform(df, lambda d: 1)
    with pytest.raises(ValueError):
        dated_transform(spark, lambda s, d: df, "None")
    out = pandas_transform(df, lambda p: p.assign(x=p["id"] * 2), "id long, x long")
    assert rows(out, "x") == [(0,), (2,), (4,), (6,)]


def test_scan_output_path():
    assert scan_output_path("/x/", "2024-01-01T23:30:00+07:00") == "/x/2024/01/01/23-00-00"
    assert scan_output_path("/x", "2024-01-01T23:30:00.5Z") == "/x/2024/01/01/23-00-00"
    with pytest.raises(ValueError):
        scan_output_path("/x", "2024-01-01")
