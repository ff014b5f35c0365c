import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dockhand.operators import chunks
from dockhand.operators.batching import fixed_size_batches, global_row_index, ordered_layout
from dockhand.operators.chunks import (list_segments, normalize_intervals, read_used, retire_by_ids,
                                       retire_by_interval, truncate)


@pytest.mark.parametrize("n_rows", [0, 499, 500, 501, 1777])
def test_batches_sizes(spark, n_rows):
    df = spark.range(n_rows).select((F.col("id") * 7 + 3).alias("k"))
    b = fixed_size_batches(df, 500, ["k"], num_partitions=5)
    sizes = {r["batch_id"]: r["n"] for r in b.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    full, last = divmod(n_rows, 500)
    assert sorted(sizes) == list(range(full + (1 if last else 0)))
    assert all(sizes[i] == 500 for i in range(full))
    if last:
        assert sizes[full] == last
    got = [(r["k"], r["batch_id"], r["batch_row"]) for r in b.orderBy("k").collect()]
    assert got == [(i * 7 + 3, i // 500, i % 500) for i in range(n_rows)]


def test_row_index_plan_has_no_global_window(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    out = global_row_index(df, ["k"], 4)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and "rangepartitioning" not in plan  # numbered on a staged copy
    assert "BroadcastHashJoin" in plan


def test_ordered_layout_sorts_within_files(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    parts = ordered_layout(df, ["k"], total=True, num_partitions=4).rdd.glom().collect()
    flat = [r["k"] for p in parts for r in p]
    assert flat == sorted(flat)


@pytest.fixture
def events(spark):
    base = dt.datetime(2024, 1, 1)
    data = [(i, base + dt.timedelta(hours=6 * i)) for i in range(4 * 10)]  # 10 days, 4 rows a day
    return spark.createDataFrame(data, "id bigint, ts timestamp_ntz")


def test_list_segments(events):
    seg = list_segments(events, "ts", "day", "ds")
    assert seg.count() == 10
    r = seg.orderBy("chunk_start").first()
    assert r["segment_id"] == "ds_2024-01-01T00:00:00.000Z_2024-01-02T00:00:00.000Z"
    assert (r["n_rows"], r["used"]) == (4, True)


def test_retire_by_interval_edges(events):
    seg = list_segments(events, "ts", "day", "ds")
    out = retire_by_interval(seg, [("2024-01-02", "2024-01-04"),            # 2 chunks
                                   ("2024-01-06T00:00:00Z", "2024-01-07T12:00:00Z"),  # cuts day 7
                                   ("2024-01-09", "2024-01-09")])           # empty
    unused = [r[0].day for r in out.where(~F.col("used")).select("chunk_start").collect()]
    assert sorted(unused) == [2, 3, 6]
    again = retire_by_interval(out, [("2024-01-02", "2024-01-04")])
    assert rows(again) == rows(out)  # twice = once


def test_overlapping_intervals_are_not_merged(events):
    # day 5 lies only in the union of two intervals, not wholly in either
    seg = list_segments(events, "ts", "day", "ds")
    out = retire_by_interval(seg, [("2024-01-04T00:00:00", "2024-01-05T12:00:00"),
                                   ("2024-01-05T06:00:00", "2024-01-06T00:00:00")])
    unused = sorted(r[0].day for r in out.where(~F.col("used")).select("chunk_start").collect())
    assert unused == [4]


def test_long_interval_list_equals_containment(events):
    seg = list_segments(events, "ts", "day", "ds")
    ivs = [("2024-01-02", "2024-01-04"), ("2024-01-06T00:00:00Z", "2024-01-07T12:00:00Z"),
           ("2024-01-08T03:00:00", "2024-01-10T00:00:00")]
    short = rows(retire_by_interval(seg, ivs))
    many = ivs + [(f"1999-01-01T00:{m:02d}:{s:02d}", f"1999-01-01T00:{m:02d}:{s + 1:02d}") for m in range(60) for s in range(0, 58, 2)]
    assert rows(retire_by_interval(seg, many)) == short
    assert rows(retire_by_interval(seg, [*many, ("0001-01-01", "1990-01-01")])) == short  # a span of centuries


def test_retire_by_ids_and_read_used(events):
    seg = list_segments(events, "ts", "day", "ds")
    out = retire_by_ids(seg, ["ds_2024-01-01T00:00:00.000Z_2024-01-02T00:00:00.000Z", "nope"])
    assert out.where(~F.col("used")).count() == 1
    assert read_used(events, out, "ts").count() == 36
    assert retire_by_ids(seg, []).where(~F.col("used")).count() == 0


def test_interval_argument_forms():
    assert len(normalize_intervals(("2024-01-01", "2024-01-02"))) == 1
    assert normalize_intervals([("2024-01-02", "2024-01-01")]) == []
    with pytest.raises(TypeError):
        normalize_intervals("2024-01-01/2024-01-02")


def test_truncate_keeps_schema(events):
    t = truncate(events)
    assert t.count() == 0 and t.schema == events.schema


def test_hot_order_value_spreads_over_ranges(spark):
    # a third of the rows share one order value: the tie-breakers split it
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("payload"))
    out = global_row_index(df, ["k"], num_partitions=6)
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # each staged file (one range) is read by a task of its own
    try:
        per_part = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert max(r["count"] for r in per_part) < 1000
    assert sorted(r["row_index"] for r in out.collect()) == list(range(3000))
    first = [r["payload"] for r in out.orderBy("row_index").limit(5).collect()]
    assert first == [0, 3, 6, 9, 12]  # ties on k=0 ordered by payload


@pytest.mark.parametrize("granularity", ["day", "hour"])
def test_short_and_unaligned_intervals(spark, granularity):
    base = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(base + dt.timedelta(minutes=30 * i),) for i in range(48 * 4)], "ts timestamp_ntz")
    seg = list_segments(ev, "ts", granularity, "ds")
    ivs = [("2024-01-02T00:00:00", "2024-01-02T12:00:00"),      # shorter than a day
           ("2024-01-03T00:30:00", "2024-01-03T02:00:00"),      # unaligned start
           ("2024-01-01T05:00:00", "2024-01-01T05:10:00")]      # shorter than an hour
    def inside(r):
        return any(normalize_intervals([iv])[0][0] <= r["chunk_start"] and r["chunk_end"] <= normalize_intervals([iv])[0][1] for iv in ivs)
    want = {r["segment_id"]: not inside(r) for r in seg.collect()}
    assert {r["segment_id"]: r["used"] for r in retire_by_interval(seg, ivs).collect()} == want
