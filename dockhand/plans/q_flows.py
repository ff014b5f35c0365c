"""Registered queries: scripts, user code, compositions, chunked tables,
retention and completeness."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.operators.chunks import list_segments, retire_by_ids, retire_by_interval
from dockhand.operators.quality import completeness
from dockhand.operators.retention import retention_filter
from dockhand.plans.catalog import query, table, view
from dockhand.plans.compositions import dated_reload, dated_report, query_upsert, table_to_kv, table_to_partitions
from dockhand.plans.script import run_script
from dockhand.plans.transforms import pandas_transform, user_transform
from dockhand.session import scratch_path
from dockhand.sinks.partitions import read_partitioned
from dockhand.sources.tables import import_query, resolve_source

LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]


@query("source_resolution", "SELECT * FROM orders")
def q_source_resolution(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "orders")
    # table beats sql beats generator
    return resolve_source(spark, table=v, sql="SELECT 1 AS x", sql_generator=lambda: "SELECT 2 AS x")


@query("sql_script", """
SELECT o_orderstatus, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus
""")
def q_sql_script(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "orders")
    return run_script(spark, [
        f"CREATE OR REPLACE TEMP VIEW dh_big_orders AS SELECT * FROM {v} WHERE o_totalprice > 100000",
        "SELECT o_orderstatus, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total "
        "FROM dh_big_orders GROUP BY o_orderstatus",
    ])


@query("sql_parameters", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 50000
""")
def q_sql_parameters(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "orders")
    named = run_script(spark, f"SELECT o_orderkey, o_totalprice, o_orderstatus FROM {v} WHERE o_orderstatus = :st",
                       parameters={"st": "F"})
    named.createOrReplaceTempView("dh_orders_f")
    return run_script(spark, "SELECT o_orderkey, o_totalprice FROM dh_orders_f WHERE o_totalprice > ?",
                      parameters=[50000.0])


@query("script_validator", """
SELECT 'orders_f' AS check_table, '2024-01-30' AS run_date, count(*) AS observed, count(*) >= 1 AS passed
FROM orders WHERE o_orderstatus = 'F'
""")
def q_script_validator(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "orders")
    return run_script(spark, [f"CREATE OR REPLACE TEMP VIEW dh_f AS SELECT * FROM {v} WHERE o_orderstatus = 'F'"],
                      validator="SELECT count(*) FROM dh_f", validator_name="orders_f", run_date="2024-01-30")


@query("user_transform", """
SELECT *, o_totalprice * CAST(0.9 AS DOUBLE) AS net_price FROM orders
""")
def q_user_transform(spark: SparkSession, sf: str) -> DataFrame:
    def add_net(df: DataFrame, discount: float) -> DataFrame:
        return df.withColumn("net_price", F.col("o_totalprice") * F.lit(1.0 - discount))
    return user_transform(table(spark, sf, "orders"), add_net, discount=0.1)


def _daily_totals(events: DataFrame) -> DataFrame:
    return events.groupBy(F.to_date("ts").alias("day"), "user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))


@query("dated_transform", """
SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n_events, sum(CAST(value AS DECIMAL(18,2))) AS total
FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-10' GROUP BY 1, 2
UNION ALL
SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n_events, sum(CAST(value AS DECIMAL(18,2))) AS total
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10' AND event_type <> 'error' GROUP BY 1, 2
""")
def q_dated_transform(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    target = _daily_totals(e)

    def fresh_day(spark_: SparkSession, run_date: str) -> DataFrame:
        # corrected definition for one day: error events no longer count
        day = e.where((F.to_date("ts") == F.lit(run_date).cast("date")) & (F.col("event_type") != "error"))
        return _daily_totals(day)
    return dated_reload(spark, target, None, "2024-01-10", transform=fresh_day,
                        delete_predicate=F.col("day") == F.lit("2024-01-10").cast("date"))


@query("dated_report", """
SELECT user_id, count(*) AS n_events, sum(CAST(value AS DECIMAL(18,2))) AS total
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10' GROUP BY user_id
""")
def q_dated_report(spark: SparkSession, sf: str) -> DataFrame:
    """Dated transform -> guard -> NaN to NULL -> Parquet snapshot of the run date."""
    e = table(spark, sf, "events")

    def report(spark_: SparkSession, run_date: str) -> DataFrame:
        return _daily_totals(e.where(F.to_date("ts") == F.lit(run_date).cast("date"))).drop("day")
    out = dated_report(spark, scratch_path(spark, "reports"), "daily", "2024-01-10", transform=report, file_format="parquet")
    return spark.read.parquet(out)


@query("pandas_transform", """
SELECT event_id, CAST(floor(value / 10) AS BIGINT) AS value_band, upper(event_type) AS kind FROM events
""")
def q_pandas_transform(spark: SparkSession, sf: str) -> DataFrame:
    def band(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"event_id": pdf["event_id"],
                             "value_band": (pdf["value"] // 10).astype("int64"),
                             "kind": pdf["event_type"].str.upper()})
    e = table(spark, sf, "events").select("event_id", "value", "event_type")
    return pandas_transform(e, band, "event_id long, value_band long, kind string")


@query("dated_reload", """
SELECT * FROM orders WHERE o_orderkey % 10 < 8
  AND NOT (o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1999-01-01 00:00:00')
UNION ALL
SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
       o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1999-01-01 00:00:00'
""")
def q_dated_reload(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "orders")
    target = table(spark, sf, "orders").where(F.col("o_orderkey") % 10 < 8)

    def builder(run_date: str) -> str:
        return (f"SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, "
                f"o_orderdate, o_orderpriority FROM {v} "
                f"WHERE o_orderdate >= TIMESTAMP_NTZ '{run_date} 00:00:00' "
                f"AND o_orderdate < TIMESTAMP_NTZ '{run_date} 00:00:00' + INTERVAL 1 YEAR")
    delete = ("o_orderdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00' "
              "AND o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'")
    return dated_reload(spark, target, builder, "1998-01-01", delete_predicate=delete)


TP_TARGET = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("total", T.DecimalType(12, 2)), T.StructField("status", T.StringType()),
    T.StructField("year", T.IntegerType())])


@query("table_to_partitions", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(12,2)) AS total,
       o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders
""")
def q_table_to_partitions(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "orders")

    def add_year(df: DataFrame) -> DataFrame:
        return df.withColumn("year", F.year("o_orderdate").cast("string"))  # text: conform casts it
    path = scratch_path(spark, "orders_by_year")
    table_to_partitions(spark, path, TP_TARGET, table=v,
                        column_map={"o_orderkey": "order_id", "o_custkey": "customer_id",
                                    "o_totalprice": "total", "o_orderstatus": "status"},
                        transform=add_year, partitions=["year"], overwrite=True)
    return read_partitioned(spark, path, TP_TARGET)


@query("table_to_kv", f"""
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id, l_quantity AS qty,
       l_shipdate AS shipped
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY {", ".join(c + " DESC" for c in LINE_ORDER)}) AS rn
      FROM lineitem) WHERE rn = 1
""")
def q_table_to_kv(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "lineitem")
    kv = table_to_kv(spark, ["order_id", "line"], LINE_ORDER,
                     sql_generator=lambda name: f"SELECT * FROM {name}", sql_generator_kwargs={"name": v}, target=v,
                     column_map={"l_orderkey": "order_id", "l_linenumber": "line"})
    return kv.select("order_id", "line", F.col("l_partkey").alias("part_id"), F.col("l_quantity").alias("qty"),
                     F.col("l_shipdate").alias("shipped"))


@query("query_upsert", """
WITH t AS (SELECT user_id, count(*) AS n_events, sum(CAST(value AS DECIMAL(18,2))) AS total, 'old' AS src
           FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY user_id),
     s AS (SELECT user_id, count(*) AS n_events, sum(CAST(value AS DECIMAL(18,2))) AS total, 'new' AS src
           FROM events WHERE event_type <> 'error' GROUP BY user_id)
SELECT COALESCE(t.user_id, s.user_id) AS user_id,
       CASE WHEN s.user_id IS NOT NULL THEN s.n_events ELSE t.n_events END AS n_events,
       CASE WHEN s.user_id IS NOT NULL THEN s.total ELSE t.total END AS total,
       CASE WHEN t.user_id IS NOT NULL THEN t.src ELSE s.src END AS src
FROM t FULL OUTER JOIN s ON t.user_id = s.user_id
""")
def q_query_upsert(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "events")
    target = spark.sql(f"SELECT user_id, count(*) AS n_events, sum(CAST(value AS DECIMAL(18,2))) AS total, "
                       f"'old' AS src FROM {v} WHERE ts < TIMESTAMP_NTZ '2024-01-16 00:00:00' GROUP BY user_id")
    fresh = import_query(spark, f"SELECT user_id, count(*) AS n_events, sum(CAST(value AS DECIMAL(18,2))) AS total, "
                                f"'new' AS src FROM {v} WHERE event_type <> 'error' GROUP BY user_id")
    return query_upsert(target, fresh, keys=["user_id"], update_columns=["n_events", "total"])


_SEG = ("'events_' || strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%S.000Z') || '_' || "
        "strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.000Z')")


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    return list_segments(table(spark, sf, "events"), "ts", "day", datasource="events")


@query("list_segments", f"""
SELECT {_SEG} AS segment_id, date_trunc('day', ts) AS chunk_start,
       date_trunc('day', ts) + INTERVAL 1 DAY AS chunk_end, count(*) AS n_rows, min(ts) AS min_ts,
       max(ts) AS max_ts, true AS used
FROM events GROUP BY date_trunc('day', ts)
""")
def q_list_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _segments(spark, sf)


@query("retire_by_interval", f"""
SELECT {_SEG} AS segment_id, date_trunc('day', ts) AS chunk_start,
       date_trunc('day', ts) + INTERVAL 1 DAY AS chunk_end, count(*) AS n_rows, min(ts) AS min_ts,
       max(ts) AS max_ts,
       NOT ((date_trunc('day', ts) >= TIMESTAMP '2024-01-05' AND
             date_trunc('day', ts) + INTERVAL 1 DAY <= TIMESTAMP '2024-01-08')
         OR (date_trunc('day', ts) >= TIMESTAMP '2024-01-20' AND
             date_trunc('day', ts) + INTERVAL 1 DAY <= TIMESTAMP '2024-01-21 12:00:00')) AS used
FROM events GROUP BY date_trunc('day', ts)
""")
def q_retire_by_interval(spark: SparkSession, sf: str) -> DataFrame:
    return retire_by_interval(_segments(spark, sf),
                              [("2024-01-05T00:00:00Z", "2024-01-08T00:00:00Z"),
                               ("2024-01-20T00:00:00Z", "2024-01-21T12:00:00Z")])


_HOUR = "date_trunc('hour', ts)"
_HOUR_SEG = _SEG.replace("date_trunc('day', ts)", _HOUR).replace("INTERVAL 1 DAY", "INTERVAL 1 HOUR")
_HOURLY = f"""SELECT {_HOUR_SEG} AS segment_id, {_HOUR} AS chunk_start, {_HOUR} + INTERVAL 1 HOUR AS chunk_end,
       count(*) AS n_rows, min(ts) AS min_ts, max(ts) AS max_ts, """


@query("retire_by_interval_hourly", f"""
{_HOURLY}
       NOT (({_HOUR} >= TIMESTAMP '2024-01-05' AND {_HOUR} + INTERVAL 1 HOUR <= TIMESTAMP '2024-01-08')
         OR ({_HOUR} >= TIMESTAMP '2024-01-20 00:30:00' AND {_HOUR} + INTERVAL 1 HOUR <= TIMESTAMP '2024-01-21 12:30:00')) AS used
FROM events GROUP BY {_HOUR}
""")
def q_retire_by_interval_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Hour chunks and a long list: two intervals that count among 600 that hold no chunk."""
    seg = list_segments(table(spark, sf, "events"), "ts", "hour", datasource="events")
    empty = [(f"2001-{m:02d}-{d:02d}T00:00:00Z", f"2001-{m:02d}-{d:02d}T{h:02d}:00:00Z")
             for m in range(1, 13) for d in range(1, 26) for h in (5, 23)]
    return retire_by_interval(seg, [*empty, ("2024-01-05T00:00:00Z", "2024-01-08T00:00:00Z"),
                                    ("2024-01-20T00:30:00Z", "2024-01-21T12:30:00Z")])


@query("retire_by_ids_hourly", f"""
{_HOURLY} {_HOUR} NOT IN (TIMESTAMP '2024-01-10 05:00:00', TIMESTAMP '2024-01-11 23:00:00') AS used
FROM events GROUP BY {_HOUR}
""")
def q_retire_by_ids_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Hour chunks and a long list of ids, nearly all unknown."""
    seg = list_segments(table(spark, sf, "events"), "ts", "hour", datasource="events")
    ids = [f"events_{k}" for k in range(12_000)] + ["events_2024-01-10T05:00:00.000Z_2024-01-10T06:00:00.000Z",
                                                     "events_2024-01-11T23:00:00.000Z_2024-01-12T00:00:00.000Z"]
    return retire_by_ids(seg, ids)


@query("retire_by_ids", f"""
SELECT {_SEG} AS segment_id, date_trunc('day', ts) AS chunk_start,
       date_trunc('day', ts) + INTERVAL 1 DAY AS chunk_end, count(*) AS n_rows, min(ts) AS min_ts,
       max(ts) AS max_ts,
       date_trunc('day', ts) NOT IN (TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-11') AS used
FROM events GROUP BY date_trunc('day', ts)
""")
def q_retire_by_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = ["events_2024-01-10T00:00:00.000Z_2024-01-11T00:00:00.000Z",
           "events_2024-01-11T00:00:00.000Z_2024-01-12T00:00:00.000Z",
           "events_1999-01-01T00:00:00.000Z_1999-01-02T00:00:00.000Z"]
    return retire_by_ids(_segments(spark, sf), ids)


@query("retention_filter", """
SELECT event_id, event_type, ts FROM events
WHERE NOT (CAST(ts AS DATE) + CASE WHEN event_type = 'error' THEN 3 ELSE 15 END < DATE '2024-01-30')
""")
def q_retention_filter(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return retention_filter(e, "ts", "event_type", {"error": 3}, default_days=15, run_date="2024-01-30")


@query("retention_run_ids", """
SELECT event_id, event_type FROM events
WHERE event_id % 7 = 0 OR NOT (CAST(ts AS DATE) + CASE WHEN event_type = 'error' THEN 3 ELSE 15 END < DATE '2024-01-30')
""")
def q_retention_run_ids(spark: SparkSession, sf: str) -> DataFrame:
    """W20 over run-id text, in the text's own offset; unreadable ids stay."""
    e = table(spark, sf, "events")
    offset = F.when(F.col("event_id") % 2 == 0, "+07:00").otherwise("+0700")
    run_id = F.when(F.col("event_id") % 7 == 0, "manual").otherwise(
        F.concat(F.lit("run_id=scheduled__"), F.substring(F.translate(F.col("ts").cast("string"), " ", "T"), 1, 19), offset))
    kept = retention_filter(e.select("event_id", "event_type", run_id.alias("run_id")), "run_id", "event_type",
                            {"error": 3}, default_days=15, run_date="2024-01-30")
    return kept.drop("run_id")


@query("completeness_gate", """
SELECT d.day, CASE WHEN e.day IS NULL THEN 'missing' ELSE 'existing' END AS status
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS DATE)
             AS day) d
LEFT JOIN (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) e ON d.day = e.day
""")
def q_completeness_gate(spark: SparkSession, sf: str) -> DataFrame:
    expected = spark.range(1).select(F.explode(F.sequence(
        F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date"))).alias("day"))
    present = table(spark, sf, "events").select(F.to_date("ts").alias("day"))
    return completeness(expected, present, ["day"])


@query("dated_accumulate", """
SELECT l_orderkey AS o_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total, count(*) AS n_lines
FROM lineitem GROUP BY l_orderkey
""")
def q_dated_accumulate(spark: SparkSession, sf: str) -> DataFrame:
    """The run date resolves to the business date of the schedule (no
    config, own value 'None'); totals accumulated before it plus the line
    deltas from it on must give the full per-order totals."""
    import datetime as dt
    from dockhand.plans.compositions import dated_accumulate
    v = view(spark, sf, "lineitem")
    li = table(spark, sf, "lineitem")
    target = (li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
              .groupBy(F.col("l_orderkey").alias("o_orderkey"))
              .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("total"),
                   F.count(F.lit(1)).alias("n_lines")))

    def builder(run_date: str) -> str:
        return (f"SELECT l_orderkey AS o_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS total, "
                f"CAST(1 AS BIGINT) AS n_lines FROM {v} WHERE l_shipdate >= CAST(:run_date AS TIMESTAMP_NTZ)")
    _, out = dated_accumulate(spark, target, builder, {"total": "sum", "n_lines": "sum"}, ["o_orderkey"],
                              conf_run_date=None, own_run_date="None",
                              execution_ts=dt.datetime(1997, 12, 31, 17, 30))
    return out
