"""Registered queries: conform, loads, keyed snapshots, batching, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.operators.batching import fixed_size_batches
from dockhand.operators.conform import conform_schema, force_string, nan_to_null, parse_and_drop, rename_columns
from dockhand.operators.keyed import latest_per_key
from dockhand.operators.merge import (append_load, delete_then_insert, upsert_accumulate, upsert_expr,
                                      upsert_ignore, upsert_update)
from dockhand.operators.quality import count_checks, nonempty_guard
from dockhand.plans.catalog import query, table, view
from dockhand.sources.tables import dated_extract

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]


def _target(spark: SparkSession, sf: str) -> DataFrame:
    """Target side of the load fixtures: orders whose key ends in 0-7."""
    return table(spark, sf, "orders").where(F.col("o_orderkey") % 10 < 8).select(*ORDER_COLS)


def _incoming(spark: SparkSession, sf: str) -> DataFrame:
    """Incoming side: keys ending in 6-9 (6-7 conflict, 8-9 new), changed values,
    columns deliberately in another order (loads match by name)."""
    o = table(spark, sf, "orders").where(F.col("o_orderkey") % 10 >= 6)
    return o.select("o_orderpriority", "o_orderdate", (F.col("o_totalprice") + 1).alias("o_totalprice"),
                    F.lit("U").alias("o_orderstatus"), "o_custkey", "o_orderkey")


_T_SQL = "SELECT * FROM orders WHERE o_orderkey % 10 < 8"
_S_SQL = ("SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, "
          "o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 >= 6")


@query("dated_extract", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders WHERE o_orderdate < DATE '2000-01-01'
""")
def q_dated_extract(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "orders")
    def builder(run_date: str) -> str:
        return (f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM {v} "
                "WHERE o_orderdate < CAST(:run_date AS DATE)")
    return nan_to_null(dated_extract(spark, builder, "2000-01-01", args={"run_date": "2000-01-01"}))


@query("nonempty_guard", "SELECT * FROM orders")
def q_nonempty_guard(spark: SparkSession, sf: str) -> DataFrame:
    return nonempty_guard(table(spark, sf, "orders"), "orders")


@query("nan_to_null", """
SELECT event_id,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE value * 2 END AS value2,
       event_type
FROM events
""")
def q_nan_to_null(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    nan = F.lit(float("nan"))
    dirty = e.select(
        "event_id",
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double"))
         .when(F.col("event_id") % 7 == 0, nan).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_id") % 7 == 0, nan).otherwise(F.col("value") * 2).alias("value2"),
        "event_type")
    return nan_to_null(dirty)


CONFORM_TARGET = T.StructType([
    T.StructField("o_orderkey", T.IntegerType()),
    T.StructField("o_custkey", T.IntegerType()),
    T.StructField("o_totalprice", T.DecimalType(12, 2)),
    T.StructField("o_orderdate", T.DateType()),
    T.StructField("o_orderstatus", T.StringType()),
])


@query("conform_schema", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderstatus, o_orderpriority
FROM orders
""")
def q_conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    return conform_schema(table(spark, sf, "orders"), CONFORM_TARGET, strict=True, keep_extra=True)


@query("rename_columns", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority
FROM orders
""")
def q_rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    # "O_CUSTKEY" matches case-insensitively; "no_such" is ignored
    return rename_columns(table(spark, sf, "orders"),
                          {"o_orderkey": "order_id", "O_CUSTKEY": "customer_id", "no_such": "x"})


@query("force_string", """
SELECT CAST(event_id AS VARCHAR) AS event_id, ts, CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(value AS VARCHAR) AS value, props
FROM events
""")
def q_force_string(spark: SparkSession, sf: str) -> DataFrame:
    return force_string(table(spark, sf, "events"), ["event_id", "user_id", "value"])


@query("parse_and_drop", """
SELECT event_id, upper(event_type) AS kind, value
FROM events WHERE event_type <> 'error'
""")
def q_parse_and_drop(spark: SparkSession, sf: str) -> DataFrame:
    def parser(df: DataFrame):
        rec = F.struct(F.col("event_id"), F.upper("event_type").alias("kind"), F.col("value"))
        return F.when(F.col("event_type") != "error", rec)
    return parse_and_drop(table(spark, sf, "events"), parser)


@query("append_load", f"SELECT * FROM ({_T_SQL}) UNION ALL SELECT * FROM ({_S_SQL})")
def q_append_load(spark: SparkSession, sf: str) -> DataFrame:
    return append_load(_target(spark, sf), _incoming(spark, sf))


@query("upsert_ignore", f"""
WITH t AS ({_T_SQL}), s AS ({_S_SQL})
SELECT * FROM t
UNION ALL
SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)
""")
def q_upsert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    return upsert_ignore(_target(spark, sf), _incoming(spark, sf), ["o_orderkey"])


@query("upsert_update", f"""
WITH t AS ({_T_SQL}), s AS ({_S_SQL})
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
""")
def q_upsert_update(spark: SparkSession, sf: str) -> DataFrame:
    return upsert_update(_target(spark, sf), _incoming(spark, sf), ["o_orderkey"], ["o_orderstatus"])


@query("upsert_expr", f"""
WITH t AS ({_T_SQL}), s AS ({_S_SQL})
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL THEN t.o_orderstatus || s.o_orderstatus
            WHEN t.o_orderkey IS NOT NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL THEN t.o_totalprice + s.o_totalprice
            WHEN t.o_orderkey IS NOT NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
""")
def q_upsert_expr(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"o_totalprice": "t.o_totalprice + s.o_totalprice",
             "o_orderstatus": "concat(t.o_orderstatus, s.o_orderstatus)"}
    return upsert_expr(_target(spark, sf), _incoming(spark, sf), ["o_orderkey"], rules)


def _acc_target(spark: SparkSession, sf: str) -> DataFrame:
    return _target(spark, sf).select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        F.col("o_orderstatus").alias("last_status"), F.col("o_orderdate").alias("last_ship"),
        F.col("o_orderpriority").alias("first_note"))


def _acc_incoming(spark: SparkSession, sf: str) -> DataFrame:
    """Daily line deltas: several rows per order (a key may repeat a lot)."""
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)").alias("total"),
        F.col("l_linestatus").alias("last_status"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_shipdate")).alias("last_ship"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("first_note"),
        "l_linenumber", *LINE_ORDER)


_ACC_ORDER = ", ".join(["l_linenumber"] + LINE_ORDER)
_ACC_ORDER_DESC = ", ".join(c + " DESC" for c in ["l_linenumber"] + LINE_ORDER)


@query("upsert_accumulate", f"""
WITH t AS (
  SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderstatus AS last_status,
         o_orderdate AS last_ship, o_orderpriority AS first_note
  FROM orders WHERE o_orderkey % 10 < 8),
l AS (
  SELECT l_orderkey AS o_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS total, l_linestatus AS last_status,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_shipdate END AS last_ship,
         'line ' || CAST(l_linenumber AS VARCHAR) AS first_note,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ACC_ORDER_DESC}) AS rn_last,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ACC_ORDER}) AS rn_first,
         first_value(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_shipdate END IGNORE NULLS) OVER (
           PARTITION BY l_orderkey ORDER BY {_ACC_ORDER_DESC}
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_nn_ship
  FROM lineitem),
s AS (
  SELECT o_orderkey, SUM(total) AS total, MAX(CASE WHEN rn_last = 1 THEN last_status END) AS last_status,
         MAX(last_nn_ship) AS last_ship, MAX(CASE WHEN rn_first = 1 THEN first_note END) AS first_note
  FROM l GROUP BY o_orderkey)
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CAST(CASE WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL
                 THEN COALESCE(t.total, 0) + COALESCE(s.total, 0)
                 WHEN t.o_orderkey IS NOT NULL THEN t.total ELSE s.total END AS DECIMAL(18,2)) AS total,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.last_status ELSE t.last_status END AS last_status,
       CASE WHEN t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL THEN COALESCE(s.last_ship, t.last_ship)
            WHEN t.o_orderkey IS NOT NULL THEN t.last_ship ELSE s.last_ship END AS last_ship,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.first_note ELSE s.first_note END AS first_note
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
""")
def q_upsert_accumulate(spark: SparkSession, sf: str) -> DataFrame:
    return upsert_accumulate(_acc_target(spark, sf), _acc_incoming(spark, sf), ["o_orderkey"],
                             {"total": "sum", "last_status": "replace", "last_ship": "coalesce"},
                             order_by=["l_linenumber", *LINE_ORDER])


_DAY = "ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-06 00:00:00'"


@query("delete_then_insert", f"""
SELECT event_id, ts, user_id, event_type, value FROM events WHERE NOT ({_DAY})
UNION ALL
SELECT event_id, ts, user_id, event_type, value * 2 AS value FROM events WHERE {_DAY}
""")
def q_delete_then_insert(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    fresh = e.where(F.expr(_DAY)).withColumn("value", F.col("value") * 2)
    return delete_then_insert(e, fresh, _DAY)


@query("latest_per_key", f"""
SELECT l_orderkey, l_linenumber, {", ".join(LINE_ORDER)}
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY {", ".join(c + " DESC" for c in LINE_ORDER)}) AS rn
      FROM lineitem) WHERE rn = 1
""")
def q_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)


@query("fixed_size_batches", """
SELECT *, o_orderstatus || '!' AS tag,
       CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 500) AS BIGINT) AS batch_id,
       CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % 500 AS BIGINT) AS batch_row
FROM orders
""")
def q_fixed_size_batches(spark: SparkSession, sf: str) -> DataFrame:
    # a map column has no order: it is carried, not a tie-breaker
    o = table(spark, sf, "orders").withColumn("tags", F.create_map(F.lit("tag"), F.concat("o_orderstatus", F.lit("!"))))
    b = fixed_size_batches(o, 500, ["o_orderkey"])
    return b.withColumn("tag", F.col("tags")["tag"]).drop("tags", "row_index")


@query("dq_count_check", """
SELECT 'orders' AS check_table, '2024-01-30' AS run_date, count(*) AS observed, count(*) >= 1 AS passed FROM orders
UNION ALL
SELECT 'customer', '2024-01-30', count(*), count(*) >= 1 FROM customer
UNION ALL
SELECT 'part', '2024-01-30', count(*), count(*) >= 1 FROM part WHERE p_size < 0
""")
def q_dq_count_check(spark: SparkSession, sf: str) -> DataFrame:
    for t in ("orders", "customer", "part"):
        view(spark, sf, t)

    def builder(run_date: str, schema: str, tbl: str) -> str:
        # part: a check that must fail (no part has a negative size)
        cond = " WHERE p_size < 0" if tbl == "part" else ""
        return f"SELECT count(*) FROM dh_{tbl}{cond}"
    return count_checks(spark, builder, ["orders", "customer", "part"], run_date="2024-01-30")
