"""Registered queries: nested conform, catalog tables, partition retirement, scripts as one text, ordered rules."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.operators.chunks import list_segments, read_used, retire_by_interval
from dockhand.operators.conform import conform_schema
from dockhand.operators.merge import append_load, upsert_expr_ordered
from dockhand.operators.retention import retire_partitions
from dockhand.plans.catalog import query, table, view
from dockhand.plans.compositions import table_to_catalog
from dockhand.plans.script import run_script_text
from dockhand.session import cut_lineage, scratch_path
from dockhand.sinks.catalog_tables import create_table, insert_table, list_partitions, publish_table
from dockhand.sinks.partitions import bulk_load_chunks, read_partitioned

_NESTED = (
    "o_orderkey bigint, detail struct<price: decimal(12,2), status: string>, "
    "marks array<struct<a: string, b: bigint>>, tags map<string, struct<x: double, y: bigint>>")


@query("conform_nested", """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS price, o_orderstatus AS status, o_orderpriority AS mark_a, o_custkey AS mark_b,
       2 * o_totalprice AS tag_x, o_custkey + 1 AS tag_y FROM orders
UNION ALL
SELECT -o_orderkey, NULL, o_orderstatus, NULL, o_custkey, NULL, o_custkey FROM orders WHERE o_orderstatus = 'F'
""")
def q_conform_nested(spark: SparkSession, sf: str) -> DataFrame:
    """P4 then W1: nested fields in another order, of other types, with an extra one (conform) and with missing ones (load)."""
    orders = table(spark, sf, "orders")
    text = lambda c: F.col(c).cast("string")
    shuffled = orders.select(
        F.array(F.struct(text("o_custkey").alias("b"), F.col("o_orderpriority").alias("a"))).alias("marks"), text("o_orderkey").alias("o_orderkey"),
        F.struct(F.col("o_orderstatus").alias("status"), F.lit(1).alias("unused"), F.col("o_totalprice").alias("price")).alias("detail"),
        F.create_map(F.lit("k"), F.struct((F.col("o_custkey") + 1).cast("int").alias("y"), (2 * F.col("o_totalprice")).alias("x"))).alias("tags"))
    declared = T.StructType.fromDDL(_NESTED)
    target = conform_schema(shuffled, declared, keep_extra=False).select(*declared.names)
    incoming = orders.where("o_orderstatus = 'F'").select(
        (-F.col("o_orderkey")).alias("o_orderkey"), F.struct(F.col("o_orderstatus").alias("status")).alias("detail"),
        F.array(F.struct(F.col("o_custkey").cast("int").alias("b"))).alias("marks"),
        F.create_map(F.lit("k"), F.struct(F.col("o_custkey").alias("y"))).alias("tags"))
    out, mark = append_load(target, incoming), F.col("marks")[0]
    return out.select("o_orderkey", "detail.price", "detail.status", mark["a"].alias("mark_a"), mark["b"].alias("mark_b"),
                      F.col("tags")["k"]["x"].alias("tag_x"), F.col("tags")["k"]["y"].alias("tag_y"))


def _event_table(spark: SparkSession, sf: str, cols: list[str]) -> tuple[str, DataFrame]:
    """A new catalog table for the events, partitioned by ``cols``, and the events with a day column."""
    name = f"dockhand_events_{uuid.uuid4().hex[:12]}"
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("d"))
    schema = T.StructType.fromDDL("event_id bigint, event_type string, d date, value double, ts timestamp_ntz")
    create_table(spark, name, schema, cols, location=scratch_path(spark, name))
    return name, events


def _taken(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """A copy of ``df`` from before the table goes from the catalog."""
    out = cut_lineage(df)
    spark.sql(f"DROP TABLE {name}")
    return out


_D = "strftime(ts, '%Y-%m-%d')"
_PUBLISHED = f"""
SELECT event_id, event_type, CAST({_D} AS DATE) AS d, ts,
       CASE WHEN {_D} = '2024-01-05' AND event_type = 'click' THEN value * 10 ELSE value END AS value
FROM events
WHERE NOT ({_D} IN ('2024-01-06', '2024-01-07') AND event_type = 'view') AND NOT ({_D} = '2024-01-09' AND event_type = 'click')
UNION ALL
SELECT -event_id, 'replayed', CAST({_D} AS DATE), ts, value FROM events WHERE {_D} = '2024-01-08'
"""


def _published(spark: SparkSession, sf: str) -> str:
    name, e = _event_table(spark, sf, ["event_type", "d"])
    days = ["2024-01-06", "2024-01-07"]
    # first load: values from the data
    publish_table(e, name)
    # one static partition replaced, a second one emptied
    static = e.where("d = '2024-01-05' AND event_type = 'click'").withColumn("value", F.col("value") * 10)
    publish_table(static.drop("d", "event_type"), name, {"event_type": "click", "d": "2024-01-05"}, overwrite=True)
    insert_table(e.where("event_id < 0"), name, {"event_type": "click", "d": "2024-01-09"}, overwrite=True)
    # the leading value static, days from the data: two partitions of 'view' are replaced by nothing of theirs,
    # so they are emptied through rows derived from the table itself
    own = spark.table(name).where(F.col("d").isin(*days) & (F.col("event_type") == "view")).where("false")
    for day in days:
        publish_table(own, name, {"event_type": "view", "d": day}, overwrite=True)
    # static leading value with days from the data, appended
    again = e.where("d = '2024-01-08'").withColumn("event_id", -F.col("event_id"))
    publish_table(again, name, {"event_type": "replayed"}, overwrite=False)
    return name


@query("catalog_publish", _PUBLISHED)
def q_catalog_publish(spark: SparkSession, sf: str) -> DataFrame:
    """W7, W8, W13, P4 on a catalog table; types (a date from text) come from the catalog."""
    name = _published(spark, sf)
    return _taken(spark, name, spark.table(name))


@query("catalog_partitions", f"SELECT event_type, d, count(*) AS n_rows FROM ({_PUBLISHED}) p GROUP BY event_type, d")
def q_catalog_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """W18 of the same table: partitions as the catalog lists them, with their rows."""
    name = _published(spark, sf)
    rows = spark.table(name).groupBy("event_type", "d").agg(F.count(F.lit(1)).alias("n_rows"))
    return _taken(spark, name, list_partitions(spark, name).join(rows, ["event_type", "d"]))


@query("table_to_catalog", f"""
SELECT event_id, event_type, ts, CAST(value AS DECIMAL(18,2)) AS amount, CAST({_D} AS DATE) AS d FROM events WHERE event_type <> 'error'
""")
def q_table_to_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """X5 with a catalog table as target: renamed, transformed, cast to the table's types, partitioned by the day."""
    v, name = view(spark, sf, "events"), f"dockhand_flow_{uuid.uuid4().hex[:12]}"
    table_to_catalog(
        spark, name, table=v, column_map={"value": "amount"},
        transform=lambda df: df.where("event_type <> 'error'").withColumn("d", F.date_format("ts", "yyyy-MM-dd")),
        schema=T.StructType.fromDDL("event_id bigint, event_type string, ts timestamp_ntz, amount decimal(18,2), d date"),
        partition_cols=["d"], location=scratch_path(spark, name), partitions_generator=lambda: ["d"], overwrite=True)
    return _taken(spark, name, spark.table(name))


@query("retire_partitions", """
SELECT event_id, event_type, CAST(ts AS DATE) AS d, ts, value FROM events
WHERE NOT (CAST(ts AS DATE) + CASE WHEN event_type = 'error' THEN 3 ELSE 15 END < DATE '2024-01-30')
""")
def q_retire_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """W20 by dropping whole partitions of a catalog table."""
    name, e = _event_table(spark, sf, ["event_type", "d"])
    insert_table(e, name)
    retire_partitions(spark, name, "d", "event_type", {"error": 3}, 15, "2024-01-30")
    return _taken(spark, name, spark.table(name))


@query("read_used_partitions", """
SELECT event_id, ts, event_type FROM events
WHERE CAST(ts AS DATE) NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-07' AND CAST(ts AS DATE) <> DATE '2024-01-20'
""")
def q_read_used_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """W15's read side on the partition column: folders of retired chunks are not scanned."""
    e = table(spark, sf, "events").select("event_id", "ts", "event_type")
    path = scratch_path(spark, "used_chunks")
    bulk_load_chunks(e, path, "ts")
    segments = cut_lineage(retire_by_interval(list_segments(e, "ts"), [("2024-01-05", "2024-01-08"), ("2024-01-20", "2024-01-21T12:00:00")]))
    chunked = read_partitioned(spark, path, T.StructType([*e.schema.fields, T.StructField("chunk", T.StringType())]))
    return read_used(chunked, segments, chunk_col="chunk").drop("chunk")


@query("sql_script_text", """
SELECT o_orderpriority, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, ';--' AS note,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS n_final
FROM orders WHERE o_orderdate >= DATE '1998-01-01' GROUP BY o_orderpriority
""")
def q_sql_script_text(spark: SparkSession, sf: str) -> DataFrame:
    """C1 from one text: a variable, a temporary view, a semicolon in a literal and in a comment, parameters, a handler."""
    v = view(spark, sf, "orders")
    recent = f"dockhand_recent_{uuid.uuid4().hex[:12]}"
    return run_script_text(spark, f"""
        DECLARE n_final BIGINT DEFAULT 0;
        SET n_final = (SELECT count(*) FROM {v} WHERE o_orderstatus = :status); -- a comment; with semicolons;
        CREATE OR REPLACE TEMPORARY VIEW {recent} AS SELECT * FROM {v} WHERE o_orderdate >= DATE '1998-01-01';
        SELECT o_orderpriority, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, ';--' AS note, n_final
        FROM {recent} GROUP BY o_orderpriority""",
        {"status": "F"}, on_error="SELECT 'failed' AS o_orderpriority, 0L AS n_orders, 0.0 AS total, '' AS note, 0L AS n_final")


_RULES_ORDER = ["o_orderdate", "o_orderkey"]


def _accounts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers (a third of them unknown yet) and their orders as account movements."""
    target = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    moves = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.lit("order").alias("c_name"), F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"), *_RULES_ORDER)
    return target, moves


@query("upsert_expr_ordered", """
WITH moves AS (
  SELECT o_custkey AS k, o_totalprice AS v, o_orderpriority AS p, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n
  FROM orders),
old AS (SELECT c_custkey AS k, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0),
lists AS (SELECT k, list({'v': v, 'p': p} ORDER BY n) AS m FROM moves GROUP BY k),
begun AS (
  SELECT coalesce(o.k, l.k) AS k, coalesce(o.c_name, 'order') AS c_name,
         CASE WHEN o.k IS NULL THEN l.m[1] ELSE {'v': o.c_acctbal, 'p': o.c_mktsegment} END AS first,
         CASE WHEN o.k IS NULL THEN l.m[2:] ELSE coalesce(l.m, []) END AS rest
  FROM old o FULL JOIN lists l ON o.k = l.k)
SELECT k AS c_custkey, c_name, r.v AS c_acctbal, r.p AS c_mktsegment
FROM (SELECT k, c_name, list_reduce(list_prepend(first, rest), lambda t, s:
        {'v': t.v / 2 + s.v, 'p': CASE WHEN s.v > t.v THEN s.p ELSE t.p END}) AS r FROM begun)
""")
def q_upsert_expr_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """W4 with repeated keys: a rule that depends on the order (the balance halves before each movement)."""
    target, moves = _accounts(spark, sf)
    return upsert_expr_ordered(target, moves, ["c_custkey"], {
        "c_acctbal": "t.c_acctbal / 2 + s.c_acctbal",
        "c_mktsegment": "CASE WHEN s.c_acctbal > t.c_acctbal THEN s.c_mktsegment ELSE t.c_mktsegment END"}, order_by=_RULES_ORDER)


@query("upsert_expr_associative", """
WITH moves AS (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS k, o_totalprice AS v, o_orderpriority AS p, o_orderdate AS d, o_orderkey AS n FROM orders),
best AS (SELECT k, max(v) AS v, arg_max(p, {'d': d, 'n': n}) AS p FROM moves GROUP BY k),
old AS (SELECT c_custkey AS k, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0)
SELECT coalesce(o.k, b.k) AS c_custkey, coalesce(o.c_name, 'order') AS c_name, greatest(o.c_acctbal, b.v) AS c_acctbal,
       coalesce(b.p, o.c_mktsegment) AS c_mktsegment
FROM old o FULL JOIN best b ON o.k = b.k
""")
def q_upsert_expr_associative(spark: SparkSession, sf: str) -> DataFrame:
    """W4 where rows may be folded in runs: one key holds a third of all rows and goes to many tasks."""
    target, moves = _accounts(spark, sf)
    hot = moves.withColumn("c_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("c_custkey")))
    return upsert_expr_ordered(target, hot, ["c_custkey"], {"c_acctbal": "greatest(t.c_acctbal, s.c_acctbal)", "c_mktsegment": "s.c_mktsegment"},
                               order_by=_RULES_ORDER, associative=True)
