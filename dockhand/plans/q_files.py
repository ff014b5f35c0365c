"""Registered queries: document scans, file sets, exports, partitioned loads.

Writers go to fresh folders under the shared scratch root; each query
writes, then returns a frame that reads the written data back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.operators.batching import ordered_layout
from dockhand.functions.timefmt import ntz_text
from dockhand.operators.chunks import chunk_start
from dockhand.session import scratch_path
from dockhand.sinks.files import export_parquet, export_snapshot, truncate_path
from dockhand.operators.merge import upsert_update
from dockhand.sinks.partitions import (bulk_load_chunks, insert_dynamic, insert_static, merge_partitions,
                                       read_partitioned, stage_and_publish)
from dockhand.sources.documents import read_hits, scan_counts, scan_documents, scan_output_path, write_scan
from dockhand.sources.files import file_row_counts, inventory_with_rows, read_files
from dockhand.sources.tables import Source, import_query, time_window
from dockhand.plans.catalog import query, table, view

SOURCE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType())])


def _hit_text(spark: SparkSession, sf: str, corrupt: bool) -> DataFrame:
    """Events as search hits (JSON text); optionally some unreadable hits."""
    e = table(spark, sf, "events")
    js = F.to_json(F.struct(F.col("event_id").cast("string").alias("_id"),
                            F.struct("event_id", "user_id", "event_type", "value", "props").alias("_source")))
    if corrupt:
        broken = F.concat(F.lit('{"_id": "'), F.col("event_id").cast("string"), F.lit('", "_source": {broken'))
        js = F.when(F.col("event_id") % 97 == 0, broken).otherwise(js)
    return e.select(js.alias("value"))


def _parse_hit(df: DataFrame):
    """Parser of a hit: a record, or NULL for error events (dropped)."""
    src = F.col("_source")
    rec = F.struct(F.col("_id").alias("doc_id"), src["user_id"].alias("user_id"),
                   src["event_type"].alias("event_type"), src["value"].alias("value"), src["props"].alias("props"))
    return F.when(src["event_type"] != "error", rec)


@query("document_scan", """
SELECT CAST(event_id AS VARCHAR) AS doc_id, CAST(user_id AS VARCHAR) AS user_id, event_type, value, props
FROM events WHERE event_type <> 'error'
""")
def q_document_scan(spark: SparkSession, sf: str) -> DataFrame:
    hits = read_hits(None, SOURCE_SCHEMA, text=_hit_text(spark, sf, corrupt=False))
    recs = scan_documents(hits, _parse_hit, force_str_cols=["user_id"])
    root = scan_output_path(scratch_path(spark, "document_scan"), "2024-01-05T00:00:00+07:00")
    out = write_scan(recs, root, page_size=100, pages_per_file=30)
    return spark.read.parquet(out)


@query("tolerant_scan", """
SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS doc_id,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type END AS event_type,
       event_id % 97 = 0 AS is_corrupt
FROM events
""")
def q_tolerant_scan(spark: SparkSession, sf: str) -> DataFrame:
    hits = read_hits(None, SOURCE_SCHEMA, text=_hit_text(spark, sf, corrupt=True), tolerant=True)
    return hits.select(F.col("_id").alias("doc_id"), F.col("_source.event_type").alias("event_type"),
                       F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


@query("row_reconciliation", """
SELECT count(*) AS source_rows,
       count(*) FILTER (WHERE event_id % 97 <> 0 AND event_type <> 'error') AS parsed_rows,
       count(*) FILTER (WHERE NOT (event_id % 97 <> 0 AND event_type <> 'error')) AS dropped_rows,
       count(*) FILTER (WHERE event_id % 97 = 0) AS corrupt_rows
FROM events
""")
def q_row_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    hits = read_hits(None, SOURCE_SCHEMA, text=_hit_text(spark, sf, corrupt=True), tolerant=True)
    return scan_counts(hits, _parse_hit)


@query("time_window_extract", """
SELECT event_id, ts, event_type, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'
""")
def q_time_window_extract(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return time_window(e, "ts", "2024-01-05T00:00:00", hours=7 * 24)


@query("filtered_file_read", "SELECT * FROM orders")
def q_filtered_file_read(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "orders").schema
    return read_files(spark, sf, "parquet", glob="*.parquet", schema=schema,
                      name_predicate=lambda name: name.startswith("orders"))


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
           "pages", "benchmark", "labels", "conversations")


@query("file_inventory", " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS file_name, count(*) AS rows, true AS has_bytes FROM {t}" for t in _TABLES))
def q_file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    files = inventory_with_rows(spark, sf, glob="*.parquet")
    return files.select("file_name", "rows", (F.col("length") > 0).alias("has_bytes"))


@query("import_table", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'F'
""")
def q_import_table(spark: SparkSession, sf: str) -> DataFrame:
    from dockhand.plans.compositions import import_to_files
    src = Source(format="parquet", path=f"{sf.rstrip('/')}/{{table}}.parquet")
    out = import_to_files(spark, scratch_path(spark, "import_table"), table="orders", source=src,
                          columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
                          where="o_orderstatus = 'F'", split_by="o_orderkey", num_partitions=4)
    return spark.read.parquet(out)


@query("import_query", """
SELECT o_orderstatus, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
FROM orders GROUP BY o_orderstatus
""")
def q_import_query(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "orders")
    df = import_query(spark, f"SELECT o_orderstatus, count(*) AS n_orders, "
                             f"sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM {v} GROUP BY o_orderstatus")
    out = export_snapshot(df, scratch_path(spark, "import_query"), "2024-01-30", "parquet")
    return spark.read.parquet(out)


@query("export_parquet", "SELECT * FROM events")
def q_export_parquet(spark: SparkSession, sf: str) -> DataFrame:
    out = export_parquet(table(spark, sf, "events"), scratch_path(spark, "export_parquet"),
                         compression="gzip", max_records_per_file=1000)
    return spark.read.parquet(out)


@query("export_row_cap", "SELECT count(*) AS n_rows, 0 AS files_over_cap, least(count(*), 1000) AS largest_file FROM events")
def q_export_row_cap(spark: SparkSession, sf: str) -> DataFrame:
    """The rows-per-file cap, seen from the written files."""
    out = export_parquet(table(spark, sf, "events"), scratch_path(spark, "export_row_cap"), max_records_per_file=1000)
    per_file = file_row_counts(spark, out)
    return per_file.agg(F.sum("rows").alias("n_rows"), F.count_if(F.col("rows") > 1000).cast("int").alias("files_over_cap"),
                        F.max("rows").alias("largest_file"))


@query("ordered_export", "SELECT * FROM orders")
def q_ordered_export(spark: SparkSession, sf: str) -> DataFrame:
    o = ordered_layout(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], total=True)
    out = export_parquet(o, scratch_path(spark, "ordered_export"), max_records_per_file=5000)
    return spark.read.parquet(out)


@query("ordered_export_order", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS out_of_order FROM orders")
def q_ordered_export_order(spark: SparkSession, sf: str) -> DataFrame:
    """The order itself: inside each file by row position, and from file to file by name."""
    o = ordered_layout(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], total=True)
    out = export_parquet(o, scratch_path(spark, "ordered_export_order"), max_records_per_file=5000)
    rows = spark.read.parquet(out).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"),
                                          F.struct("o_orderdate", "o_orderkey").alias("k"))
    inside = Window.partitionBy("file").orderBy("at")
    files = (rows.withColumn("down", F.lag("k").over(inside) > F.col("k")).groupBy("file")
             .agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count(F.lit(1)).alias("n"), F.count_if("down").alias("down")))
    across = files.withColumn("over", F.lag("hi").over(Window.orderBy("file")) > F.col("lo"))  # a row per file
    return across.agg(F.sum("n").alias("n_rows"), (F.sum("down") + F.count_if("over")).alias("out_of_order"))


@query("import_to_csv", """
SELECT event_id, CAST(ts + INTERVAL 123456 MICROSECOND AS VARCHAR) AS ts_text, 'say "' || event_type || '", twice' AS said FROM events
""")
def q_import_to_csv(spark: SparkSession, sf: str) -> DataFrame:
    """X9 to CSV: microseconds and quotes survive the round trip."""
    from dockhand.plans.compositions import import_to_files
    v = view(spark, sf, "events")
    out = import_to_files(spark, scratch_path(spark, "import_csv"), file_type="csv",
                          query=f"SELECT event_id, ts + INTERVAL '0.123456' SECOND AS ts, concat('say \"', event_type, '\", twice') AS said FROM {v}")
    back = (spark.read.schema("event_id long, ts timestamp_ntz, said string").option("header", "true").option("escape", '"')
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(out))
    return back.select("event_id", F.col("ts").cast("string").alias("ts_text"), "said")


@query("import_to_text", """
SELECT CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus || '|' || CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE o_orderpriority END AS line
FROM orders
""")
def q_import_to_text(spark: SparkSession, sf: str) -> DataFrame:
    """X9 to delimited text."""
    from dockhand.plans.compositions import import_to_files
    v = view(spark, sf, "orders")
    out = import_to_files(spark, scratch_path(spark, "import_text"), file_type="text", delimiter="|",
                          query=f"SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS p FROM {v}")
    return spark.read.text(out).select(F.col("value").alias("line"))


@query("files_to_chunks", """
SELECT *, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS chunk FROM events
""")
def q_files_to_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Staged files that pass the filter, loaded by hour and dropped after."""
    from dockhand.plans.compositions import files_to_chunks
    e = table(spark, sf, "events")
    staged, path = scratch_path(spark, "staged_files"), scratch_path(spark, "hour_chunks")
    e.write.parquet(f"{staged}/loaded")
    files_to_chunks(spark, staged, path, "ts", glob="part-*", granularity="hour", remove_after=True)
    return read_partitioned(spark, path, T.StructType([*e.schema.fields, T.StructField("chunk", T.StringType())]))


@query("export_snapshot", "SELECT * FROM orders")
def q_export_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    out = export_snapshot(o, scratch_path(spark, "snapshot"), "2024-01-30", "csv", name="orders")
    return (spark.read.schema(o.schema).option("header", "true")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(out))


@query("fan_out_write", """
SELECT o_orderkey AS order_id, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS part
FROM orders
""")
def q_fan_out_write(spark: SparkSession, sf: str) -> DataFrame:
    from dockhand.plans.compositions import table_to_files
    v = view(spark, sf, "orders")

    def split(df: DataFrame) -> list[DataFrame]:
        return [df.where(F.col("o_orderstatus") == s) for s in ("F", "O")] + [
            df.where(~F.col("o_orderstatus").isin("F", "O"))]
    paths = table_to_files(spark, scratch_path(spark, "fan_out"), "orders", table=v, transform=split,
                           column_map={"o_orderkey": "order_id"}, materialize=True)
    out = None
    for i, p in enumerate(paths):
        part = spark.read.parquet(p).withColumn("part", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out


def _day(ts: str = "ts"):
    return F.date_format(ts, "yyyy-MM-dd")


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]
_PART_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("d", T.StringType())])


def _day_table(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """Events written as a day-partitioned table in a fresh folder."""
    e = table(spark, sf, "events").select(*EVENT_COLS)
    path = scratch_path(spark, "events_by_day")
    insert_dynamic(e.withColumn("d", _day()), path, ["d"], overwrite=True)
    return e, path


_D = "strftime(ts, '%Y-%m-%d')"


@query("partition_overwrite_static", f"""
SELECT event_id, ts, user_id, event_type,
       CASE WHEN {_D} = '2024-01-05' THEN value * 10 ELSE value END AS value, {_D} AS d
FROM events
""")
def q_partition_overwrite_static(spark: SparkSession, sf: str) -> DataFrame:
    e, path = _day_table(spark, sf)
    fresh = e.where(_day() == "2024-01-05").withColumn("value", F.col("value") * 10)
    insert_static(fresh, path, {"d": "2024-01-05"}, overwrite=True)
    return read_partitioned(spark, path, _PART_SCHEMA)


@query("partition_overwrite_empty", """
SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS h FROM events
WHERE date_trunc('hour', ts) <> TIMESTAMP '2024-01-05 03:00:00'
""")
def q_partition_overwrite_empty(spark: SparkSession, sf: str) -> DataFrame:
    """W7 with no rows, on a partition value that folder names escape."""
    e = table(spark, sf, "events").select("event_id", ntz_text(chunk_start("ts", "hour")).alias("h"))
    path = scratch_path(spark, "events_by_hour")
    insert_dynamic(e, path, ["h"], overwrite=True)
    insert_static(e.select("event_id").where("event_id < 0"), path, {"h": "2024-01-05T03:00:00"}, overwrite=True)
    return read_partitioned(spark, path, e.schema)


@query("partition_overwrite_dynamic", f"""
SELECT event_id, ts, user_id, event_type, value, {_D} AS d FROM events
WHERE {_D} NOT IN ('2024-01-05', '2024-01-06')
UNION ALL
SELECT event_id, ts, user_id, event_type, value * 10 AS value, {_D} AS d FROM events
WHERE {_D} IN ('2024-01-05', '2024-01-06') AND event_type <> 'view'
""")
def q_partition_overwrite_dynamic(spark: SparkSession, sf: str) -> DataFrame:
    e, path = _day_table(spark, sf)
    fresh = (e.where(_day().isin("2024-01-05", "2024-01-06") & (F.col("event_type") != "view"))
             .withColumn("value", F.col("value") * 10).withColumn("d", _day()))
    insert_dynamic(fresh, path, ["d"], overwrite=True)
    return read_partitioned(spark, path, _PART_SCHEMA)


@query("partition_append", f"""
SELECT event_id, ts, user_id, event_type, value, {_D} AS d FROM events
UNION ALL
SELECT event_id, ts, user_id, event_type, value * 10 AS value, {_D} AS d FROM events WHERE {_D} = '2024-01-05'
""")
def q_partition_append(spark: SparkSession, sf: str) -> DataFrame:
    e, path = _day_table(spark, sf)
    fresh = e.where(_day() == "2024-01-05").withColumn("value", F.col("value") * 10).withColumn("d", _day())
    insert_dynamic(fresh, path, ["d"], overwrite=False)
    return read_partitioned(spark, path, _PART_SCHEMA)


@query("stage_and_publish", f"""
SELECT event_id, ts, user_id, event_type,
       CASE WHEN {_D} = '2024-01-07' THEN value + 1 ELSE value END AS value, {_D} AS d
FROM events
""")
def q_stage_and_publish(spark: SparkSession, sf: str) -> DataFrame:
    _, path = _day_table(spark, sf)
    # incoming rows are derived from the target itself: staging makes that safe
    cur = read_partitioned(spark, path, _PART_SCHEMA)
    fresh = cur.where(F.col("d") == "2024-01-07").withColumn("value", F.col("value") + 1).drop("d")
    stage_and_publish(fresh, path, {"d": "2024-01-07"}, overwrite=True)
    return read_partitioned(spark, path, _PART_SCHEMA)


@query("bulk_load_chunks", """
SELECT *, strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%S') AS chunk FROM events
""")
def q_bulk_load_chunks(spark: SparkSession, sf: str) -> DataFrame:
    files = read_files(spark, sf, "parquet", glob="events*.parquet")
    path = scratch_path(spark, "chunks")
    bulk_load_chunks(files, path, "ts", "day")
    schema = T.StructType(files.schema.fields + [T.StructField("chunk", T.StringType())])
    return read_partitioned(spark, path, schema)


@query("truncate_table", "SELECT * FROM events WHERE event_id < 0")
def q_truncate_table(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    path = scratch_path(spark, "truncate")
    e.write.mode("overwrite").parquet(path)
    return spark.read.parquet(truncate_path(spark, path))


@query("upsert_touched_partitions", f"""
WITH t AS (SELECT event_id, ts, user_id, event_type, value, {_D} AS d FROM events),
     s AS (SELECT event_id, ts, user_id, event_type, value + 100 AS value, {_D} AS d FROM events
           WHERE {_D} IN ('2024-01-03', '2024-01-04') AND event_type = 'purchase'
           UNION ALL
           SELECT event_id + 100000000 AS event_id, ts, user_id, 'refund' AS event_type, -value AS value, {_D} AS d
           FROM events WHERE {_D} = '2024-01-04' AND event_type = 'purchase'
           UNION ALL
           SELECT event_id, ts, user_id, event_type, value, '2024-01-04' AS d FROM events WHERE {_D} = '2024-01-10' AND event_type = 'error')
SELECT COALESCE(t.event_id, s.event_id) AS event_id,
       CASE WHEN t.event_id IS NOT NULL THEN t.ts ELSE s.ts END AS ts,
       CASE WHEN t.event_id IS NOT NULL THEN t.user_id ELSE s.user_id END AS user_id,
       CASE WHEN t.event_id IS NOT NULL THEN t.event_type ELSE s.event_type END AS event_type,
       CASE WHEN s.event_id IS NOT NULL THEN s.value ELSE t.value END AS value,
       COALESCE(s.d, t.d) AS d
FROM t FULL OUTER JOIN s ON t.event_id = s.event_id
""")
def q_upsert_touched_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """W3 on a day-partitioned table, reading and rewriting only the two
    partitions the incoming rows touch and the one that keys move from (the
    other 27 stay as written)."""
    e, path = _day_table(spark, sf)
    day = _day()
    fixed = (e.where(day.isin("2024-01-03", "2024-01-04") & (F.col("event_type") == "purchase"))
             .withColumn("value", F.col("value") + 100))
    refunds = (e.where((day == "2024-01-04") & (F.col("event_type") == "purchase"))
               .select((F.col("event_id") + 100000000).alias("event_id"), "ts", "user_id",
                       F.lit("refund").alias("event_type"), (-F.col("value")).alias("value")))
    moved = e.where((day == "2024-01-10") & (F.col("event_type") == "error")).withColumn("d", F.lit("2024-01-04"))
    incoming = fixed.unionByName(refunds).withColumn("d", _day()).unionByName(moved)
    merge_partitions(spark, path, _PART_SCHEMA, incoming, ["d"],
                     lambda t, s: upsert_update(t, s, ["event_id"], ["value", "d"]), keys=["event_id"])
    return read_partitioned(spark, path, _PART_SCHEMA)
