"""Registered queries: paged scans and batched writes through Python data sources, touched-file
merges, grouped pandas code, missing ranges."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.operators.merge import upsert_ignore, upsert_update
from dockhand.operators.quality import missing_ranges
from dockhand.plans.catalog import query, table
from dockhand.plans.transforms import pandas_grouped
from dockhand.session import scratch_path
from dockhand.sinks.batched import FolderSink, batched_write
from dockhand.sinks.touched_files import append_unseen, merge_touched_files
from dockhand.sources.paged import page_report, paged_hits, write_pages

_SLICES, _PAGE = 8, 500


def _pages(spark: SparkSession, sf: str) -> str:
    """The events as chains of pages; every seventh page has four of five shards, every other of those one skipped."""
    def shards(n):
        short = n % 7 == 3
        return F.struct(F.lit(5).alias("total"), F.when(short, 4).otherwise(5).alias("successful"),
                        F.when(short & (n % 2 == 0), 1).otherwise(0).alias("skipped"))
    source = F.struct("event_type", "user_id", F.col("ts").cast("string").alias("ts"))
    return write_pages(spark, table(spark, sf, "events"), scratch_path(spark, "pages"), ["event_id"], source,
                       F.col("event_id").cast("string"), _SLICES, _PAGE, shards)


_PAGED = f"""
WITH numbered AS (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // {_PAGE} AS n FROM events),
pages AS (
  SELECT n, n % {_SLICES} AS slice, count(*) AS hits, count(*) FILTER (WHERE event_type <> 'error') AS kept,
         n % 7 = 3 AND n % 2 = 1 AS failed FROM numbered GROUP BY n)
"""


@query("paged_scan", f"""{_PAGED}
SELECT CAST(slice AS INT) AS slice, count(*) AS pages, CAST(sum(hits) AS BIGINT) AS hits_read, CAST(sum(kept) AS BIGINT) AS hits_kept,
       (SELECT count(*) FROM events) AS hits_matched, count(*) FILTER (WHERE failed) AS failed_shards
FROM pages GROUP BY slice
""")
def q_paged_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Hits kept and matched, pages and failed shards of each slice of a paged scan."""
    path = _pages(spark, sf)
    hits = paged_hits(spark, path)
    kept = hits.where(F.get_json_object("_source", "$.event_type") != "error").groupBy("slice").agg(F.count(F.lit(1)).alias("hits_kept"))
    report = page_report(spark, path).groupBy("slice").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("hits").alias("hits_read"), F.max("matched").alias("hits_matched"),
        F.sum("failed").alias("failed_shards"))
    return report.join(kept, "slice", "left").withColumn("hits_kept", F.coalesce("hits_kept", F.lit(0).cast("long")))


@query("paged_hits", f"""{_PAGED}
SELECT CAST(event_id AS VARCHAR) AS doc_id, event_type, user_id, CAST(n % {_SLICES} AS INT) AS slice, CAST(n // {_SLICES} AS INT) AS page
FROM numbered
""")
def q_paged_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Every hit of a tolerant paged scan, with its place."""
    hits = paged_hits(spark, _pages(spark, sf))
    rec = F.from_json("_source", "event_type string, user_id long")
    return hits.select(F.col("_id").alias("doc_id"), rec["event_type"].alias("event_type"), rec["user_id"].alias("user_id"), "slice", "page")


@query("batched_write", "SELECT event_id, event_type, user_id, value, 0 AS files_over_cap FROM events")
def q_batched_write(spark: SparkSession, sf: str) -> DataFrame:
    """Events written in batches of at most 1,000 rows a call, published together, read back."""
    path = scratch_path(spark, "batched")
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id", "value")
    batched_write(events, FolderSink(path), 1000)
    batched_write(events, FolderSink(path), 1000, mode="overwrite")  # replaces the first write
    back = spark.read.schema(events.schema).option("recursiveFileLookup", "true").json(path)
    files = back.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return back.withColumn("files_over_cap", F.lit(files.where("n > 1000").count()).cast("int"))


@query("upsert_touched_files", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-07-01' THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority FROM orders
UNION ALL
SELECT -o_orderkey, o_custkey, 'U', o_totalprice + 1, o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
""")
def q_upsert_touched_files(spark: SparkSession, sf: str) -> DataFrame:
    """W3 then W2 on an unpartitioned table of files laid out by date: a recent delta rewrites recent files only."""
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "orders_files")
    orders.repartitionByRange(16, "o_orderdate").write.parquet(path)
    recent = orders.where("o_orderdate >= timestamp_ntz'2000-07-01 00:00:00'").withColumn("o_orderstatus", F.lit("U"))
    last = orders.where("o_orderdate >= timestamp_ntz'2001-01-01 00:00:00'")
    new = last.withColumn("o_orderkey", -F.col("o_orderkey")).withColumn("o_orderstatus", F.lit("U")).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    merge_touched_files(spark, path, orders.schema, recent.unionByName(new), ["o_orderkey"],
                        lambda t, s: upsert_update(t, s, ["o_orderkey"], ["o_orderstatus"]))
    more = last.withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000).unionByName(last).withColumn("o_orderstatus", F.lit("N"))
    append_unseen(spark, path, orders.schema, more, ["o_orderkey"], lambda t, s: upsert_ignore(t, s, ["o_orderkey"]))
    return spark.read.schema(orders.schema).parquet(path)


@query("pandas_grouped", """
WITH steps AS (
  SELECT event_type, event_id, ts, user_id, lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before FROM events)
SELECT event_type, count(*) AS n_events, CAST(max(date_diff('microsecond', before, ts)) // 1000000 AS BIGINT) AS longest_gap_s,
       CAST(count(*) FILTER (WHERE before IS NULL OR date_diff('microsecond', before, ts) > 600000000) AS BIGINT) AS sessions
FROM steps GROUP BY event_type
""")
def q_pandas_grouped(spark: SparkSession, sf: str) -> DataFrame:
    """U3 per group: pauses and sessions of each event type, read in time order a batch at a time."""
    def sessions(batches):
        kind, n, longest, begun, last = None, 0, 0, 0, None
        for b in batches:
            kind = b["event_type"].iloc[0]
            gaps = b["ts"].diff().dt.total_seconds()
            if last is not None:
                gaps.iloc[0] = (b["ts"].iloc[0] - last).total_seconds()
            n, last = n + len(b), b["ts"].iloc[-1]
            begun += int((gaps.isna() | (gaps > 600)).sum())
            longest = max(longest, 0 if gaps.isna().all() else int(gaps.max()))
        yield pd.DataFrame({"event_type": [kind], "n_events": [n], "longest_gap_s": [longest], "sessions": [begun]})

    events = table(spark, sf, "events").select("event_type", "event_id", "ts")
    return pandas_grouped(events, ["event_type"], sessions, "event_type string, n_events long, longest_gap_s long, sessions long",
                          order_by=["ts", "event_id"])


@query("missing_ranges", """
WITH hours AS (
  SELECT event_type, h FROM (SELECT DISTINCT event_type FROM events) t, (SELECT unnest(generate_series(
    TIMESTAMP '2023-12-31 00:00:00', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS h) s),
absent AS (
  SELECT event_type, h, date_diff('hour', TIMESTAMP '1970-01-01', h) - row_number() OVER (PARTITION BY event_type ORDER BY h) AS island
  FROM hours ANTI JOIN (SELECT DISTINCT event_type, date_trunc('hour', ts) AS h FROM events) e USING (event_type, h))
SELECT event_type, min(h) AS missing_from, max(h) + INTERVAL 1 HOUR AS missing_until, count(*) AS n_chunks FROM absent GROUP BY event_type, island
""")
def q_missing_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Q5 as ranges: hours without an event of each type."""
    return missing_ranges(table(spark, sf, "events"), "ts", "2023-12-31", "2024-02-01", "hour", ["event_type"])
