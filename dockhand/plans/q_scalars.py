"""Registered queries: ISO timestamps, business dates, names, JSON, maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.functions.jsonflat import json_flatten, json_flatten_map
from dockhand.functions.maps import map_subset
from dockhand.functions.names import snake_case, snake_case_name
from dockhand.functions.timefmt import (business_date, compact_ts, hour_label, hour_path, iso_date,
                                        iso_wall_clock, run_date_resolution, utc_wall_clock,
                                        wall_clock_parts, instant_micros, with_wall_clock)
from dockhand.plans.catalog import query, table


def _iso_text() -> Column:
    """``events.ts`` written as ISO text in the three accepted offset styles."""
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    m = F.col("event_id") % 3
    return (F.when(m == 0, F.concat(base, F.lit("+07:00")))
            .when(m == 1, F.concat(base, F.lit("+0700")))
            .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))))


def _iso_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", _iso_text().alias("s"))


# DuckDB side: the text's wall clock is ts cut to seconds (offset styles) or milliseconds (Z style)
_WALL = ("CASE WHEN event_id % 3 = 2 THEN date_trunc('millisecond', ts) "
         "ELSE date_trunc('second', ts) END")
_OFFSET_US = "CASE WHEN event_id % 3 = 2 THEN 0 ELSE 25200000000 END"


@query("parse_iso_ts", f"""
SELECT event_id, epoch_us({_WALL}) - {_OFFSET_US} AS instant_us,
       make_timestamp(epoch_us({_WALL}) - {_OFFSET_US}) AS utc_ts
FROM events
""")
def q_parse_iso_ts(spark: SparkSession, sf: str) -> DataFrame:
    e = _iso_events(spark, sf)
    return e.select("event_id", instant_micros("s", strict=True).alias("instant_us"),
                    utc_wall_clock("s", strict=True).alias("utc_ts"))


@query("iso_ts_parts", """
SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour FROM events
""")
def q_iso_ts_parts(spark: SparkSession, sf: str) -> DataFrame:
    w = with_wall_clock(_iso_events(spark, sf), "s", "w", strict=True)
    return w.select("event_id", *wall_clock_parts("w"))


@query("iso_date", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS iso_date, "
                   f"{_WALL} AS wall_clock FROM events")
def q_iso_date(spark: SparkSession, sf: str) -> DataFrame:
    e = with_wall_clock(_iso_events(spark, sf), "s", "wall_clock", strict=True)
    return e.select("event_id", F.date_format("wall_clock", "yyyy-MM-dd").alias("iso_date"), "wall_clock")


@query("hour_label", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H') || '-00-00' AS hour_label FROM events")
def q_hour_label(spark: SparkSession, sf: str) -> DataFrame:
    return _iso_events(spark, sf).select("event_id", hour_label("s", strict=True).alias("hour_label"))


@query("compact_ts", """
SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') AS compact, strftime(ts, '%Y%m%dT%H') AS compact_hour
FROM events
""")
def q_compact_ts(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select("event_id", compact_ts("ts").alias("compact"),
                    compact_ts("ts", "yyyyMMdd'T'HH").alias("compact_hour"))


@query("hour_path", """
SELECT event_id, strftime(ts, '%Y/%m/%d') AS day_path, strftime(ts, '%H') || '-00-00' AS hour_file
FROM events
""")
def q_hour_path(spark: SparkSession, sf: str) -> DataFrame:
    day, hour = hour_path("s", strict=True)
    return _iso_events(spark, sf).select("event_id", day.alias("day_path"), hour.alias("hour_file"))


@query("business_date", """
SELECT event_id, CAST(ts + INTERVAL 7 HOUR AS DATE) AS business_date FROM events
""")
def q_business_date(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", business_date("ts").alias("business_date"))


@query("run_date_resolution", """
SELECT event_id,
       CASE WHEN event_id % 3 = 0 THEN '2024-02-01'
            WHEN event_id % 3 = 2 THEN '2024-03-01'
            ELSE strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d') END AS run_date
FROM events
""")
def q_run_date_resolution(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    m = F.col("event_id") % 3
    conf = F.when(m == 0, F.lit("2024-02-01"))                  # triggered with a run date
    own = F.when(m == 1, F.lit("None")).otherwise(F.lit("2024-03-01"))  # templated own value
    return e.select("event_id", run_date_resolution(conf, own, "ts").alias("run_date"))


def _camel_name() -> Column:
    t = F.col("event_type")
    cap = F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 100000))
    return F.concat(F.lit("user"), cap, F.lit("ID"), F.col("user_id").cast("string"), F.lit("__fooBar"),
                    (F.col("event_id") % 10).cast("string"), F.lit("Z"))


@query("snake_case", """
SELECT event_id, name,
       lower(regexp_replace(regexp_replace(name, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '_+', '_', 'g')) AS snake
FROM (SELECT event_id,
             'user' || upper(substr(event_type, 1, 1)) || substr(event_type, 2) || 'ID' ||
             CAST(user_id AS VARCHAR) || '__fooBar' || CAST(event_id % 10 AS VARCHAR) || 'Z' AS name
      FROM events)
""")
def q_snake_case(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", _camel_name().alias("name"))
    return e.select("event_id", "name", snake_case("name").alias("snake"))


@query("json_flatten", """
SELECT event_id AS "eventId", user_id AS "userId", event_type AS event_info_event_type,
       CAST(json_extract(props, '$.k') AS BIGINT) AS event_info_props_k
FROM events
""")
def q_json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    doc = F.to_json(F.struct(
        F.col("event_id").alias("eventId"), F.col("user_id").alias("userId"),
        F.struct(F.col("event_type").alias("eventType"),
                 F.from_json("props", "k bigint").alias("props"),
                 F.struct().alias("empty")).alias("eventInfo")))
    # schema inferred over every row (no sampling); nested names snake_cased
    return json_flatten(e.select(doc.alias("js")), "js", col_normalize=snake_case_name)


@query("json_flatten_mixed", """
SELECT CASE WHEN event_id % 10 IN (0, 1) THEN NULL ELSE event_id END AS id,
       CASE WHEN event_id % 10 IN (0, 1) THEN NULL ELSE event_type END AS info_kind,
       CASE WHEN event_id % 10 IN (0, 1) THEN NULL ELSE user_id END AS info_kind_upper
FROM events
""")
def q_json_flatten_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Records that are no object give NULLs; keys that differ only in case stay apart."""
    e = table(spark, sf, "events")
    doc = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"info":{"kind":"'), F.col("event_type"),
                   F.lit('","Kind":'), F.col("user_id").cast("string"), F.lit("}}"))
    js = F.when(F.col("event_id") % 10 == 0, "5").when(F.col("event_id") % 10 == 1, "[1]").otherwise(doc)
    return json_flatten(e.select(js.alias("js")), "js",
                        col_normalize=lambda n: n.lower() + "_upper" if n[:1].isupper() else n)


@query("json_flatten_map", """
SELECT event_id, 'userId' AS name, CAST(user_id AS VARCHAR) AS value FROM events WHERE event_id % 10 > 1
UNION ALL SELECT event_id, 'event_info_event_type', event_type FROM events WHERE event_id % 10 > 1
UNION ALL SELECT event_id, 'event_info_tags', '[1,{"a":"b"}]' FROM events WHERE event_id % 10 > 1
UNION ALL SELECT event_id, 'event_info_none', NULL FROM events WHERE event_id % 10 > 1
UNION ALL SELECT event_id, 'event_info_props_k', CASE WHEN event_id % 2 = 0 THEN 'later {"k":1}' ELSE json_extract_string(props, '$.k') END
FROM events WHERE event_id % 10 > 1
UNION ALL SELECT event_id, 'own_' || (event_id % 97), 'x' FROM events WHERE event_id % 10 > 1
UNION ALL SELECT event_id, NULL, NULL FROM events WHERE event_id % 10 <= 1
""")
def q_json_flatten_map(spark: SparkSession, sf: str) -> DataFrame:
    """F10 without a schema: keys of their own in each row, clashing names (the later one in the text wins)."""
    e = table(spark, sf, "events")
    clash = F.lit('"event_info_props_k":"later {\\"k\\":1}"')
    nested = F.concat(F.lit('"eventInfo":{"eventType":"'), F.col("event_type"), F.lit('","props":'), F.col("props"),
                      F.lit(',"empty":{},"tags":[1,{"a":"b"}],"none":null}'))
    even = F.col("event_id") % 2 == 0
    doc = F.concat(F.lit('{"userId":'), F.col("user_id").cast("string"), F.lit(","), F.when(even, nested).otherwise(clash), F.lit(","),
                   F.when(even, clash).otherwise(nested), F.lit(',"own_'), (F.col("event_id") % 97).cast("string"), F.lit('":"x"}'))
    js = F.when(F.col("event_id") % 10 == 0, "5").when(F.col("event_id") % 10 == 1, "[1]").otherwise(doc)
    flat = json_flatten_map(e.select("event_id", js.alias("js")), "js", snake_case, keep=["event_id"])
    return flat.select("event_id", F.explode_outer("flat").alias("name", "value"))


@query("map_subset", """
SELECT event_id,
       '{"k":"' || json_extract_string(props, '$.k') || '","user":"' || CAST(user_id AS VARCHAR) || '"}'
         AS subset_json
FROM events
""")
def q_map_subset(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    m = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("type"), F.col("event_type"),
                     F.lit("user"), F.col("user_id").cast("string"))
    return e.select("event_id", F.to_json(map_subset(m, ["user", "k", "missing"])).alias("subset_json"))
