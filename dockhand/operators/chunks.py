"""Time-chunked tables: segments, retirement, truncation.

A chunked table is a DataFrame whose rows fall in fixed time chunks (day,
hour, ...).  Its *segments* table has one row per chunk with a ``used``
flag; retiring flips the flag (soft, like mark-unused), reads keep only
used chunks.  Segments grow with the number of chunks, not with rows, and
are still handled as a DataFrame.
"""

from __future__ import annotations

import datetime as dt
from typing import Any, Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.functions.timefmt import ntz_text

# Chunk granularities.
GRANULARITIES = ("hour", "day", "week")
# Widest expansion of an interval list: about this many (bucket, piece) rows.
BUCKETS = 100_000


def chunk_start(ts: Column | str, granularity: str = "day") -> Column:
    """Start of the chunk holding ``ts`` (``timestamp_ntz``, UTC wall clock).

    ``date_trunc`` would pass through the session's zone (and move hours that a
    daylight-saving change skips); dates and intervals of a ``timestamp_ntz`` do not.
    """
    if granularity not in GRANULARITIES:
        raise ValueError(f"unsupported granularity {granularity!r}; use one of {GRANULARITIES}")
    c = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")
    day = c.cast("date")
    if granularity == "week":
        day = F.trunc(day, "week")
    start = day.cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.hour(c)) if granularity == "hour" else start


def chunk_end(start: Column, granularity: str = "day") -> Column:
    unit = {"hour": "HOUR", "day": "DAY", "week": "WEEK"}[granularity]
    return F.timestamp_add(unit, F.lit(1), start)


def segment_id(datasource: str, start: Column, end: Column) -> Column:
    bound = lambda t: F.concat(ntz_text(t), F.lit(".000Z"))
    return F.concat_ws("_", F.lit(datasource), bound(start), bound(end))


def with_chunk(df: DataFrame, ts_col: str, granularity: str = "day", name: str = "chunk_start") -> DataFrame:
    return df.withColumn(name, chunk_start(ts_col, granularity))


def list_segments(df: DataFrame, ts_col: str, granularity: str = "day",
                  datasource: str = "datasource") -> DataFrame:
    """One row per chunk: id, bounds, rows, first and last time, used."""
    g = df.groupBy(chunk_start(ts_col, granularity).alias("chunk_start")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.col(ts_col).cast("timestamp_ntz")).alias("min_ts"),
        F.max(F.col(ts_col).cast("timestamp_ntz")).alias("max_ts"))
    end = chunk_end(F.col("chunk_start"), granularity)
    return g.select(segment_id(datasource, F.col("chunk_start"), end).alias("segment_id"),
                    "chunk_start", end.alias("chunk_end"), "n_rows", "min_ts", "max_ts",
                    F.lit(True).alias("used"))


def _ts(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None) if v.tzinfo is None else v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    s = str(v).strip().replace("Z", "+00:00")
    parsed = dt.datetime.fromisoformat(s)
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return parsed


def normalize_intervals(intervals) -> list[tuple[dt.datetime, dt.datetime]]:
    """Accept (since, until) or a list of them; empty intervals are dropped.

    Intervals are not merged: each one retires the chunks it holds wholly,
    as separate mark-unused calls do.
    """
    if isinstance(intervals, tuple) and len(intervals) == 2 and not isinstance(intervals[0], (tuple, list)):
        intervals = [intervals]
    if not isinstance(intervals, (list, tuple)):
        raise TypeError("intervals must be (since, until) or a list of such pairs")
    out = []
    for since, until in intervals:
        a, b = _ts(since), _ts(until)
        if a < b:
            out.append((a, b))
    return out


def ntz_literal(v: dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal from a naive UTC datetime.

    Built from ISO text: casting text to ``timestamp_ntz`` involves no zone,
    whereas a Python datetime literal would pass through the driver's and the
    session's zones.
    """
    return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")


def _bucket(ts: Column, width_days: int) -> Column:
    since_epoch = ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(F.extract(F.lit("DAY"), since_epoch) / F.lit(width_days))


def _latest_until(intervals: Sequence[tuple[dt.datetime, dt.datetime]]) -> list[tuple]:
    """(lo, hi, until) pieces, disjoint: for a chunk that starts in [lo, hi), the
    latest ``until`` of the intervals that began by then.  The chunk lies wholly
    inside one of the intervals exactly if it ends by that."""
    pieces, latest = [], dt.datetime.min
    ordered = sorted(intervals)
    for k, (since, until) in enumerate(ordered):
        latest = max(latest, until)
        following = ordered[k + 1][0] if k + 1 < len(ordered) else latest
        hi = min(following, latest)
        if since < hi:
            pieces.append((since, hi, latest))
    return pieces


def retire_by_interval(segments: DataFrame, intervals) -> DataFrame:
    """Mark unused every chunk lying wholly inside one of the intervals.

    Only the segment's own bounds count, whatever its length.  Intervals become
    disjoint pieces of the time line, met with the chunk starts by an equi-join
    on a time bucket (whose width grows with the span of the intervals, so
    that the expansion stays bounded); each chunk meets one piece at most.
    """
    pieces = _latest_until(normalize_intervals(intervals))
    if not pieces:
        return segments
    span = sum((hi - lo for lo, hi, _ in pieces), dt.timedelta()).days
    width = 1 + span // BUCKETS
    listed = segments.sparkSession.createDataFrame(pieces, "__lo timestamp_ntz, __hi timestamp_ntz, __until timestamp_ntz")
    listed = listed.withColumn("__bucket", F.explode(F.sequence(_bucket(F.col("__lo"), width), _bucket(F.col("__hi"), width))))
    started = ((_bucket(F.col("chunk_start"), width) == F.col("__bucket"))
               & (F.col("chunk_start") >= F.col("__lo")) & (F.col("chunk_start") < F.col("__hi")))
    inside = F.coalesce(F.col("chunk_end") <= F.col("__until"), F.lit(False))
    return (segments.join(listed, started, "left")
            .withColumn("used", F.col("used") & ~inside).select(*segments.columns))


def retire_by_ids(segments: DataFrame, ids: Iterable[str]) -> DataFrame:
    """Mark unused the listed segment ids (a segment without an id stays as it is)."""
    listed = (segments.sparkSession.createDataFrame([(i,) for i in ids], "segment_id string")
              .where("segment_id is not null").distinct().withColumn("__hit", F.lit(True)))
    return (segments.join(listed, "segment_id", "left")
            .withColumn("used", F.col("used") & F.col("__hit").isNull()).drop("__hit").select(*segments.columns))


def retire(segments: DataFrame, *, since=None, until=None,
           interval_generator: Callable[..., Any] | None = None,
           interval_generator_kwargs: Mapping[str, Any] | None = None,
           segment_ids: Iterable[str] | None = None,
           segment_ids_generator: Callable[..., Iterable[str]] | None = None,
           segment_ids_generator_kwargs: Mapping[str, Any] | None = None) -> DataFrame:
    """W15/W16 entry point: retire by the first selector given, in the order
    interval generator, bounds, ids, id generator; without any it raises."""
    selectors = (
        (interval_generator, lambda: retire_by_interval(segments, interval_generator(**(interval_generator_kwargs or {})))),
        (None if since is None or until is None else (since, until), lambda: retire_by_interval(segments, (since, until))),
        (segment_ids, lambda: retire_by_ids(segments, segment_ids)),
        (segment_ids_generator, lambda: retire_by_ids(segments, segment_ids_generator(**(segment_ids_generator_kwargs or {})))),
    )
    chosen = next((run for selector, run in selectors if selector is not None), None)
    if chosen is None:
        raise ValueError("give since and until, an interval generator, segment ids or an id generator")
    return chosen()


def read_used(df: DataFrame, segments: DataFrame, ts_col: str | None = None, granularity: str = "day",
              chunk_col: str | None = None) -> DataFrame:
    """Rows of used chunks only (a semi join on the chunk start).

    Give ``chunk_col``, the partition column that holds the chunk (a date, a
    timestamp or the text that ``bulk_load_chunks`` writes): the join is then on
    the partition column itself, so Spark prunes retired chunks' folders before the
    scan (dynamic partition pruning).  With ``ts_col`` alone the chunk is computed from each row.
    """
    used = segments.where(F.col("used")).select("chunk_start")
    if chunk_col is None:
        if ts_col is None:
            raise ValueError("give chunk_col or ts_col")
        return df.join(used, chunk_start(ts_col, granularity) == used["chunk_start"], "left_semi")
    # Spark prunes only for a side that it takes to be selective; a bare flag is not, a comparison
    # is: this one holds for every start (the type begins with the year 1)
    used = used.where(F.col("chunk_start") >= ntz_literal(dt.datetime(1, 1, 1)))
    kind = df.schema[chunk_col].dataType
    bound = ntz_text(F.col("chunk_start")) if isinstance(kind, T.StringType) else F.col("chunk_start").cast(kind)
    keys = used.select(bound.alias("__used_chunk")).distinct()
    return df.join(keys, F.col(chunk_col) == F.col("__used_chunk"), "left_semi")


def truncate(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.sparkSession.createDataFrame([], df.schema)
