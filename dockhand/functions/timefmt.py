"""ISO timestamp text, wall clocks, instants, business dates (F1-F8).

Two readings of ``2024-01-01T23:30:00+07:00`` are kept apart:

* the *instant* (F1): the point on the UTC line; Spark ``timestamp``;
* the *wall clock* (F2-F6): 23:30 on 2024-01-01, as written, whatever the
  offset; Spark ``timestamp_ntz``.  Taking ``hour()`` of the instant would
  give the session zone's hour, which is the wrong answer here.

Everything is a Column expression; nothing leaves the JVM.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted ISO layouts.  Seconds are required; a fraction of
# 1-6 digits is optional; the offset is written as +07:00, +0700 or Z.
ISO_PATTERNS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XX",
)
_OFFSET = r"(Z|[+-]([01][0-9]):?[0-5][0-9])$"
_ISO_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?" + _OFFSET
# Output layouts used by the date helpers.
DATE_TEXT = "yyyy-MM-dd"
COMPACT_TS = "yyyyMMdd'T'HHmmss"
HOUR_LABEL = "yyyy-MM-dd'T'HH'-00-00'"
DAY_PATH = "yyyy/MM/dd"
HOUR_FILE = "HH'-00-00'"
# Business zone and its offset rule (UTC+7, no daylight saving).
BUSINESS_ZONE = "Asia/Ho_Chi_Minh"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_text(ts: Column) -> Column:
    """ISO text of a ``timestamp_ntz``, without passing through any zone."""
    return F.translate(ts.cast("string"), " ", "T")


def iso_instant(s: Column | str, strict: bool = False) -> Column:
    """ISO text with offset -> instant (``timestamp``).

    Lenient: NULL for text that matches no layout.  Strict: raise instead,
    as the reference does.
    """
    s = _c(s)
    parsed = F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in ISO_PATTERNS])
    if not strict:
        return parsed
    return F.when(s.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("unparseable ISO timestamp: "), s)).cast("timestamp"))


def instant_micros(s: Column | str, strict: bool = False) -> Column:
    """Epoch microseconds of the instant: independent of the session zone."""
    return F.unix_micros(iso_instant(s, strict))


def utc_wall_clock(s: Column | str, strict: bool = False) -> Column:
    """The instant written as a UTC wall clock (``timestamp_ntz``)."""
    return F.timestamp_add("MICROSECOND", instant_micros(s, strict),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def iso_wall_clock(s: Column | str, strict: bool = False) -> Column:
    """F2 core: the wall clock as written in the text (offset dropped)."""
    s = _c(s)
    # one layout check, then one cast of the part without the offset
    wall = F.when(s.rlike(_ISO_TEXT), F.regexp_replace(s, _OFFSET, "").try_cast("timestamp_ntz"))
    if not strict:
        return wall
    return F.when(s.isNull() | wall.isNotNull(), wall).otherwise(
        F.raise_error(F.concat(F.lit("unparseable ISO timestamp: "), s)).cast("timestamp_ntz"))


def wall_clock_parts(wall: Column | str) -> list[Column]:
    """year, month, day, hour of a wall clock (from ``iso_wall_clock``).

    Takes the parsed wall clock rather than the text, so a query parses each
    text once (in its own projection) and derives the four parts from it.
    """
    w = _c(wall)
    return [F.year(w).alias("year"), F.month(w).alias("month"),
            F.dayofmonth(w).alias("day"), F.hour(w).alias("hour")]


def with_wall_clock(df: DataFrame, s: str, name: str = "wall_clock", strict: bool = False) -> DataFrame:
    """Add the parsed wall clock of text column ``s`` as ``name`` (parsed once)."""
    return df.withColumn(name, iso_wall_clock(s, strict))


def iso_date(s: Column | str, strict: bool = False) -> Column:
    """``yyyy-MM-dd`` of the wall clock."""
    return F.date_format(iso_wall_clock(s, strict), DATE_TEXT)


def hour_label(s: Column | str, strict: bool = False) -> Column:
    """``yyyy-MM-ddTHH-00-00`` of the wall clock."""
    return F.date_format(iso_wall_clock(s, strict), HOUR_LABEL)


def compact_ts(ts: Column | str, fmt: str = COMPACT_TS) -> Column:
    """reformat a timestamp; default ``yyyyMMddTHHmmss``."""
    return F.date_format(_c(ts), fmt)


def hour_path(s: Column | str, strict: bool = False) -> tuple[Column, Column]:
    """(``yyyy/MM/dd``, ``HH-00-00``) of the wall clock."""
    w = iso_wall_clock(s, strict)
    return F.date_format(w, DAY_PATH), F.date_format(w, HOUR_FILE)


def hour_path_text(s: str) -> tuple[str, str]:
    """F6 for one text on the driver."""
    if not re.match(_ISO_TEXT, s):
        raise ValueError(f"unparseable ISO timestamp: {s!r}")
    wall = dt.datetime.fromisoformat(s[:19])
    return f"{wall:%Y/%m/%d}", f"{wall:%H}-00-00"


def business_date(ts_utc: Column | str, zone: str = BUSINESS_ZONE) -> Column:
    """calendar date in the business zone of a UTC wall-clock timestamp.

    Works on ``timestamp_ntz`` read as UTC, so the session zone plays no part.
    """
    ts = _c(ts_utc).cast("timestamp_ntz")
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), ts))


def run_date_resolution(conf_run_date: Column | str, own_run_date: Column | str,
                        schedule_ts_utc: Column | str, zone: str = BUSINESS_ZONE) -> Column:
    """F8: run config beats own value beats business date of the schedule.

    The text ``'None'`` counts as missing, as a templated empty value does.
    """
    conf_v = F.nullif(_c(conf_run_date), F.lit("None"))
    own_v = F.nullif(_c(own_run_date), F.lit("None"))
    return F.coalesce(conf_v, own_v, F.date_format(business_date(schedule_ts_utc, zone), DATE_TEXT))


def resolve_run_date(conf_run_date: str | None, own_run_date: str | None, execution_ts_utc,
                     zone: str = BUSINESS_ZONE) -> str:
    """F8 for one run on the driver: run config, else own value, else the
    business date of the scheduled time (``'None'`` counts as missing)."""
    from zoneinfo import ZoneInfo

    for v in (conf_run_date, own_run_date):
        if v is not None and v != "None":
            return v
    ts = execution_ts_utc
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=dt.timezone.utc)
    return ts.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%d")
