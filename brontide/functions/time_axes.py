"""Time on two axes: wall clock of the forecasts (without zone) and UTC of collection."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hours at which a forecast is issued, and minutes until it can be had.
ISSUE_HOURS = (2, 5, 8, 11, 14, 17, 20, 23)
ISSUE_DELAY_MINUTES = 20
NTZ = "timestamp_ntz"
#: The two spellings of an instant.
_FULL = r"^[0-9]{14}$"
_DASHED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?$"
#: Fixed value: minutes until an observation slot is published.
PUBLISH_DELAY_MINUTES = 10


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse(text: Column, pattern: str) -> Column:
    """A zoneless timestamp by pattern; null where the text is no such instant."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast(NTZ)


def wall_clock(text: Column | str) -> Column:
    """14 digits or yyyy-MM-dd HH:mm[:ss[.f]]; anything else, outer blanks too, is null. A
    fraction beyond microseconds is rounded to the nearest, halves up."""
    t = _col(text).cast("string")
    to_second = F.try_to_timestamp(F.regexp_replace(t, r"\.[0-9]+$", "")).cast(NTZ)
    digits = F.regexp_extract(t, r"\.([0-9]{1,6})", 1)
    micros = F.rpad(digits, 6, "0").try_cast("int") + F.when(t.rlike(r"\.[0-9]{6}[5-9]"), 1).otherwise(0)
    dashed = to_second + F.coalesce(F.make_dt_interval(secs=micros / F.lit(1_000_000).cast("decimal(18,6)")), F.expr("INTERVAL 0 SECONDS"))
    return F.when(t.rlike(_FULL), parse(t, "yyyyMMddHHmmss")).when(t.rlike(_DASHED), F.when(t.contains("."), dashed).otherwise(F.try_to_timestamp(t).cast(NTZ)))


def wall_clock_from_parts(day: Column | str, time: Column | str) -> Column:
    """yyyyMMdd with HHmm or HHmmss; anything else is null."""
    d, t = _col(day).cast("string"), _col(time).cast("string")
    full = F.concat(d, F.rpad(t, 6, "0"))
    good = d.rlike("^[0-9]{8}$") & t.rlike("^([0-9]{4}|[0-9]{6})$")
    return F.when(good, parse(full, "yyyyMMddHHmmss"))


def utc_to_local(instant: Column | str, hours: int = 9) -> Column:
    """A UTC reading without zone as local wall clock."""
    return _col(instant) + F.expr(f"INTERVAL {hours} HOURS")


def lead_hours(start: Column | str, end: Column | str) -> Column:
    """Complete hours from start to end."""
    return F.timestamp_diff("HOUR", _col(start), _col(end))


def row_id(key: Column | str, instant: Column | str) -> Column:
    """key|ISO instant with microseconds."""
    return F.concat(_col(key), F.lit("|"), F.date_format(_col(instant), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def as_of_hour(text: str) -> datetime:
    """A frozen hour, strictly YYYY-MM-DD HH:00:00. Models take it as a literal, never a clock."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2} \d{2}:00:00", text):
        raise ValueError(f"not a full hour: {text!r}")
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def hour_state(as_of: datetime, now: datetime) -> str:
    """current, stale or an error for a frozen hour in the future; both on one clock."""
    this = now.replace(minute=0, second=0, microsecond=0)
    if as_of > this:
        raise ValueError("the frozen hour lies in the future")
    return "current" if as_of == this else "stale"


def literal_hour(as_of: datetime) -> Column:
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast(NTZ)


def latest_issue(at: Column | str, delay: int = ISSUE_DELAY_MINUTES) -> Column:
    """The newest issue that can be had at a wall-clock instant."""
    ready = _col(at) - F.expr(f"INTERVAL {delay} MINUTES")
    day, hour = F.date_trunc("DAY", ready).cast(NTZ), F.hour(ready)
    # Issues come every three hours, from 02:00 on.
    since = F.pmod(hour - ISSUE_HOURS[0], F.lit(3))
    return day + F.make_dt_interval(hours=hour - since)


def slot_instant(day: Column | str, time: Column | str, offset: int = 9) -> Column:
    """A local observation slot as UTC reading."""
    return wall_clock_from_parts(day, time) - F.expr(f"INTERVAL {offset} HOURS")


def published_slot(at: Column | str, delay: int = PUBLISH_DELAY_MINUTES) -> Column:
    """The newest hourly observation slot that is published at an instant."""
    return F.date_trunc("HOUR", _col(at) - F.expr(f"INTERVAL {delay} MINUTES")).cast(NTZ)


def day_floor(as_of: datetime, days: int) -> datetime:
    return as_of.replace(hour=0) - timedelta(days=days)
