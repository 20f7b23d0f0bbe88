"""Calendar columns of an event and the length of a time span."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Monday is day 0, business hours run from 9 up to and including 17.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEEKEND = [5, 6]
BUSINESS_HOURS = (9, 17)
_DAY = 86_400_000_000


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Of the time in UTC, whatever the session's zone. Null for an unknown time, except the
    two flags, which are then false."""
    micros = F.unix_micros(ts)
    in_day = F.pmod(micros, F.lit(_DAY))
    day = F.date_from_unix_date(((micros - in_day) / _DAY).cast("int"))
    hour, weekday = F.floor(in_day / 3_600_000_000).cast("int"), F.weekday(day)
    return {
        "event_date": F.timestamp_micros(micros - in_day),
        "year": F.year(day),
        "month": F.month(day),
        "month_label": F.date_format(day, "yyyy-MM"),
        "hour": hour,
        "weekday_num": weekday,
        "weekday": F.date_format(day, "EEEE"),
        "is_weekend": F.coalesce(weekday.isin(WEEKEND), F.lit(False)),
        "is_business_hour": F.coalesce(hour.between(*BUSINESS_HOURS), F.lit(False)),
    }


def weekday_position(name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), name)


def _span(start: Column, end: Column, micros: float) -> Column:
    # timestampdiff would drop the fraction.
    return F.coalesce((F.unix_micros(end) - F.unix_micros(start)) / F.lit(micros), F.lit(0.0))


def seconds_between(start: Column, end: Column) -> Column:
    return _span(start, end, 1e6)


def minutes_between(start: Column, end: Column) -> Column:
    return _span(start, end, 6e7)
