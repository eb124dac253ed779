"""Calendar and time-of-day expressions (weeks start on Monday).

* weekday numbers run Monday = 1 .. Sunday = 7;
* week numbers are calendar weeks: week 1 holds 1 January, a new week
  starts every Monday (not ISO weeks: 2021-01-01 is week 1, 2019-12-30
  is week 53);
* day and month names are Spanish literals from ``rules`` (never locale
  formatting, whose capitalisation differs);
* half-hour slots are "HH:mm:ss" strings, the canonical slot key.

Arguments and results are Spark SQL expression text.
"""

from __future__ import annotations

import datetime as dt

from .. import rules
from .text import lit, null_safe_concat


def _names(values: list[str]) -> str:
    return "array(" + ", ".join(lit(v) for v in values) + ")"


def weekday_num(d: str) -> str:
    return f"(weekday({d}) + 1)"


def weekday_name(d: str) -> str:
    return f"element_at({_names(rules.WEEKDAY_ES)}, weekday({d}) + 1)"


def weekday_label(d: str) -> str:
    """Weekday name with the fallback label for a missing date."""
    return f"coalesce({weekday_name(d)}, {lit(rules.WEEKDAY_FALLBACK)})"


def month_name(d: str) -> str:
    return f"element_at({_names(rules.MONTH_ES)}, month({d}))"


def week_number(d: str) -> str:
    # weekday(1 January) is Monday = 0; day-of-year counts from 1.
    return f"CAST(((dayofyear({d}) - 1 + weekday(trunc({d}, 'year'))) div 7) + 1 AS INT)"


def year_week(d: str) -> str:
    """'YYYY-W' without zero padding, e.g. '2024-3'."""
    return null_safe_concat(f"year({d})", lit("-"), week_number(d))


def year_month(d: str) -> str:
    """'YYYY-M' without zero padding, e.g. '2024-1'."""
    return null_safe_concat(f"year({d})", lit("-"), f"month({d})")


def half_hour(ts: str) -> str:
    """Floor a time of day to its half hour, as 'HH:mm:ss' (seconds ignored)."""
    return (f"concat(lpad(CAST(hour({ts}) AS STRING), 2, '0'), "
            f"CASE WHEN minute({ts}) >= 30 THEN ':30:00' ELSE ':00:00' END)")


def slot_label(slot_index: str) -> str:
    """Slot 0..47 of the day -> 'HH:mm:ss'."""
    return (f"concat(lpad(CAST({slot_index} div 2 AS STRING), 2, '0'), "
            f"CASE WHEN {slot_index} % 2 = 1 THEN ':30:00' ELSE ':00:00' END)")


def add_minutes(ts: str, minutes: float) -> str:
    """``ts + minutes``; a fractional count truncates toward zero (36.6 -> 36)."""
    return f"({ts} + make_dt_interval(0, 0, {int(minutes)}))"


def ts_literal(value: dt.datetime) -> str:
    """A TIMESTAMP_NTZ literal (no session time zone involved)."""
    return f"TIMESTAMP_NTZ '{value.strftime('%Y-%m-%d %H:%M:%S')}'"


def date_literal(value: dt.date) -> str:
    return f"DATE '{value.isoformat()}'"
