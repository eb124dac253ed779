"""Calendar expressions against plain-Python definitions on random dates and times."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from carecast import rules
from carecast.functions import col, half_hour, week_number, weekday_name, weekday_num

DATES = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2040, 12, 31))
TIMES = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 12, 31))


def py_week(d: dt.date) -> int:
    """Week 1 holds 1 January; weeks start on Monday."""
    jan1 = dt.date(d.year, 1, 1)
    first_monday_offset = jan1.weekday()  # Monday = 0
    return (d.timetuple().tm_yday - 1 + first_monday_offset) // 7 + 1


def py_slot(t: dt.datetime) -> str:
    return f"{t.hour:02d}:{'30' if t.minute >= 30 else '00'}:00"


@settings(max_examples=1, deadline=None)
@given(st.lists(DATES, min_size=200, max_size=200), st.lists(TIMES, min_size=200, max_size=200))
def test_calendar_matches_python(spark, days, times):
    df = spark.createDataFrame(list(zip(days, times)), "d date, t timestamp_ntz")
    out = df.select(
        "d", "t", col(week_number("d")).alias("w"), col(weekday_num("d")).alias("n"),
        col(weekday_name("d")).alias("name"), col(half_hour("t")).alias("slot"),
    ).collect()
    for r in out:
        assert r.w == py_week(r.d), r
        assert r.n == r.d.isoweekday(), r
        assert r.name == rules.WEEKDAY_ES[r.d.weekday()], r
        assert r.slot == py_slot(r.t), r
