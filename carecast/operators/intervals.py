"""Interval join: rows of two tables with equal keys whose times lie at most so many minutes apart.

A plain join on the keys would form every pair of a key and drop most of them.
Here time is cut into bands as wide as the interval: a right row belongs to one
band, a left row looks into its own and the two beside it, so the join is an
equi-join on keys and band, which shuffles, broadcasts and splits like any other,
and each pair is met once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

BAND = "_banda"


def band(time: str, minutes: int) -> str:
    """Number of the band a time lies in (by its local date and clock, so summer time moves no band)."""
    return f"CAST(floor((datediff(CAST({time} AS DATE), DATE '1970-01-01') * 1440 + hour({time}) * 60 + minute({time})) / {int(minutes)}) AS BIGINT)"


def join_within(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, minutes: int) -> DataFrame:
    """Inner join on ``keys`` (columns of both) where ``right_time`` is between ``left_time`` - and + ``minutes``, both included.

    The columns of both sides, keys once; rows without a key or a time match nothing.
    """
    if minutes < 1:
        raise ValueError("an interval join needs at least one minute")
    wide = left.selectExpr("*", f"explode(sequence({band(left_time, minutes)} - 1, {band(left_time, minutes)} + 1)) AS {BAND}")
    narrow = right.selectExpr("*", f"{band(right_time, minutes)} AS {BAND}")
    span = f"INTERVAL '{int(minutes)}' MINUTE"
    near = f"{right_time} BETWEEN {left_time} - {span} AND {left_time} + {span}"
    return wide.join(narrow, [*keys, BAND], "inner").where(near).drop(BAND)
