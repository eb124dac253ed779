"""Reshaping: unpivot of the wide opening-hours table, attention-branch union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOURS_KEYS = ("diasem", "mediahora")


def unpivot_hours(wide: DataFrame, keys: Sequence[str] = HOURS_KEYS) -> DataFrame:
    """Wide hours (one column per centre) -> (centro, diasem, mediahora, horario).

    The centre list comes from the schema, so adding a centre is adding a
    column. Empty cells (NULL) are dropped, closed slots (0) are kept.
    """
    centres = [c for c in wide.columns if c not in keys]
    long = wide.unpivot(list(keys), centres, "centro", "horario")
    return long.where(F.col("horario").isNotNull()).select(
        "centro", *[F.col(k) for k in keys], "horario"
    )


def union_branches(first: DataFrame, second: DataFrame, by_name: bool = False) -> DataFrame:
    """UNION ALL of two attention branches.

    Positional by default, like the source: columns of ``second`` land
    under the names of ``first`` in order, whatever their own names.
    ``by_name`` matches columns by name instead.
    """
    return first.unionByName(second) if by_name else first.union(second)
