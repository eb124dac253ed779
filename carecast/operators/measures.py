"""Movement measures: counts of visits per class family, per group.

The source counts visits per (group, class, claim type), spreads the
count into seven measure columns with CASE, then sums per group. The
count/CASE/sum nesting collapses into a single aggregation with
conditional sums, which Spark runs as one partial (map-side) plus one
final hash aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.claims import measure_flags

VISIT_KEYS = ["territorio", "agencia", "centro", "fecha_inicio", "numero_semana"]
TOTAL_MEASURES = ["ingreso", "ingreso_ep", "preingreso_ep", "control_agendado",
                  "control_espnt", "administrativo"]


def measure_sums(rule_set: str = "narrow", weight: str | None = None) -> list[Column]:
    """``sum`` of each movement indicator (times the ``weight`` column), one per measure."""
    flags = measure_flags("clasif", "tipo_siniestro_origen", rule_set)
    w = f" * {weight}" if weight else ""
    return [F.expr(f"CAST(sum(({flag}){w}) AS BIGINT)").alias(name) for name, flag in flags.items()]


def movement_measures(visit: DataFrame, keys: Sequence[str] = VISIT_KEYS,
                      rule_set: str = "narrow", weight: str | None = None) -> DataFrame:
    return visit.groupBy(*keys).agg(*measure_sums(rule_set, weight))


def total_indicator(rule_set: str = "wide") -> str:
    """1 when the visit falls in one of the six counted measures (not 'otros')."""
    flags = measure_flags("clasif", "tipo_siniestro_origen", rule_set)
    return "(" + " + ".join(f"({flags[m]})" for m in TOTAL_MEASURES) + ")"
