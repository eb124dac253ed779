"""P2 movement detail and P3 daily covid / ministry totals.

Source shape: visit LEFT JOIN covid claims LEFT JOIN distinct ministry
cases, count per 9 keys, spread counts into 7 measures, sum per 7 keys,
(P3) four exclusive totals, sum again per 5 keys.

Spark shape: both claim lists are reduced to one table by claim number
(written first), joined to the visits once, then ONE aggregation with conditional sums. Every group-by is a partial
+ final hash aggregate, so a hot centre/day is combined map-side before
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import date_literal, flag_label
from ..operators.joins import with_claim_flags, written_claim_keys
from ..operators.measures import VISIT_KEYS, measure_sums, total_indicator
from ..params import Params, now_unless_given

EXCLUSIVE_TOTALS = [  # output name, covid flag, ministry flag
    ("minsal", 1, 1),
    ("minsal_no_covid", 0, 1),
    ("atenciones_covid", 1, 0),
    ("atenciones", 0, 0),
]


@now_unless_given
def flagged_visits(visit: DataFrame, covid_claim: DataFrame, ministry_case: DataFrame,
                   params: Params | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Visits after ``since`` with their flags and weight; ``keys``: the claim table of this run, if already written."""
    v = visit.where(f"fecha_inicio > {date_literal(params.since)}")
    return with_claim_flags(v, written_claim_keys(covid_claim, ministry_case, params.dedupe_claims) if keys is None else keys)


@now_unless_given
def movement_detail(visit: DataFrame, covid_claim: DataFrame, ministry_case: DataFrame,
                    params: Params | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Seven movement measures (narrow rules) per centre-day and covid x ministry label."""
    f = flagged_visits(visit, covid_claim, ministry_case, params, keys)
    agg = f.groupBy(*VISIT_KEYS, "covid_flag", "minsal_flag").agg(*measure_sums("narrow", "w"))
    return agg.selectExpr(
        *VISIT_KEYS, f"{flag_label('covid_flag', 'minsal_flag')} AS tipo", *rules.MEASURE_ORDER
    )


def _exclusive_totals(tot: str) -> list:
    return [
        F.expr(f"CAST(sum(CASE WHEN covid_flag = {cv} AND minsal_flag = {mn} THEN {tot} ELSE 0 END)"
               f" AS BIGINT)").alias(name)
        for name, cv, mn in EXCLUSIVE_TOTALS
    ]


@now_unless_given
def covid_measures(visit: DataFrame, covid_claim: DataFrame, ministry_case: DataFrame,
                   params: Params | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Per centre-day and flag pair: four exclusive totals, their sum, 7 measures (wide rules).

    Only the total matching the row's flag pair can be non-zero.
    """
    f = flagged_visits(visit, covid_claim, ministry_case, params, keys)
    tot = f"({total_indicator('wide')} * w)"
    agg = f.groupBy(*VISIT_KEYS, "covid_flag", "minsal_flag").agg(
        *_exclusive_totals(tot),
        F.expr(f"CAST(sum({tot}) AS BIGINT)").alias("atenciones_totales"),
        *measure_sums("wide", "w"),
    )
    return agg.drop("covid_flag", "minsal_flag")


@now_unless_given
def covid_daily(visit: DataFrame, covid_claim: DataFrame, ministry_case: DataFrame,
                params: Params | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Four mutually exclusive visit totals per centre and day."""
    f = flagged_visits(visit, covid_claim, ministry_case, params, keys)
    tot = f"({total_indicator('wide')} * w)"
    return f.groupBy(*VISIT_KEYS).agg(*_exclusive_totals(tot)).select(
        *VISIT_KEYS, "minsal", "minsal_no_covid", "atenciones", "atenciones_covid"
    )
