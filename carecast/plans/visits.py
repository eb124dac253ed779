"""P1 — visit classification.

visit_raw joined to its treating unit (primary-care units only), cancelled
and future visits dropped, calendar attributes, claim type and visit class
added, exact duplicates removed.

Plan: the unit filter runs on the small ``org_unit`` side, which the
planner broadcasts from its size statistics; the visit filters are plain
column predicates that reach the scan. The only shuffle is the final DISTINCT,
which aggregates map-side first, so repeated rows collapse before the
exchange.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from .. import rules
from ..functions import (
    ci_contains, ci_in, classify_movement, date_literal, decode_claim_type, half_hour, lit,
    month_name, null_safe_concat, week_number, weekday_name, weekday_num, year_month,
)
from ..params import Params, now_unless_given
from ..sources import schemas


def primary_care_units(org_unit: DataFrame) -> DataFrame:
    """Units whose medical unit contains 'MAPRI' and is not an excluded code."""
    return org_unit.where(
        f"{ci_contains('uo_medica', rules.PRIMARY_CARE_UNIT_PATTERN)} "
        f"AND NOT {ci_in('uo_medica', rules.EXCLUDED_MEDICAL_UNITS)}"
    )


@now_unless_given
def live_visits(visit_raw: DataFrame, params: Params | None = None) -> DataFrame:
    """Drop cancelled rows (NULL flags too, as ``<>`` does), future dates, old years."""
    return visit_raw.where(
        f"NOT {ci_in('ind_anulacion', rules.CANCELLED_FLAGS)}"  # NULL -> unknown -> dropped
        f" AND fecha_inicio <= {date_literal(params.last_date)}"
        # year(d) >= min_year, written as a range so it prunes
        f" AND fecha_inicio >= {date_literal(dt.date(params.min_year, 1, 1))}"
    )


def visit_attributes(d: str = "fecha_inicio", t: str = "hora_inicio") -> list[str]:
    return [
        f"month({d}) AS mes",
        f"coalesce({month_name(d)}, {lit(rules.OTHER)}) AS nmes",
        f"year({d}) AS anno",
        f"dayofmonth({d}) AS dia",
        f"hour({t}) AS hora",
        f"{half_hour(t)} AS media_hora",
        f"{weekday_name(d)} AS dia_semana",
        f"{week_number(d)} AS numero_semana",
        f"{decode_claim_type('tipo_siniestro_orig')} AS tipo_siniestro_origen",
        f"{classify_movement('cl_mov_desc')} AS clasif",
        f"{null_safe_concat(weekday_num(d), lit('-'), weekday_name(d))} AS dia_semana_esp",
        f"coalesce({weekday_num(d)}, 99) AS dia_semana_num",
        f"{year_month(d)} AS anno_mes",
    ]


@now_unless_given
def classify_visits(visit_raw: DataFrame, org_unit: DataFrame, params: Params | None = None) -> DataFrame:
    """The source's ``SELECT DISTINCT ca.*, <attributes>, <unit columns>``.

    Every attribute is a function of the visit and unit columns, so the
    DISTINCT runs on those 14 columns and the attributes are computed
    after it: the shuffle carries half the columns and the CASE chains run
    once per distinct row, on the reduce side.
    """
    units = primary_care_units(schemas.fold_keys(org_unit)).selectExpr(
        "uo_tratamiento", "territorio_m AS territorio", "agencia_m AS agencia", "centro_m AS centro",
        "uo_medica",
    )
    v = live_visits(schemas.fold_keys(visit_raw), params)
    joined = v.join(units, "uo_tratamiento", "inner")  # filtered LEFT JOIN == INNER
    distinct = joined.select(*schemas.VISIT_RAW.fieldNames(), "territorio", "agencia", "centro",
                             "uo_medica").distinct()
    return distinct.selectExpr(*schemas.VISIT.fieldNames()[:9], *visit_attributes(),
                               "territorio", "agencia", "centro", "uo_medica")
