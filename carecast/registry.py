"""Registered queries: one per operator / job, each reading the driver tables.

``queries()[name](spark, sf_dir)`` returns a DataFrame (lazy, except that
the jobs reading the visit table several times write it once first). Double columns
are rounded to ``DOUBLE_SCALE`` decimals at the output (the oracle does
the same) so results compare exactly across engines.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import (
    claim_number, date_literal, half_hour, lit, month_name, null_safe_concat, synthetic_end_time,
    week_number, weekday_name, weekday_num, year_month, year_week,
)
from .operators.joins import ministry_keys
from .operators.measures import VISIT_KEYS, movement_measures
from .params import CHECK, Params
from .plans import covid, demand, shift, visits
from .session import materialize, shared_dir
from .sources import adapters, schemas
from .sources.adapters import DomainTables

DOUBLE_SCALE = 6

QueryFn = Callable[[DomainTables, Params], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        return fn
    return deco


def round_doubles(df: DataFrame, scale: int = DOUBLE_SCALE) -> DataFrame:
    if not any(isinstance(f.dataType, T.DoubleType) for f in df.schema.fields):
        return df
    return df.selectExpr(*[
        f"round({f.name}, {scale}) AS {f.name}" if isinstance(f.dataType, T.DoubleType) else f.name
        for f in df.schema.fields
    ])


def run(name: str, spark: SparkSession, sf_dir: str, params: Params = CHECK) -> DataFrame:
    return round_doubles(_REGISTRY[name](DomainTables.of(spark, sf_dir), params))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, _n=name: run(_n, spark, sf_dir)) for name in _REGISTRY}


def visit(t: DomainTables, p: Params) -> DataFrame:
    return visits.classify_visits(t.visit_raw, t.org_unit, p)


def visit_table(t: DomainTables, p: Params, columns: list[str], where: str = "true") -> DataFrame:
    """The visit table as the jobs that read it several times see it: written once.

    The source keeps the classified visits as a permanent table that the
    demand jobs scan; here the columns a job reads are written to the
    shared folder and read back, so each branch scans parquet with its own
    filters pushed down instead of re-running the classification. ``where``
    is what all branches ask for; it reaches the scan below the DISTINCT.
    """
    return materialize(visit(t, p).where(where).select(*columns), "visit")


def shift_visits(t: DomainTables, p: Params) -> DataFrame:
    """The visits the half-hour model reads, written once, a partition a day, so that window and calendar prune them."""
    return materialize(shift.needed_visits(visit(t, p), t.calendar, p).select(*shift.VISIT_COLUMNS), "visit", ["fecha_inicio"])


# ------------------------------------------------------------------ P1 + scalars
@query("visit_classification")
def _visit_classification(t, p):
    return visit(t, p)


@query("calendar_attributes")
def _calendar_attributes(t, p):
    d, ts = "fecha_inicio", "hora_inicio"
    return t.visit_raw.selectExpr(
        "episodio", "fecha_inicio",
        f"month({d}) AS mes", f"coalesce({month_name(d)}, {lit('Otros')}) AS nmes",
        f"year({d}) AS anno", f"dayofmonth({d}) AS dia", f"hour({ts}) AS hora",
        f"{half_hour(ts)} AS media_hora", f"{weekday_name(d)} AS dia_semana",
        f"{weekday_num(d)} AS dia_semana_num", f"{week_number(d)} AS numero_semana",
        f"{year_month(d)} AS anno_mes",
    )


@query("week_number")
def _week_number(t, p):
    d = "CAST(o_orderdate AS DATE)"
    return t.raw("orders").selectExpr(
        "o_orderkey", f"{d} AS fecha", f"{week_number(d)} AS numero_semana",
        f"{year_week(d)} AS anno_semana",
    )


@query("half_hour_bucket")
def _half_hour_bucket(t, p):
    return t.raw("events").selectExpr(
        "event_id", "ts", f"{half_hour('ts')} AS media_hora",
        "hour(ts) * 60 + minute(ts) AS minuto_dia",
    )


@query("null_safe_concat")
def _null_safe_concat(t, p):
    d = "fecha_inicio"
    return t.visit_raw.selectExpr(
        "episodio",
        f"{null_safe_concat(weekday_num(d), lit('-'), 'ind_anulacion')} AS dia_anulacion",
        f"{null_safe_concat(weekday_name(d), lit('-'), 'ind_anulacion')} AS nombre_anulacion",
    )


@query("estimated_end_time")
def _estimated_end_time(t, p):
    return visit(t, p).selectExpr(
        "episodio", "clasif", "tipo_siniestro_origen", "hora_inicio",
        f"{synthetic_end_time('hora_inicio', 'clasif', 'tipo_siniestro_origen')} AS hora_fin",
    )


@query("org_unit_filter")
def _org_unit_filter(t, p):
    units = visits.primary_care_units(t.org_unit)
    return (
        t.visit_raw.join(units, "uo_tratamiento", "inner")
        .groupBy("uo_tratamiento", "uo_medica", F.col("centro_m").alias("centro"))
        .agg(F.count(F.lit(1)).alias("n_visitas"))
    )


@query("tickets_as_written")
def _tickets_as_written(t, p):
    """Tickets counted by collation keys, which are then shown as the tickets write them."""
    written = adapters.written_queue_log(t.raw("events"))
    shown = ["centro", "estado", "cargo", "fila"]
    names = materialize(schemas.spellings(written, shown), "spellings")
    counts = schemas.fold_keys(written).groupBy(*shown).agg(F.count(F.lit(1)).alias("n_tickets"))
    return schemas.respelled(counts, names, {c: c for c in shown})


# ------------------------------------------------------------------ P2 / P3
@query("covid_flag_join")
def _covid_flag_join(t, p):
    v = visit(t, p).select("episodio", "siniestro")
    claims = t.covid_claim.selectExpr(
        "siniestro_covid19", f"{claim_number('siniestro_covid19')} AS covid_key"
    )
    j = v.join(claims, v.siniestro == claims.covid_key, "left")
    return j.selectExpr("episodio", "siniestro", "siniestro_covid19",
                        "CAST(covid_key IS NOT NULL AS INT) AS covid")


@query("ministry_flag_join")
def _ministry_flag_join(t, p):
    v = visit(t, p).select("episodio", "siniestro")
    keys = materialize(ministry_keys(t.ministry_case), "ministry-keys")  # a plain scan: AQE may split a hot claim
    j = v.join(keys, v.siniestro == keys.minsal_key, "left")
    return j.selectExpr("episodio", "siniestro", "CAST(minsal_key IS NOT NULL AS INT) AS minsal")


@query("movement_measures")
def _movement_measures(t, p):
    v = visit(t, p).where(f"fecha_inicio > {date_literal(p.since)}")
    return movement_measures(v, VISIT_KEYS, "narrow")


@query("movement_measures_wide")
def _movement_measures_wide(t, p):
    return covid.covid_measures(visit(t, p), t.covid_claim, t.ministry_case, p)


@query("movement_detail")
def _movement_detail(t, p):
    return covid.movement_detail(visit(t, p), t.covid_claim, t.ministry_case, p)


@query("covid_daily")
def _covid_daily(t, p):
    return covid.covid_daily(visit(t, p), t.covid_claim, t.ministry_case, p)


# ------------------------------------------------------------------ P4
@query("party_bridge_join")
def _party_bridge_join(t, p):
    return demand.timed_visits(t.queue_log, t.party, visit(t, p), p)


@query("service_time_daily")
def _service_time_daily(t, p):
    return demand.service_time_daily(t.queue_log, t.party, visit(t, p), p)


@query("service_time_pivot")
def _service_time_pivot(t, p):
    return demand.service_time_pivot(demand.service_time_daily(t.queue_log, t.party, visit(t, p), p))


@query("demand_vs_capacity")
def _demand_vs_capacity(t, p):
    v = visit_table(t, p, demand.VISIT_COLUMNS, f"fecha_inicio > {date_literal(p.demand_start)}")
    return demand.demand_vs_capacity(t.queue_log, t.party, v, t.capacity, p)


# ------------------------------------------------------------------ P5
# Stages that read the visits once or not at all: they take them as they are, filters reach the scan.
SINGLE_READ = {"hours", "grid", "weekly", "weekly_p75", "first", "synthetic"}
# Stages in front of the synthetic branch, which need no list of the centres that have a queue.
NO_CENTRES = SINGLE_READ - {"synthetic"}


def _stages(t: DomainTables, p: Params, stage: str) -> dict[str, DataFrame]:
    v = visit(t, p) if stage in SINGLE_READ else shift_visits(t, p)
    return shift.shift_stages(v, t.queue_log, t.party, t.calendar, t.opening_hours_wide, p,
                              write_centres=stage not in NO_CENTRES)


def _stage_query(name: str, stage: str, **overrides):
    @query(name)
    def _q(t, p):
        pp = p.with_(**overrides) if overrides else p
        return _stages(t, pp, stage)[stage]
    return _q


_stage_query("opening_hours_unpivot", "hours")
_stage_query("calendar_slot_grid", "grid")
_stage_query("weekly_load", "weekly")
_stage_query("weekly_p75", "weekly_p75")
_stage_query("queue_first_attention", "first")
_stage_query("first_attention_within", "first", within_minutes=300)
_stage_query("synthetic_attention", "synthetic")
_stage_query("union_positional", "union")
_stage_query("union_by_name", "union", fix_union_order=True)
_stage_query("slot_demand", "slots")
_stage_query("slot_gap_fill", "filled")
_stage_query("slot_p75", "slot_p75")
_stage_query("slot_stddev", "stddev")
_stage_query("demand_curve", "curve")
_stage_query("hourly_demand", "hourly")
_stage_query("shift_demand", "result")


@query("centres_without_queue")
def _centres_without_queue(t, p):
    v = visit(t, p)
    centres = materialize(t.queue_log.selectExpr("centro AS q_centro").distinct(), "queue-centres")
    return (v.join(centres, v.centro == centres.q_centro, "left_anti")
            .groupBy("centro").agg(F.count(F.lit(1)).alias("n_visitas")))


@query("shift_tool_append")
def _shift_tool_append(t, p):
    result = _stages(t, p, "result")["result"]
    path = os.path.join(shared_dir(t.spark), f"shift_tool-{uuid.uuid4().hex[:12]}")
    shift.append_shift_tool(result, path)
    return t.spark.read.parquet(path)
