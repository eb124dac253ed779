"""P4 — measured demand vs staffed capacity.

1. queue tickets in a box state, of timed descriptions, outside excluded
   centres, bridged to visits of the same patient and day
   (queue -> party by rut -> visit by partner and date);
2. longest measured minutes per patient, attention type, movement and
   claim type; average per centre, service-time type and day;
3. one column per service-time type, defaults where a type is missing;
4. visit counts per centre-day (narrow measures) x minutes per type
   -> demand minutes, / (9 h * 60) -> FTE, beside the approved FTE.

Plan notes. The bridge is many-to-many (several tickets and several
visits per patient-day). The service times never form ticket x visit
pairs: tickets are reduced to one row per (centre, patient, attention
type, day) with their longest minutes, the patient-day's visits to a
count of distinct movement combinations per service-time type (at most 7
rows), and the two meet once; the average weights each ticket group by
that count, as the source's average over pairs does. ``timed_visits``
(the source's intermediate at pair grain, a result in its own right)
joins pre-counted sides: distinct keys with counts, the pair count kept
as a product. A patient holding a third of all tickets is a few rows per
day after the map-side aggregation. The pivot is one conditional
aggregation (one shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import ci_contains, ci_eq, ci_not_in, date_literal, lit, time_type
from ..operators.measures import VISIT_KEYS, movement_measures
from ..params import Params, now_unless_given
from ..sources.schemas import fold_keys, salt_of

# Visit columns the job reads (a written visit table needs only these).
VISIT_COLUMNS = ["territorio", "agencia", "centro", "fecha_inicio", "numero_semana", "clasif",
                 "tipo_siniestro_origen", "bp_paciente", "cl_mov_desc"]

ORDER = ["territorio", "agencia", "centro", "fecha_inicio"]
BRIDGE_KEYS = ["centro", "rut_paciente", "tipo_atencion", "fecha", "cl_mov_desc",
               "tipo_siniestro_origen"]

# Pivot: service-time label -> (output column, default minutes). 'Otros'
# is pivoted by the source and then unused, so it has no column here.
TIME_COLUMNS = {
    "Tareas Admin": ("tareas_admin", rules.SERVICE_MINUTES["tareas_admin"]),
    "Control espontaneo": ("controles_espontaneos", rules.SERVICE_MINUTES["control_espontaneo"]),
    "Control Agendado": ("controles_agendados", rules.SERVICE_MINUTES["control_agendado"]),
    "Ingreso": ("ingresos", rules.SERVICE_MINUTES["ingreso"]),
    "Ingreso EP": ("ingresos_ep", rules.SERVICE_MINUTES["ingreso_ep"]),
    "Preingreso EP": ("preingresos_ep", rules.SERVICE_MINUTES["preingreso_ep"]),
}
# visit measure -> service-time column it is multiplied by
DEMAND_TERMS = [
    ("ingreso", "ingresos"),
    ("ingreso_ep", "ingresos_ep"),
    ("preingreso_ep", "preingresos_ep"),
    ("control_agendado", "controles_agendados"),
    ("control_espnt", "controles_espontaneos"),
    ("administrativo", "tareas_admin"),
]


@now_unless_given
def timed_tickets(queue_log: DataFrame, params: Params | None = None) -> DataFrame:
    return fold_keys(queue_log).where(
        f"fecha > {date_literal(params.demand_start)}"
        f" AND {ci_not_in('centro', rules.DEMAND_EXCLUDED_CENTRES)}"
        f" AND NOT {ci_contains('centro', rules.DEMAND_EXCLUDED_PATTERN)}"
        f" AND {ci_eq('estado', rules.TIMED_STATE)}"
        f" AND {ci_eq('descripcion_tipo', rules.TIMED_DESCRIPTION)}"
    )


@now_unless_given
def timed_visits(queue_log: DataFrame, party: DataFrame, visit: DataFrame,
                 params: Params | None = None) -> DataFrame:
    """Bridge join at the grain of ``BRIDGE_KEYS``.

    ``n_pares`` is the number of (ticket, party, visit) row triples the
    plain join would produce for the group; ``minutos`` their maximum.
    """
    tickets = timed_tickets(queue_log, params)
    q = (
        tickets.groupBy(*salt_of(tickets), "centro", "rut_paciente", "tipo_atencion", "fecha")
        .agg(F.max("minutos").alias("minutos"), F.count(F.lit(1)).alias("n_q"))
    )
    p = fold_keys(party).groupBy("rut", "numero_bp").agg(F.count(F.lit(1)).alias("n_p"))
    v = (
        visit.where(f"cl_mov_desc IS NOT NULL AND fecha_inicio > {date_literal(params.demand_start)}")
        .groupBy("bp_paciente", "fecha_inicio", "cl_mov_desc", "tipo_siniestro_origen")
        .agg(F.count(F.lit(1)).alias("n_v"))
    )
    j = (
        q.join(p, q.rut_paciente == p.rut, "inner")
        .join(v, (F.col("numero_bp") == v.bp_paciente) & (q.fecha == v.fecha_inicio), "inner")
    )
    return j.groupBy(*BRIDGE_KEYS).agg(
        F.sum(F.col("n_q") * F.col("n_p") * F.col("n_v")).alias("n_pares"),
        F.max("minutos").alias("minutos"),
    )


@now_unless_given
def typed_ticket_minutes(queue_log: DataFrame, party: DataFrame, visit: DataFrame,
                         params: Params | None = None) -> DataFrame:
    """Ticket groups with their longest minutes, per service-time type of their patient-day.

    The source averages, per (centre, type, day), the longest minutes of
    every (ticket group, visit movement/claim combination) of a patient-day
    whose combination maps to that type. A ticket group therefore counts
    once per such combination: ``k`` = number of the patient-day's distinct
    combinations of a type is its weight. Each ticket group meets at most
    one row per type (7), never the patient-day's combinations one by one.
    """
    tickets = timed_tickets(queue_log, params)
    q = (
        tickets.groupBy(*salt_of(tickets), "centro", "rut_paciente", "tipo_atencion", "fecha")
        .agg(F.max("minutos").alias("minutos"))
    )
    party = fold_keys(party)
    visits = visit.where(
        f"cl_mov_desc IS NOT NULL AND fecha_inicio > {date_literal(params.demand_start)}"
    ).select("bp_paciente", "fecha_inicio", "cl_mov_desc", "tipo_siniestro_origen")
    per_type = (
        visits.join(party.select("rut", "numero_bp"), visits.bp_paciente == party.numero_bp, "inner")
        .groupBy("rut", "fecha_inicio",
                 F.expr(time_type("cl_mov_desc", "tipo_siniestro_origen")).alias("tipo"))
        .agg(F.countDistinct(F.struct("cl_mov_desc", "tipo_siniestro_origen")).alias("k"))
    )
    return q.join(per_type, (q.rut_paciente == per_type.rut) & (q.fecha == per_type.fecha_inicio),
                  "inner").select("centro", "fecha", "tipo", "minutos", "k")


@now_unless_given
def service_time_daily(queue_log: DataFrame, party: DataFrame, visit: DataFrame,
                       params: Params | None = None) -> DataFrame:
    """Average measured minutes per centre, service-time type and day: sum(max * k) / sum(k), groups without minutes left out."""
    rows = typed_ticket_minutes(queue_log, party, visit, params)
    return rows.groupBy("centro", "tipo", "fecha").agg(
        F.expr("sum(CAST(minutos AS DOUBLE) * k) / sum(CASE WHEN minutos IS NOT NULL THEN k END)").alias("minutos")
    )


@now_unless_given
def service_times(queue_log: DataFrame, party: DataFrame, visit: DataFrame,
                  params: Params | None = None) -> DataFrame:
    """``service_time_pivot(service_time_daily(..))`` in one aggregation.

    The pivot's average of the single value per (centre, type, day) is
    that value, so the weighted averages are pivoted directly.
    """
    rows = typed_ticket_minutes(queue_log, party, visit, params)
    aggs = [
        F.expr(f"coalesce(sum(CASE WHEN tipo = {lit(label)} THEN CAST(minutos AS DOUBLE) * k END)"
               f" / sum(CASE WHEN tipo = {lit(label)} AND minutos IS NOT NULL THEN k END), {default!r})").alias(name)
        for label, (name, default) in TIME_COLUMNS.items()
    ]
    return rows.groupBy("centro", "fecha").agg(*aggs)


def service_time_pivot(daily: DataFrame) -> DataFrame:
    """One row per centre-day, one column per service-time type, defaults filled.

    Written as conditional averages in a single aggregation: the same
    result as ``groupBy().pivot(tipo, values).avg()`` without its second
    aggregation round.
    """
    aggs = [
        F.expr(f"coalesce(avg(CASE WHEN tipo = {lit(label)} THEN minutos END), {default!r})")
        .alias(name)
        for label, (name, default) in TIME_COLUMNS.items()
    ]
    return daily.groupBy("centro", "fecha").agg(*aggs)


def demand_minutes(measures: DataFrame, times: DataFrame) -> DataFrame:
    """Visit counts x service minutes per centre-day (NULL when no timed attention)."""
    t = times.withColumnsRenamed({"centro": "t_centro", "fecha": "t_fecha"})
    j = measures.join(
        t, (measures.fecha_inicio == t.t_fecha) & (measures.centro == t.t_centro), "left"
    )
    total = " + ".join(f"{m} * {mins}" for m, mins in DEMAND_TERMS)
    return j.selectExpr(*[k for k in VISIT_KEYS if k != "numero_semana"], f"{total} AS tiempo_total")


def staffed_capacity(capacity: DataFrame) -> DataFrame:
    return fold_keys(capacity).where(
        f"{ci_eq('cargo', rules.STAFF_ROLE)} AND {ci_eq('estado', rules.APPROVED)}"
    ).selectExpr("centro", "fte AS oferta")


@now_unless_given
def demand_vs_capacity(queue_log: DataFrame, party: DataFrame, visit: DataFrame,
                       capacity: DataFrame, params: Params | None = None) -> DataFrame:
    times = service_times(queue_log, party, visit, params)
    v = visit.where(f"fecha_inicio > {date_literal(params.demand_start)}")
    demand = demand_minutes(movement_measures(v, VISIT_KEYS, "narrow"), times)
    staff = staffed_capacity(capacity)
    out = (
        demand.where("tiempo_total IS NOT NULL")
        .join(staff, "centro", "inner")  # filtered LEFT JOIN == INNER; duplicate rows fan out
        .selectExpr("territorio", "agencia", "centro", "fecha_inicio",
                    f"tiempo_total / {rules.MINUTES_PER_FTE_DAY} AS tiempo_total", "oferta")
    )
    return out.orderBy(*ORDER)
