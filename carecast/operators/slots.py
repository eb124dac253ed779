"""Half-hour slot operators: grid, first attention, synthetic attention,
slot totals, gap filling, slot percentiles, volatility, demand curve.

Slots are "HH:mm:ss" strings everywhere (one canonical key, so the
union of branches and the grid join never convert types).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..sources.schemas import fold_keys, salt_of
from .intervals import join_within
from .reshape import HOURS_KEYS, unpivot_hours
from ..functions import (
    box_count, ci_in, class_count, half_hour, lit, null_safe_concat, num, synthetic_end_time,
    weekday_label, year_week,
)

ATTENTION_COLUMNS = [
    "centro", "rut_paciente", "fecha", "hora_inicia", "hora_fin", "cargo", "estado", "minutos",
    "uo_medica", "clasif", "anno", "numero_semana", "dia_semana_nombre", "media_hora",
]
# (measure, class, claim condition): the six attention counts.
ATTENTION_MEASURES = [
    ("preingreso_ep", "Preingreso EP", None),
    ("ingreso", "Ingreso", "not_ep"),
    ("ingreso_ep", "Ingreso", "ep"),
    ("control_espontaneo", "Control Espontaneo", None),
    ("control_agendado", "Control Agendado", None),
    ("tareas_administrativas", "Tareas Administrativas", None),
]
# Column order of each branch (the synthetic branch lists agendado first).
QUEUE_BRANCH_ORDER = ATTENTION_COLUMNS + [m for m, _, _ in ATTENTION_MEASURES]
SYNTHETIC_BRANCH_ORDER = ATTENTION_COLUMNS + [
    "preingreso_ep", "ingreso", "ingreso_ep", "control_agendado", "control_espontaneo",
    "tareas_administrativas",
]
SLOT_KEYS = ["centro", "diasem", "mediahora"]
SLOT_MEASURES = ["total_demanda_variable", "total_controles", "tiempo_dmd_var",
                 "tiempo_dmd_controles"]


# ------------------------------------------------------------------ grid
def slot_grid(calendar: DataFrame, hours_wide: DataFrame,
              keys: tuple[str, ...] = HOURS_KEYS) -> DataFrame:
    """Calendar days x the open-hours slots of their weekday, per centre.

    A weekday without any slot keeps one row with NULL centre, weekday
    and slot (the left joins of the source keep it). The weekday-slot list
    is read off the wide table (a slot exists where any centre cell is
    set, as after the unpivot).
    """
    key = null_safe_concat("diasem", lit("-"), "mediahora")
    centres = [c for c in hours_wide.columns if c not in keys]
    slots = (hours_wide.where(f"coalesce({', '.join(f'`{c}`' for c in centres)}) IS NOT NULL")
             .select(*keys).distinct())
    # Distinct dates x distinct slots of their weekday are distinct rows, so
    # the source's DISTINCT over the series moves to the (smaller) date list.
    days = calendar.selectExpr("CAST(fecha AS DATE) AS fecha").distinct().selectExpr(
        "fecha", f"{weekday_label('fecha')} AS diasem"
    )
    series = days.join(slots, "diasem", "left").select("fecha", "diasem", "mediahora")
    series = series.selectExpr("fecha", f"{key} AS t_key")
    hc = unpivot_hours(hours_wide, keys).selectExpr(
        "centro", "diasem", "mediahora", "horario", f"{key} AS hc_key")
    g = series.join(hc, series.t_key == hc.hc_key, "left")
    return g.select("centro", "fecha", "diasem", "horario", "mediahora")


# ------------------------------------------------------------------ weekly visit load
def weekly_load(visit_window: DataFrame) -> DataFrame:
    """Per centre and calendar week: variable / scheduled minutes and visit counts."""
    w = rules.SLOT_WEIGHTS
    agg = fold_keys(visit_window).groupBy("centro", F.expr(year_week("fecha_inicio")).alias("anno_semana")).agg(
        *[F.expr(f"sum({class_count('clasif', 'tipo_siniestro_origen', cls, cond, '1')})").alias(name)
          for name, cls, cond in ATTENTION_MEASURES]
    )
    variable = ["preingreso_ep", "ingreso", "ingreso_ep", "control_espontaneo", "tareas_administrativas"]
    return agg.selectExpr(
        "centro", "anno_semana",
        "CAST(" + " + ".join(f"{m} * {num(w[m])}" for m in variable) + " AS DOUBLE) AS tiempo_demanda_variable",
        f"CAST(control_agendado * {num(w['control_agendado'])} AS DOUBLE) AS tiempo_controles",
        "(" + " + ".join(variable) + ") AS cantidad_demanda_variable",
        "control_agendado AS cantidad_controles",
    )


WEEKLY_MEASURES = ["tiempo_demanda_variable", "tiempo_controles", "cantidad_demanda_variable",
                   "cantidad_controles"]


def weekly_p75(weekly: DataFrame) -> DataFrame:
    """Exact 75th percentile per centre of each weekly measure (weeks present only)."""
    return weekly.groupBy("centro").agg(
        *[F.expr(f"percentile({m}, {rules.PERCENTILE})").alias(f"{m}_p75") for m in WEEKLY_MEASURES]
    )


# ------------------------------------------------------------------ queue side
# The source joins every ticket row of a patient-day to every visit class of
# that day, counts identical (ticket, visit) rows on 18 keys, and keeps per
# (visit centre, day, patient, ticket) the row first in this order (start
# time first, as the source; the remaining keys break ties deterministically):
FIRST_ATTENTION_ORDER = [
    "hora_inicia", "estado", "clasif", "tipo_siniestro_origen", "hora_fin", "cargo", "minutos",
    "uo_medica", "hr_inicio", "anno", "numero_semana", "dia_semana", "media_hora_visita", "fila",
]
TICKET_KEYS = ["rut_paciente", "ticket", "fecha"]
TICKET_COLUMNS = ["hora_inicia", "hora_fin", "cargo", "estado", "minutos", "hr_inicio", "fila"]
CLASS_COLUMNS = ["uo_medica", "clasif", "anno", "numero_semana", "dia_semana", "media_hora_visita",
                 "tipo_siniestro_origen"]
# The order interleaves ticket and visit columns, and the candidates of a
# partition are all (ticket row, visit class) pairs: a product set. The
# lexicographic minimum of a product set is the pair of each side's own
# minimum (each side ordered by its columns in the same relative order), so
# the two sides are ranked separately and no pair is ever formed.
TICKET_ORDER = [c for c in FIRST_ATTENTION_ORDER if c in TICKET_COLUMNS]
CLASS_ORDER = [c for c in FIRST_ATTENTION_ORDER if c in CLASS_COLUMNS]


def _first_by(df: DataFrame, partition: list[str], order: list[str]) -> DataFrame:
    """Rows first in ``order`` within ``partition`` (rows are distinct on both).

    ``row_number() = 1`` runs as a partial WindowGroupLimit before the
    shuffle and a final one after: each map task forwards one row per key.
    """
    rank = (f"row_number() OVER (PARTITION BY {', '.join(partition)} ORDER BY "
            + ", ".join(f"{c} ASC NULLS FIRST" for c in order) + ")")
    return df.selectExpr("*", f"{rank} AS numerofila").where("numerofila = 1").drop("numerofila")


def ticket_rows(queue_rows: DataFrame, box_only: bool = False) -> DataFrame:
    """Distinct ticket rows and how many copies each has (``n_q``).

    A log bucketed by patient and salt (``catalog.write_bucketed``) keeps its
    salt among the keys: it depends on the day, so the rows of a ticket and day
    stay together, and neither this nor ranking them needs an exchange.
    """
    q = fold_keys(queue_rows)
    q = q.where(ci_in("estado", rules.BOX_STATES)) if box_only else q
    return q.groupBy(*salt_of(q), *TICKET_KEYS, *TICKET_COLUMNS).agg(F.count(F.lit(1)).alias("n_q"))


def first_tickets(queue_rows: DataFrame, box_only: bool = False) -> DataFrame:
    """Per (patient, ticket, day): its first ticket row and how many copies it has (``n_q``)."""
    rows = ticket_rows(queue_rows, box_only)
    salt = salt_of(rows)
    return _first_by(rows, [*salt, *TICKET_KEYS], TICKET_ORDER).drop(*salt)


def visit_classes(party: DataFrame, visit_rows: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Per (patient rut, day, visit centre): the distinct visit classes and their multiplicity ``m``.

    ``m`` counts the (party link, visit) rows behind a class. Party links
    are pre-counted per (rut, partner), so copies of a link are one row;
    visits join as they are and the aggregation right after the join
    combines identical visit classes map-side, before any shuffle.
    ``more``: further visit columns that tell classes apart.
    """
    v = fold_keys(visit_rows).withColumnRenamed("media_hora", "media_hora_visita").select(
        "bp_paciente", "fecha_inicio", "centro", *CLASS_COLUMNS, *more)
    p = fold_keys(party).groupBy("rut", "numero_bp").agg(F.count(F.lit(1)).alias("n_p"))
    return (
        v.join(p, v.bp_paciente == p.numero_bp, "inner")
        .groupBy("rut", "fecha_inicio", "centro", *CLASS_COLUMNS, *more)
        .agg(F.sum("n_p").alias("m"))
    )


def first_visit_classes(party: DataFrame, visit_rows: DataFrame) -> DataFrame:
    """Per (patient rut, day, visit centre): the first visit class and its multiplicity ``m``."""
    return _first_by(visit_classes(party, visit_rows), ["rut", "fecha_inicio", "centro"], CLASS_ORDER)


def first_attention(queue_rows: DataFrame, party: DataFrame, visit_rows: DataFrame,
                    box_only: bool = False, within_minutes: int | None = None) -> DataFrame:
    """First attention per (visit centre, day, patient, ticket), queue branch column order.

    The group count of the chosen (ticket row, visit class) pair is the
    product of the two sides' counts, as the source's count over joined
    rows; the six measures are that count where the ticket is in a box
    state and the class matches, else 0.

    With ``within_minutes`` a ticket row meets only the visits that start so
    close to it. The candidates are no product set then, so the two sides meet by
    an interval join (distinct rows with counts) before the first pair is chosen.
    """
    if within_minutes is None:
        t = first_tickets(queue_rows, box_only)
        v = first_visit_classes(party, visit_rows)
        j = t.join(v, (t.rut_paciente == v.rut) & (t.fecha == v.fecha_inicio), "inner").selectExpr("*", "n_q * m AS n")
    else:
        t = ticket_rows(queue_rows, box_only)
        v = visit_classes(party, visit_rows, ("hora_inicio",)).withColumnsRenamed({"rut": "rut_paciente", "fecha_inicio": "fecha"})
        pairs = join_within(t.drop(*salt_of(t)), v, ["rut_paciente", "fecha"], "hora_inicia", "hora_inicio", within_minutes)
        counted = pairs.groupBy("centro", *TICKET_KEYS, *TICKET_COLUMNS, *CLASS_COLUMNS).agg(F.sum(F.col("n_q") * F.col("m")).alias("n"))
        j = _first_by(counted, ["centro", "fecha", "rut_paciente", "ticket"], FIRST_ATTENTION_ORDER)
    cols = {
        "centro": "centro", "rut_paciente": "rut_paciente", "fecha": "fecha",
        "hora_inicia": "hora_inicia", "hora_fin": "hora_fin", "cargo": "cargo", "estado": "estado",
        "minutos": "minutos", "uo_medica": "uo_medica", "clasif": "clasif", "anno": "anno",
        "numero_semana": "numero_semana", "dia_semana_nombre": "dia_semana",
        "media_hora": half_hour("hora_inicia"),
        **{name: box_count("estado", "clasif", "tipo_siniestro_origen", cls, cond, "n")
           for name, cls, cond in ATTENTION_MEASURES},
    }
    return j.selectExpr(*[f"{cols[c]} AS {c}" for c in QUEUE_BRANCH_ORDER])


def synthetic_attention(visit: DataFrame, queue_centres: DataFrame) -> DataFrame:
    """Attention rows estimated from visits of centres that have no queue data."""
    centres = fold_keys(queue_centres).selectExpr("centro AS q_centro")
    visit = fold_keys(visit)
    v = visit.join(centres, visit.centro == centres.q_centro, "left_anti")
    keys = ["centro", "fecha_inicio", "hora_inicio", "numero_semana", "dia_semana", "uo_medica",
            "clasif", "tipo_siniestro_origen"]
    g = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    cols = {
        "centro": "centro",
        "rut_paciente": "' '",
        "fecha": "fecha_inicio",
        "hora_inicia": "hora_inicio",
        "hora_fin": synthetic_end_time("hora_inicio", "clasif", "tipo_siniestro_origen"),
        "cargo": "' '",
        "estado": lit(rules.SYNTHETIC_STATE),
        "minutos": "CAST(0 AS DOUBLE)",
        "uo_medica": "uo_medica",
        "clasif": "clasif",
        "anno": "year(fecha_inicio)",
        "numero_semana": "numero_semana",
        "dia_semana_nombre": "dia_semana",
        "media_hora": half_hour("hora_inicio"),
        **{name: class_count("clasif", "tipo_siniestro_origen", cls, cond, "n")
           for name, cls, cond in ATTENTION_MEASURES},
    }
    return g.selectExpr(*[f"{cols[c]} AS {c}" for c in SYNTHETIC_BRANCH_ORDER])


# ------------------------------------------------------------------ slot totals
def slot_demand(attention: DataFrame) -> DataFrame:
    """Per centre, day and slot: variable / scheduled counts and half-hour times.

    Time terms divide per row; the integer weights truncate (28/30 of one
    attention is 0), only the 20.6-minute term keeps its fraction.
    """
    w, slot = rules.SLOT_WEIGHTS, rules.SLOT_MINUTES

    def per_row(col: str) -> str:
        weight = w[col]
        if float(weight).is_integer():
            return f"sum(({col} * {int(weight)}) div {slot})"  # integer division per row
        return f"sum({col} * {num(weight)} / {slot})"

    variable = ["preingreso_ep", "ingreso", "ingreso_ep", "control_espontaneo", "tareas_administrativas"]
    return attention.groupBy("centro", "fecha", "numero_semana", "dia_semana_nombre", "media_hora").agg(
        F.expr(" + ".join(f"sum({c})" for c in variable)).alias("total_demanda_variable"),
        F.expr("sum(control_agendado)").alias("total_controles"),
        F.expr("CAST(" + " + ".join(per_row(c) for c in variable) + " AS DOUBLE)").alias("tiempo_dmd_var"),
        F.expr(f"CAST({per_row('control_agendado')} AS DOUBLE)").alias("tiempo_dmd_controles"),
    )


def gap_fill(grid: DataFrame, facts: DataFrame) -> DataFrame:
    """Every grid slot with its measures, 0 where nothing happened."""
    f = facts.selectExpr("centro AS f_centro", "fecha AS f_fecha", "dia_semana_nombre AS f_diasem",
                         "media_hora AS f_mediahora", *SLOT_MEASURES)
    j = grid.join(
        f,
        (grid.centro == f.f_centro) & (grid.fecha == f.f_fecha) & (grid.diasem == f.f_diasem)
        & (grid.mediahora == f.f_mediahora),
        "left",
    )
    zero = {"total_demanda_variable": "CAST(0 AS BIGINT)", "total_controles": "CAST(0 AS BIGINT)",
            "tiempo_dmd_var": "CAST(0 AS DOUBLE)", "tiempo_dmd_controles": "CAST(0 AS DOUBLE)"}
    return j.selectExpr("centro", "diasem", "fecha", "mediahora",
                        *[f"coalesce({m}, {zero[m]}) AS {m}" for m in SLOT_MEASURES])


def slot_statistics(filled: DataFrame) -> DataFrame:
    """Per slot: 75th percentiles and time standard deviations, in one pass.

    * the percentiles run over DISTINCT (variable, scheduled) count pairs
      of the slot (the source groups before its window percentile);
    * the standard deviations run over every grid day of the slot, zeros
      included (one day -> 0).

    The std devs are window aggregates over the slot, so they ride along
    the distinct pairs and both statistics come from one scan of the
    gap-filled grid. With ``filled`` hash-partitioned by centre the window,
    the DISTINCT and the grouping need no further exchange.
    """
    slot = "PARTITION BY centro, diasem, mediahora"
    per_row = filled.selectExpr(
        *SLOT_KEYS, "total_demanda_variable", "total_controles",
        f"coalesce(stddev_samp(tiempo_dmd_var) OVER ({slot}), CAST(0 AS DOUBLE)) AS devest_variable",
        f"coalesce(stddev_samp(tiempo_dmd_controles) OVER ({slot}), CAST(0 AS DOUBLE)) AS devest_controles",
    )
    pairs = per_row.distinct()
    return pairs.groupBy(*SLOT_KEYS).agg(
        F.expr(f"percentile(total_demanda_variable, {rules.PERCENTILE})").alias("total_demanda_variable_p75"),
        F.expr(f"percentile(total_controles, {rules.PERCENTILE})").alias("total_controles_p75"),
        F.expr("max(devest_variable)").alias("devest_variable"),  # constant within the slot
        F.expr("max(devest_controles)").alias("devest_controles"),
    )


def demand_curve(p75: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Share of each slot's p75 in its centre's total of slot p75s.

    The centre total is a window sum (the rows are already clustered by
    centre); a centre whose p75s are all 0, or a NULL centre, gets 0.
    Operands are fixed to 5 decimals before dividing, as the source does,
    without its ceiling of 99,999.99999 on a centre's total.
    ``carry`` lists extra columns passed through.
    """
    def share(col: str) -> str:
        total = f"sum({col}) OVER (PARTITION BY centro)"
        ratio = f"CAST(CAST({col} AS DECIMAL(28,5)) AS DOUBLE) / CAST(CAST({total} AS DECIMAL(28,5)) AS DOUBLE)"
        return f"CASE WHEN centro IS NOT NULL AND {total} > 0 THEN {ratio} ELSE CAST(0 AS DOUBLE) END"

    return p75.selectExpr(
        *SLOT_KEYS,
        f"{share('total_demanda_variable_p75')} AS porcentaje_demanda_variable",
        f"{share('total_controles_p75')} AS porcentaje_controles",
        *carry,
    )


def hourly_demand(curve: DataFrame, weekly: DataFrame, scale: int = rules.ROUND_SCALE,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """Curve x weekly p75: minutes (tdv3, tca3) and visits (qdv3, qca3) per slot."""
    wk = weekly.withColumnRenamed("centro", "w_centro")
    j = curve.join(wk, curve.centro == wk.w_centro, "left")

    def demand(share: str, weekly_col: str) -> str:
        return f"coalesce(round({share} * {weekly_col} * 1.00, {scale}), CAST(0 AS DOUBLE))"

    return j.selectExpr(
        *SLOT_KEYS,
        f"{demand('porcentaje_demanda_variable', 'tiempo_demanda_variable_p75')} AS tdv3",
        f"{demand('porcentaje_controles', 'tiempo_controles_p75')} AS tca3",
        f"{demand('porcentaje_demanda_variable', 'cantidad_demanda_variable_p75')} AS qdv3",
        f"{demand('porcentaje_controles', 'cantidad_controles_p75')} AS qca3",
        *carry,
    )
