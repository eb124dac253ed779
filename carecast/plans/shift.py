"""P5 — half-hour weekly demand model for shift planning.

Stages:

  hours      wide opening hours -> long
  grid       calendar days x open slots x centres
  weekly     visits of the last N weeks per centre-week
  weekly_p75 p75 per centre of the weekly totals
  first      first attention per ticket and visit centre (sides ranked apart, joined
             once: no ticket x visit pairs)
  synthetic  visit-based rows for centres without tickets, on the calendar's days
  union      positional union of first + synthetic
  slots      per centre-day-slot totals and times
  filled     grid left join slots, zeros for gaps
  slot_p75   p75 per slot over distinct value pairs
  stddev     per slot std dev of slot times
             (both from one pass over ``filled``)
  curve      slot share of the centre's p75 total
  hourly     share x weekly p75, rounded
  result     hourly + std devs + lapse label

The synthetic branch has no date filter in the source; its rows meet the
calendar's days in the grid and are lost elsewhere. So it reads the visits of
these days only: a semi-join, which on a visit table partitioned by day prunes
the partitions read at run time (dynamic partition pruning), as the planner
broadcasts the calendar and reuses it in the scan.

``slots`` to ``result`` come from one table, a row per slot, which the job writes
once (``persist``): its three result sets are columns of it.

Partitioning: everything after ``filled`` is keyed by centre. ``filled``
is repartitioned once by centre; the slot std dev (a window), the
distinct pairs, the slot percentile and the centre-level window sum then
run without further exchanges, and no join is needed to put the
percentile and std dev side by side. Its size is
bounded by centres x calendar days x 48, whatever the visit volume. The
weekly p75 table (one row per centre) is small at runtime, so AQE turns
its join into a broadcast.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from .. import rules, storage
from ..functions import ci_in, ci_not_in, date_literal, lit
from ..operators import reshape, slots
from ..params import Params, now_unless_given
from ..session import materialize
from ..sources import schemas

# Visit columns the model reads (a written visit table needs only these).
VISIT_COLUMNS = ["bp_paciente", "fecha_inicio", "hora_inicio", "centro", "uo_medica", "clasif",
                 "tipo_siniestro_origen", "anno", "numero_semana", "dia_semana", "media_hora"]

RESULT_COLUMNS = ["centro", "diasem", "mediahora", "tdv3", "tca3", "qdv3", "qca3",
                  "devest_variable", "devest_controles", "lapse"]


def window_visits(visit: DataFrame, params: Params) -> DataFrame:
    """Visits on or after ``as_of - weeks`` (a date at midnight vs a datetime)."""
    return visit.where(f"fecha_inicio >= {date_literal(params.window_first_date)}")


def calendar_days(calendar: DataFrame, params: Params) -> DataFrame:
    """The calendar's days as visit dates. No visit lies behind ``as_of``, so no later day is needed."""
    return (calendar.selectExpr("CAST(fecha AS DATE) AS fecha_inicio")
            .where(f"fecha_inicio <= {date_literal(params.last_date)}").distinct())


def on_days(visit: DataFrame, calendar: DataFrame, params: Params) -> DataFrame:
    """Visits of the calendar's days."""
    return visit.join(calendar_days(calendar, params), "fecha_inicio", "left_semi")


def needed_visits(visit: DataFrame, calendar: DataFrame, params: Params) -> DataFrame:
    """The visits that any stage reads: those of the trailing window and, unless that limits all, of the calendar's days."""
    if params.limit_synthetic:
        return window_visits(visit, params)
    first, last = date_literal(params.window_first_date), date_literal(params.last_date)
    window = visit.sparkSession.range(1).selectExpr(f"explode(sequence({first}, {last})) AS fecha_inicio")
    return visit.join(calendar_days(calendar, params).unionByName(window).distinct(), "fecha_inicio", "left_semi")


@now_unless_given
def shift_stages(visit: DataFrame, queue_log: DataFrame, party: DataFrame, calendar: DataFrame,
                 opening_hours_wide: DataFrame, params: Params | None = None,
                 persist: bool = False, write_centres: bool = True) -> dict[str, DataFrame]:
    """All stages as DataFrames (``persist`` writes the slot statistics, which the last stages share, to the shared folder).

    ``write_centres`` writes the list of centres that have a queue first, a
    row per centre, so that the planner knows its size and the visits need no
    shuffle by centre to leave these out.
    """
    visit, queue_log, party = (schemas.fold_keys(x) for x in (visit, queue_log, party))
    opening_hours_wide = schemas.fold_centres(opening_hours_wide)
    st: dict[str, DataFrame] = {}
    st["hours"] = reshape.unpivot_hours(opening_hours_wide)
    st["grid"] = slots.slot_grid(calendar, opening_hours_wide)

    recent = window_visits(visit, params)
    st["weekly"] = slots.weekly_load(recent)
    st["weekly_p75"] = slots.weekly_p75(st["weekly"])

    queue_rows = queue_log.where(f"{ci_in('fila', rules.QUEUE_ROWS)} AND validacion = 1")
    visit_rows = recent.where(ci_not_in("centro", rules.SHIFT_EXCLUDED_CENTRES))
    st["first"] = slots.first_attention(queue_rows, party, visit_rows, params.box_only, params.within_minutes)

    centres = queue_log.select("centro").distinct()
    st["queue_centres"] = materialize(centres, "queue-centres") if write_centres else centres
    synth_source = recent if params.limit_synthetic else on_days(visit, calendar, params)
    st["synthetic"] = slots.synthetic_attention(synth_source, st["queue_centres"])
    st["union"] = reshape.union_branches(st["first"], st["synthetic"], params.fix_union_order)
    st["slots"] = slots.slot_demand(st["union"])

    st["filled"] = filled = slots.gap_fill(st["grid"], st["slots"]).repartition("centro")
    stats = slots.slot_statistics(filled)
    st["slot_p75"] = stats.select(*slots.SLOT_KEYS, "total_demanda_variable_p75", "total_controles_p75")
    st["stddev"] = stats.select(*slots.SLOT_KEYS, "devest_variable", "devest_controles")
    devs = ("devest_variable", "devest_controles")
    curve = slots.demand_curve(stats, carry=devs)
    st["curve"] = curve.drop(*devs)
    hourly = slots.hourly_demand(curve, st["weekly_p75"], carry=devs)
    if persist:
        hourly = materialize(hourly, "slot-statistics")
        st["stddev"] = hourly.select(*slots.SLOT_KEYS, *devs)
    st["hourly"] = hourly.drop(*devs)
    # The source attaches the std devs with a left join on the slot keys,
    # which cannot match the all-NULL slot of a weekday without hours.
    null_key = " OR ".join(f"{k} IS NULL" for k in slots.SLOT_KEYS)
    st["result"] = hourly.selectExpr(
        *RESULT_COLUMNS[:7],
        *[f"CASE WHEN {null_key} THEN CAST(NULL AS DOUBLE) ELSE {d} END AS {d}" for d in devs],
        f"{lit(params.lapse)} AS lapse",
    )
    return st


@now_unless_given
def shift_demand(visit: DataFrame, queue_log: DataFrame, party: DataFrame, calendar: DataFrame,
                 opening_hours_wide: DataFrame, params: Params | None = None) -> DataFrame:
    return shift_stages(visit, queue_log, party, calendar, opening_hours_wide, params)["result"]


def append_shift_tool(result: DataFrame, path: str) -> None:
    """Append rows to the shift-tool table at ``path`` (parquet), by position, all or none.

    Like ``INSERT INTO t SELECT *``: columns are matched by position to
    the table's order, and a re-run appends again (not idempotent).

    The rows, one per slot and centre, are written as one file into a folder
    that readers pass over (its name starts with ``_``); moving the file into the table
    is the commit. A job that fails before leaves no row, one that is lost
    leaves at most the folder.
    """
    spark = result.sparkSession
    try:
        target = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        target = result  # a new table: the result defines the columns
    if [k for _, k in target.dtypes] != [k for _, k in result.dtypes]:
        raise ValueError(f"sink has columns {target.dtypes}, result {result.dtypes}")
    batch = uuid.uuid4().hex
    staged = os.path.join(path, f"_staged-{batch}")
    try:
        result.toDF(*target.columns).repartition(1).write.parquet(staged)
        for name in storage.names(spark, staged):
            if name.endswith(".parquet"):
                storage.move(spark, os.path.join(staged, name), os.path.join(path, f"part-{batch}.parquet"))
    finally:
        storage.delete(spark, staged)
