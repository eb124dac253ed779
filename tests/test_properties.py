"""Properties the source's ad-hoc checks look at, on the smallest driver tables."""

import pytest
from pyspark.sql import functions as F

from carecast.params import CHECK
from carecast.plans import covid, demand, shift
from carecast.registry import visit
from carecast.sources.adapters import DomainTables
from tests.conftest import SMALL_SF


@pytest.fixture(scope="module")
def stages(spark):
    t = DomainTables.of(spark, SMALL_SF)
    return shift.shift_stages(visit(t, CHECK), t.queue_log, t.party, t.calendar,
                              t.opening_hours_wide, CHECK)


def test_shares_sum_to_one_or_zero_per_centre(stages):
    sums = stages["curve"].groupBy("centro").agg(
        F.sum("porcentaje_demanda_variable").alias("v"), F.sum("porcentaje_controles").alias("c")
    ).collect()
    assert sums
    for r in sums:
        for s in (r.v, r.c):
            assert abs(s) < 1e-6 or abs(s - 1) < 1e-6, r


def test_slot_visits_add_up_to_weekly_p75(stages):
    per_centre = {r.centro: r for r in stages["hourly"].groupBy("centro").agg(
        F.sum("qdv3").alias("q"), F.count(F.lit(1)).alias("n")).collect()}
    curve_tot = {r.centro: r.s for r in stages["slot_p75"].groupBy("centro").agg(
        F.sum("total_demanda_variable_p75").alias("s")).collect()}
    weekly = {r.centro: r.cantidad_demanda_variable_p75 for r in stages["weekly_p75"].collect()}
    checked = 0
    for centro, w in weekly.items():
        if centro in per_centre and curve_tot.get(centro, 0) > 0:
            r = per_centre[centro]
            assert r.q == pytest.approx(w, abs=r.n * 1e-5 + 1e-6)
            checked += 1
    assert checked > 0


def test_gap_fill_keeps_the_grid(stages):
    assert stages["filled"].count() == stages["grid"].count()
    matched = stages["slots"].select("centro", "fecha", "media_hora").distinct()
    unmatched = stages["filled"].join(
        matched.withColumnRenamed("media_hora", "mediahora"), ["centro", "fecha", "mediahora"],
        "left_anti",
    )
    assert unmatched.where("total_demanda_variable <> 0 OR total_controles <> 0").count() == 0


def test_synthetic_rows_only_for_centres_without_queue(stages, spark):
    queue_centres = {r.centro for r in stages["queue_centres"].collect()}
    synth_centres = {r.centro for r in stages["synthetic"].select("centro").distinct().collect()}
    assert synth_centres and not (synth_centres & queue_centres)


def test_std_devs_non_negative(stages):
    assert stages["stddev"].where("devest_variable < 0 OR devest_controles < 0").count() == 0


def test_four_totals_partition_the_total(spark):
    t = DomainTables.of(spark, SMALL_SF)
    m = covid.covid_measures(visit(t, CHECK), t.covid_claim, t.ministry_case, CHECK)
    bad = m.where("minsal + minsal_no_covid + atenciones_covid + atenciones <> atenciones_totales")
    assert m.count() > 0 and bad.count() == 0


def test_service_time_defaults_fill_missing_types(spark):
    t = DomainTables.of(spark, SMALL_SF)
    daily = demand.service_time_daily(t.queue_log, t.party, visit(t, CHECK), CHECK)
    piv = demand.service_time_pivot(daily).collect()
    assert piv
    seen = {(r.centro, r.fecha, r.tipo) for r in daily.collect()}
    for r in piv:
        if (r.centro, r.fecha, "Ingreso EP") not in seen:
            assert r.ingresos_ep == 37.0
        if (r.centro, r.fecha, "Tareas Admin") not in seen:
            assert r.tareas_admin == 6.0


def test_limit_synthetic_applies_the_window(spark):
    t = DomainTables.of(spark, SMALL_SF)
    p = CHECK
    v = visit(t, p)
    plain = shift.shift_stages(v, t.queue_log, t.party, t.calendar, t.opening_hours_wide, p)
    limited = shift.shift_stages(v, t.queue_log, t.party, t.calendar, t.opening_hours_wide,
                                 p.with_(limit_synthetic=True))
    first = p.window_first_date
    assert limited["synthetic"].where(F.col("fecha") < F.lit(first)).count() == 0
    assert plain["synthetic"].where(F.col("fecha") < F.lit(first)).count() > 0
    assert limited["synthetic"].count() < plain["synthetic"].count()


def test_grid_is_days_times_open_entries(stages):
    hours = stages["hours"].groupBy("diasem").count().collect()
    per_weekday = {r.diasem: r["count"] for r in hours}
    from carecast import rules
    days = stages["grid"].select("fecha").distinct().collect()
    expected = sum(per_weekday.get(rules.WEEKDAY_ES[d.fecha.weekday()], 1) for d in days)
    assert stages["grid"].count() == expected
