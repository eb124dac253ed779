"""Semantic traps of the source dialect, each on a literal fixture with a hand-worked answer."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from carecast import rules
from carecast.functions import (
    claim_number, col, half_hour, month_name, null_safe_concat, synthetic_end_time, week_number,
    weekday_name,
)
from carecast.operators import reshape, slots
from carecast.operators.joins import with_claim_flags, written_claim_keys
from carecast.params import Params
from carecast.plans import covid, shift
from carecast.sources import schemas

D = dt.date
TS = dt.datetime


def one(spark, expr, value, dtype):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", dtype)]))
    return df.select(col(expr).alias("y")).first()["y"]


# ------------------------------------------------------------------ calendar
@pytest.mark.parametrize("day,week", [
    (D(2020, 1, 5), 1), (D(2020, 1, 6), 2), (D(2020, 4, 21), 17), (D(2021, 1, 1), 1),
    (D(2019, 12, 30), 53),
])
def test_t3_calendar_week_not_iso(spark, day, week):
    assert one(spark, week_number("x"), day, T.DateType()) == week


def test_t4_spanish_names_capitalised(spark):
    assert one(spark, weekday_name("x"), D(2020, 3, 18), T.DateType()) == "Miércoles"
    assert one(spark, month_name("x"), D(2020, 3, 18), T.DateType()) == "Marzo"


@pytest.mark.parametrize("t,slot", [
    (TS(2024, 1, 1, 16, 59, 59), "16:30:00"), (TS(2024, 1, 1, 0, 0, 0), "00:00:00"),
    (TS(2024, 1, 1, 23, 30, 0), "23:30:00"),
])
def test_c8_half_hour_floor(spark, t, slot):
    assert one(spark, half_hour("x"), t, T.TimestampNTZType()) == slot


def test_t10_fractional_minutes_truncate(spark):
    df = spark.createDataFrame(
        [(TS(2024, 1, 1, 0, 0), "Ingreso", "Trabajo")],
        "h timestamp_ntz, clasif string, claim string",
    )
    end = df.select(col(synthetic_end_time("h", "clasif", "claim")).alias("e")).first()["e"]
    assert end == TS(2024, 1, 1, 0, 36)


def test_t7_concat_null_is_empty(spark):
    df = spark.createDataFrame([("Lunes", None)], "a string, b string")
    assert df.select(col(null_safe_concat("a", "'-'", "b")).alias("k")).first()["k"] == "Lunes-"


def test_t9_cutoff_is_a_datetime():
    p = Params(as_of=TS(2020, 6, 15, 13, 0), weeks=13)
    assert p.window_first_date == D(2020, 3, 17)  # 2020-03-16 00:00 < 2020-03-16 13:00


def test_t25_empty_claim_number_reads_zero(spark):
    assert one(spark, claim_number("x"), "C", T.StringType()) == 0
    assert one(spark, claim_number("x"), "C123 ", T.StringType()) == 123


# ------------------------------------------------------------------ reshaping
def test_t8_unpivot_drops_null_keeps_zero(spark):
    wide = spark.createDataFrame([("Lunes", "08:00:00", 1, None, 0)],
                                 "diasem string, mediahora string, A int, B int, C int")
    rows = reshape.unpivot_hours(wide).collect()
    assert sorted((r.centro, r.horario) for r in rows) == [("A", 1), ("C", 0)]


def _visit(spark, rows):
    """rows: (centro, fecha, hora, clasif, claim type label)."""
    full = []
    for i, (centro, fecha, hora, clasif, claim) in enumerate(rows):
        full.append((
            i, 1, fecha, hora, "code", 1, "UO_1", "N", 1, fecha.month, "m", fecha.year, fecha.day,
            hora.hour, "00:00:00", "Lunes", 1, claim, clasif, "1-Lunes", 1, "y", "T", "A", centro,
            "UNIT",
        ))
    return spark.createDataFrame(full, schemas.VISIT)


def test_t2_positional_union_swaps_columns(spark):
    v = _visit(spark, [("C_X", D(2024, 1, 1), TS(2024, 1, 1, 9), "Control Agendado", "Trabajo")])
    no_queue = spark.createDataFrame([("C_Y",)], "centro string")
    synth = slots.synthetic_attention(v, no_queue)
    first = spark.createDataFrame([], synth.schema).selectExpr(*slots.QUEUE_BRANCH_ORDER)
    pos = reshape.union_branches(first, synth).first()
    named = reshape.union_branches(first, synth, by_name=True).first()
    assert (pos.control_espontaneo, pos.control_agendado) == (1, 0)
    assert (named.control_espontaneo, named.control_agendado) == (0, 1)


# ------------------------------------------------------------------ measures
def test_t1_case_insensitive_labels(spark):
    # weekly load compares with 'PreIngreso EP'; the class label is 'Preingreso EP'
    v = _visit(spark, [("C", D(2024, 1, 2), TS(2024, 1, 2, 9), "Preingreso EP", "Trabajo"),
                       ("C", D(2024, 1, 2), TS(2024, 1, 2, 9), "Ingreso", "Enfermedad profesional")])
    r = slots.weekly_load(v).first()
    assert r.cantidad_demanda_variable == 2
    assert r.tiempo_demanda_variable == pytest.approx(28 + 37)


def test_t6_integer_division_per_row(spark):
    names = ["preingreso_ep", "ingreso_ep", "control_espontaneo", "tareas_administrativas", "ingreso"]
    expected = [0.0, 1.0, 0.0, 0.0, 20.6 / 30]
    base = {c: 0 for c in slots.QUEUE_BRANCH_ORDER[14:]}
    for name, want in zip(names, expected):
        counts = dict(base, **{name: 1})
        row = ("C", " ", D(2024, 1, 1), TS(2024, 1, 1, 9), None, " ", "box_atencion", 0.0, "U",
               "x", 2024, 1, "Lunes", "09:00:00", *[counts[c] for c in slots.QUEUE_BRANCH_ORDER[14:]])
        schema = ("centro string, rut_paciente string, fecha date, hora_inicia timestamp_ntz, "
                  "hora_fin timestamp_ntz, cargo string, estado string, minutos double, "
                  "uo_medica string, clasif string, anno int, numero_semana int, "
                  "dia_semana_nombre string, media_hora string, "
                  + ", ".join(f"{c} bigint" for c in slots.QUEUE_BRANCH_ORDER[14:]))
        r = slots.slot_demand(spark.createDataFrame([row], schema)).first()
        assert r.tiempo_dmd_var == pytest.approx(want), name


def test_t17_vig_de_la_salud_is_otros(spark):
    v = _visit(spark, [("C", D(2024, 1, 2), TS(2024, 1, 2, 9), "Vigilancia de la Salud", "Trabajo")])
    claims = spark.createDataFrame([], schemas.COVID_CLAIM)
    cases = spark.createDataFrame([], schemas.MINISTRY_CASE)
    r = covid.covid_measures(v, claims, cases, Params(since=D(2024, 1, 1))).first()
    assert (r.otros, r.administrativo, r.atenciones_totales) == (1, 0, 0)


def test_t11_repeated_covid_claim_multiplies(spark):
    v = _visit(spark, [("C", D(2024, 1, 2), TS(2024, 1, 2, 9), "Ingreso", "Trabajo")])
    claims = spark.createDataFrame([("C1",), ("C1",)], schemas.COVID_CLAIM)
    cases = spark.createDataFrame([(1,), (1,)], schemas.MINISTRY_CASE)
    p = Params(since=D(2024, 1, 1))
    r = covid.covid_daily(v, claims, cases, p).first()
    assert (r.minsal, r.minsal_no_covid, r.atenciones, r.atenciones_covid) == (2, 0, 0, 0)
    r1 = covid.covid_daily(v, claims, cases, p.with_(dedupe_claims=True)).first()
    assert r1.minsal == 1
    flags = with_claim_flags(v, written_claim_keys(claims, cases)).first()
    assert (flags.covid_flag, flags.minsal_flag, flags.w) == (1, 1, 2)


# ------------------------------------------------------------------ slot statistics
def _filled(spark, rows):
    return spark.createDataFrame(
        rows,
        "centro string, diasem string, fecha date, mediahora string, total_demanda_variable bigint, "
        "total_controles bigint, tiempo_dmd_var double, tiempo_dmd_controles double",
    )


def test_t5_percentile_over_distinct_pairs(spark):
    f = _filled(spark, [("C", "Lunes", D(2024, 1, d), "09:00:00", v, 0, 0.0, 0.0)
                        for d, v in zip((1, 8, 15, 22), (1, 1, 1, 5))])
    r = slots.slot_statistics(f).first()
    assert r.total_demanda_variable_p75 == pytest.approx(4.0)  # [1, 5] not [1, 1, 1, 5]


def test_a11_single_day_std_dev_is_zero(spark):
    f = _filled(spark, [("C", "Lunes", D(2024, 1, 1), "09:00:00", 1, 0, 2.5, 0.0)])
    r = slots.slot_statistics(f).first()
    assert (r.devest_variable, r.devest_controles) == (0.0, 0.0)


def test_c24_all_zero_centre_gets_zero_share(spark):
    f = _filled(spark, [("C", "Lunes", D(2024, 1, 1), "09:00:00", 0, 0, 0.0, 0.0)])
    r = slots.demand_curve(slots.slot_statistics(f)).first()
    assert (r.porcentaje_demanda_variable, r.porcentaje_controles) == (0.0, 0.0)


def test_t21_weekday_without_hours_gives_null_slot_row(spark):
    cal = spark.createDataFrame([(D(2024, 1, 7),), (D(2024, 1, 8),)], schemas.CALENDAR)  # Sun, Mon
    wide = spark.createDataFrame([("Lunes", "09:00:00", 1)], "diasem string, mediahora string, C int")
    v = _visit(spark, [("C", D(2024, 1, 8), TS(2024, 1, 8, 9), "Ingreso", "Trabajo")])
    queue = spark.createDataFrame([], schemas.QUEUE_LOG)
    party = spark.createDataFrame([], schemas.PARTY)
    p = Params(as_of=TS(2024, 1, 31, 12))
    st = shift.shift_stages(v, queue, party, cal, wide, p)
    grid = sorted(st["grid"].collect(), key=lambda r: r.fecha)
    assert (grid[0].centro, grid[0].diasem, grid[0].mediahora) == (None, None, None)
    res = {r.centro: r for r in st["result"].collect()}
    assert res[None].devest_variable is None and res[None].tdv3 == 0.0
    assert res["C"].devest_variable == 0.0
    assert res["C"].qdv3 == pytest.approx(1.0)  # one visit, one slot: the whole weekly p75


# ------------------------------------------------------------------ first attention (T14, counts)
def _queue(spark, rows):
    """rows: (rut, ticket, hour, minute, estado)."""
    full = []
    for rut, ticket, hour, minute, estado in rows:
        t = TS(2024, 1, 8, hour, minute)
        full.append(("C", rut, ticket, D(2024, 1, 8), t, t, "Médico", estado, 1.0, t, "A", 1, "T0",
                     "atencion"))
    return spark.createDataFrame(full, schemas.QUEUE_LOG)


def _visits_for(spark, n_copies=1):
    v = _visit(spark, [("C", D(2024, 1, 8), TS(2024, 1, 8, 9), "Ingreso", "Trabajo")] * n_copies)
    return v.withColumn("bp_paciente", v.bp_paciente * 0 + 7)


def test_t14_first_attention_any_state_by_default(spark):
    q = _queue(spark, [("R7", 0, 9, 0, "admision"), ("R7", 0, 9, 10, "box_atencion")])
    party = spark.createDataFrame([("R7", 7)], schemas.PARTY)
    v = _visits_for(spark)
    assert slots.first_attention(q, party, v).first().ingreso == 0
    assert slots.first_attention(q, party, v, box_only=True).first().ingreso == 1


def test_first_attention_counts_joined_rows(spark):
    # two identical ticket rows x two party links to the partner x three identical visits
    q = _queue(spark, [("R7", 0, 9, 10, "box_atencion")] * 2)
    party = spark.createDataFrame([("R7", 7), ("R7", 7)], schemas.PARTY)
    r = slots.first_attention(q, party, _visits_for(spark, 3)).collect()
    assert len(r) == 1 and r[0].ingreso == 2 * 2 * 3


def test_rules_fixed_values_are_consistent():
    assert len(rules.MOVEMENT_CLASS) == 12
    assert rules.WEEKDAY_ES[2] == "Miércoles"
    assert rules.SERVICE_MINUTES["ingreso"] == 20.6


@pytest.mark.parametrize("code,claim,label", [
    ("Consulta Urgenc", "Enfermedad profesional", "Ingreso EP"),
    ("consulta urgenc", "Trabajo", "Ingreso"),
    ("Consulta Ambula", "Trabajo", "Control Agendado"),
    ("Consulta Espont", "Otros", "Control espontaneo"),
    ("Preingreso EP", "Trabajo", "Preingreso EP"),
    ("Apoyo Tratamien", "Trabajo", "Tareas Admin"),
    ("Urgen.Telemed", "Trabajo", "Otros"),
])
def test_d2_service_time_types(spark, code, claim, label):
    from carecast.functions import time_type
    df = spark.createDataFrame([(code, claim)], "c string, t string")
    assert df.select(col(time_type("c", "t")).alias("x")).first().x == label
