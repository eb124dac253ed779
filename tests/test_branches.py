"""Every rule that drops, repeats or skips rows changes a result on the driver's rows; wide hours; interval join."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from carecast import rules
from carecast.operators import reshape, slots
from carecast.operators.intervals import join_within
from carecast.operators.joins import claim_keys
from carecast.params import CHECK
from carecast.plans import covid, demand, shift, visits
from carecast.registry import round_doubles
from carecast.sources import schemas
from carecast.sources.adapters import DomainTables
SF = "/root/testdata/sf0.01"  # large enough for every branch


def rows(df):
    return sorted(map(str, round_doubles(df).collect()))


@pytest.fixture(scope="module")
def t(spark):
    return DomainTables.of(spark, SF)


@pytest.fixture(scope="module")
def visit(spark, t):
    from carecast.session import materialize

    return materialize(visits.classify_visits(t.visit_raw, t.org_unit, CHECK), "visit")


def test_repeated_visits_count_once(t, visit):
    kept = visits.live_visits(t.visit_raw, CHECK).join(visits.primary_care_units(t.org_unit), "uo_tratamiento", "left_semi")
    assert visit.count() == kept.distinct().count() < kept.count()


def test_repeated_claims_multiply(t, visit):
    args = (visit, t.covid_claim, t.ministry_case)
    assert rows(covid.covid_daily(*args, CHECK)) != rows(covid.covid_daily(*args, CHECK.with_(dedupe_claims=True)))
    assert claim_keys(t.covid_claim, t.ministry_case).where("covid_n = 2").count() > 0


def test_missing_claim_numbers_are_kept_without_flags(t, visit):
    assert visit.where("siniestro IS NULL").count() > 0
    flagged = covid.flagged_visits(visit, t.covid_claim, t.ministry_case, CHECK).where("siniestro IS NULL")
    assert {tuple(r) for r in flagged.select("covid_flag", "minsal_flag", "w").distinct().collect()} == {(0, 0, 1)}


def test_repeated_party_links_multiply(t, visit):
    once = t.party.distinct()
    assert once.count() < t.party.count()
    for job in (lambda p: demand.timed_visits(t.queue_log, p, visit, CHECK), lambda p: slots.first_attention(t.queue_log, p, visit)):
        assert rows(job(t.party)) != rows(job(once))


def test_missing_minutes_are_left_out_of_the_average(t, visit):
    filled = t.queue_log.withColumn("minutos", F.coalesce("minutos", F.lit(0.0)))
    assert t.queue_log.where("minutos IS NULL").count() > 0
    assert rows(demand.service_time_daily(t.queue_log, t.party, visit, CHECK)) != rows(demand.service_time_daily(filled, t.party, visit, CHECK))


def test_missing_movements_are_others_and_never_timed(t, visit):
    assert {r["clasif"] for r in visit.where("cl_mov_desc IS NULL").select("clasif").distinct().collect()} == {rules.OTHER}
    named = visit.withColumn("cl_mov_desc", F.coalesce("cl_mov_desc", F.lit("X")))
    assert rows(demand.timed_visits(t.queue_log, t.party, visit, CHECK)) != rows(demand.timed_visits(t.queue_log, t.party, named, CHECK))


@pytest.mark.parametrize(("name", "value"), [("DEMAND_EXCLUDED_CENTRES", ["none"]), ("DEMAND_EXCLUDED_PATTERN", "none")])
def test_centres_left_out_of_measured_demand(t, visit, monkeypatch, name, value):
    want = rows(demand.timed_visits(t.queue_log, t.party, visit, CHECK))
    monkeypatch.setattr(rules, name, value)
    assert len(rows(demand.timed_visits(t.queue_log, t.party, visit, CHECK))) > len(want)


def test_centres_left_out_of_the_half_hour_model(t, visit, monkeypatch):
    def first():
        return rows(shift.shift_stages(visit, t.queue_log, t.party, t.calendar, t.opening_hours_wide, CHECK, write_centres=False)["first"])

    want = first()
    monkeypatch.setattr(rules, "SHIFT_EXCLUDED_CENTRES", ["none"])
    assert len(first()) > len(want)


# ------------------------------------------------------------------ wide hours
def test_hours_of_92_centres(spark):
    """The source's table has 92 centre columns, some with blanks and accents in their names."""
    names = [f"Centro {k:02d}" for k in range(89)] + ["Viña del Mar", "Ñuñoa", "San José de Maipo"]
    slots_of_day = [(day, f"{s // 2:02d}:{s % 2 * 30:02d}:00") for day in rules.WEEKDAY_ES[:6] for s in range(48)]
    cells = [[None if (i + k) % 7 == 0 else (i + k) % 2 for k in range(len(names))] for i in range(len(slots_of_day))]
    wide = spark.createDataFrame([(*key, *row) for key, row in zip(slots_of_day, cells, strict=True)],
                                 "diasem string, mediahora string, " + ", ".join(f"`{n}` int" for n in names))
    began = time.perf_counter()
    folded = schemas.fold_centres(wide)
    long = reshape.unpivot_hours(folded)
    days = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=d),) for d in range(14)], "fecha date")
    grid = slots.slot_grid(days, folded)
    planned = time.perf_counter() - began
    assert planned < 5, planned
    present = sum(c is not None for row in cells for c in row)
    assert long.count() == present and long.select("centro").distinct().count() == 92
    assert grid.count() == 2 * present + 2  # two weeks, and a row for each Sunday
    assert {r["centro"] for r in long.where("centro LIKE 'VIÑA%' OR centro LIKE 'Ñ%'").select("centro").distinct().collect()} == {"VIÑA DEL MAR", "ÑUÑOA"}


# -------------------------------------------------------------- interval join
@pytest.mark.parametrize("minutes", [1, 45, 300])
def test_interval_join_equals_brute_force(spark, minutes):
    r = random.Random(minutes)
    start = dt.datetime(2024, 3, 9, 20)  # a night, so that bands cross midnight

    def some(n):
        return [(r.choice([1, 1, 1, 2, None]), r.choice([start + dt.timedelta(seconds=r.randrange(0, 40_000), minutes=r.choice([0, minutes]))] * 9 + [None]), k)
                for k in range(n)]

    left, right = some(150), some(150)
    left += [(1, start, 900), (1, start + dt.timedelta(minutes=minutes), 901)]  # exactly the interval apart
    right += [(1, start, 900), (1, start + dt.timedelta(minutes=minutes, seconds=1), 901)]
    want = sorted((a[2], b[2]) for a in left for b in right
                  if a[0] is not None and a[0] == b[0] and a[1] and b[1] and abs(a[1] - b[1]) <= dt.timedelta(minutes=minutes))
    sides = [spark.createDataFrame(x, f"k int, {n} timestamp_ntz, {n}_id int") for x, n in ((left, "a"), (right, "b"))]
    got = join_within(*sides, ["k"], "a", "b", minutes)
    assert got.columns == ["k", "a", "a_id", "b", "b_id"]
    assert sorted((x["a_id"], x["b_id"]) for x in got.collect()) == want and want


def test_interval_of_visits_changes_first_attentions(t, visit):
    free = slots.first_attention(t.queue_log, t.party, visit)
    near = slots.first_attention(t.queue_log, t.party, visit, within_minutes=300)
    wide = slots.first_attention(t.queue_log, t.party, visit, within_minutes=24 * 60)
    assert rows(wide) == rows(free) != rows(near)


# ------------------------------------------------------- two-level buckets
def test_a_hot_patient_is_spread_over_buckets_without_an_exchange(spark, t):
    from carecast.sources import catalog
    from tests.test_plans import executed

    hot = spark.range(0, 6000, 1, 4).selectExpr(
        "'C_1' AS centro", "CASE WHEN id % 3 = 0 THEN 'R0' ELSE concat('R', id) END AS rut_paciente", "id % 5 AS ticket",
        "date_add(DATE '2024-01-01', CAST(id % 97 AS INT)) AS fecha", "TIMESTAMP_NTZ '2024-01-01 09:00:00' + make_dt_interval(0, 0, CAST(id % 50 AS INT)) AS hora_inicia",
        "CAST(NULL AS TIMESTAMP_NTZ) AS hora_fin", "'x' AS cargo", "'box_atencion' AS estado", "CAST(id AS DOUBLE) AS minutos",
        "CAST(NULL AS TIMESTAMP_NTZ) AS hr_inicio", "'A' AS fila", "1 AS validacion", "'T0' AS tipo_atencion", "'atencion' AS descripcion_tipo")
    log = catalog.write_bucketed(hot, "queue_log_salted", 8, key="rut_paciente", salt_by=["fecha"])
    one_level = catalog.write_bucketed(hot, "queue_log_one_level", 8, key="rut_paciente")

    def share(table):
        """Of the hot patient's rows, the share in the fullest task."""
        n = [r["count"] for r in table.where("rut_paciente = 'R0'").groupBy(F.input_file_name()).count().collect()]
        return max(n) / sum(n)

    assert share(one_level) == 1 and share(log) < 0.4
    first = slots.first_tickets(log)
    assert "Exchange" not in executed(first).split("== Initial Plan ==")[0]
    assert rows(first) == rows(slots.first_tickets(hot)) and first.columns == slots.first_tickets(hot).columns
    assert rows(slots.first_attention(log, t.party, visits.classify_visits(t.visit_raw, t.org_unit, CHECK))) == rows(
        slots.first_attention(hot, t.party, visits.classify_visits(t.visit_raw, t.org_unit, CHECK)))
    assert rows(demand.timed_visits(log, t.party, visits.classify_visits(t.visit_raw, t.org_unit, CHECK), CHECK)) == rows(
        demand.timed_visits(hot, t.party, visits.classify_visits(t.visit_raw, t.org_unit, CHECK), CHECK))
