"""Physical-plan properties that matter at scale, read from ``explain()``."""

import contextlib
import io
import re
import uuid

import pytest

from carecast.registry import queries
from carecast.session import shared_dir
from tests.conftest import SMALL_SF


def plan(spark, name: str) -> str:
    df = queries()[name](spark, SMALL_SF)
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan(spark, n) for n in
            ["visit_classification", "covid_daily", "queue_first_attention", "shift_demand",
             "demand_vs_capacity"]}


def test_visit_filters_reach_the_scan(plans):
    p = plans["visit_classification"]
    scan = re.search(r"Scan parquet.*?events\.parquet.*?ReadSchema: struct<([^>]*)>", p, re.S)
    assert scan and set(scan.group(1).replace(" ", "").split(",")) == {
        "event_id:bigint", "ts:timestamp_ntz", "user_id:bigint"}
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(ts", p)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_daily_report_is_one_pass_with_broadcast_claims(plans):
    p = plans["covid_daily"]
    assert "SortMergeJoin" not in p
    # partial + final aggregate around every exchange
    assert p.count("HashAggregate") >= 2 * p.count("Exchange hashpartitioning")


def test_first_attention_limits_before_the_shuffle(plans):
    p = plans["queue_first_attention"]
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) and final


def test_slot_statistics_reuse_one_partitioning(plans):
    p = plans["shift_demand"]
    assert p.count("REPARTITION_BY_COL") == 1
    assert "percentile" in p and "stddev_samp" in p


def test_visit_table_is_written_once_and_scanned(plans):
    p = plans["demand_vs_capacity"]
    assert "events.parquet" in p          # tickets still come from events
    assert re.search(r"Location: InMemoryFileIndex[^\n]*visit-", p)  # visit table read back


def test_bucketed_visits_classify_without_shuffle(spark):
    from carecast.plans import visits
    from carecast.session import materialize
    from carecast.sources import catalog
    from carecast.sources.adapters import DomainTables

    t = DomainTables.of(spark, SMALL_SF)
    raw = catalog.write_bucketed(t.visit_raw, "visit_raw_bucketed", 4)
    units = materialize(t.org_unit, "org-unit")  # stored, as on a cluster: the planner sees that it is the small side
    df = visits.classify_visits(raw, units)
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    final = buf.getvalue().split("== Initial Plan ==")[0]
    assert "hashpartitioning" not in final  # only the org-unit broadcast is exchanged
    assert df.count() == visits.classify_visits(t.visit_raw, t.org_unit).count()


def test_bucketed_queue_ranks_tickets_without_shuffle(spark):
    from carecast.operators import slots
    from carecast.sources import catalog
    from carecast.sources.adapters import DomainTables

    t = DomainTables.of(spark, SMALL_SF)
    q = catalog.write_bucketed(t.queue_log, "queue_log_bucketed", 4, key="rut_paciente")
    df = slots.first_tickets(q)
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    assert "hashpartitioning" not in buf.getvalue().split("== Initial Plan ==")[0]
    assert df.count() == slots.first_tickets(t.queue_log).count()


@pytest.mark.parametrize("hot", [7, None])
def test_hot_claim_is_split(spark, hot):
    from carecast.operators.joins import with_claim_flags, written_claim_keys

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    value = "CAST(NULL AS BIGINT)" if hot is None else str(hot)
    visit = spark.range(0, 400_000, 1, 8).selectExpr(
        "id", f"CASE WHEN id % 2 = 0 THEN {value} ELSE id END AS siniestro", "sha2(CAST(id AS STRING), 256) AS nota")
    claims = spark.range(0, 2000).selectExpr("concat('C', id) AS siniestro_covid19")
    cases = spark.range(0, 2000, 2).selectExpr("id AS id_siniestro")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = with_claim_flags(visit, written_claim_keys(claims, cases)).selectExpr("sum(length(nota)) AS n", "sum(w) AS w")
        assert df.first() is not None and df.collect()[0]["n"] == 64 * 400_000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df) -> str:
    """The final adaptive plan: ``collect`` runs the frame's own plan, which explain then shows as it ran."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_calendar_prunes_the_days_of_a_stored_visit_table(spark):
    from carecast.params import CHECK
    from carecast.plans import jobs, shift
    from carecast.session import materialize
    from carecast.sources.adapters import DomainTables

    t = DomainTables.of(spark, SMALL_SF)
    tables = jobs.Tables(*(getattr(t, n) for n in jobs.Tables.__dataclass_fields__))
    visit = jobs.classify_job(tables, f"{shared_dir(spark)}/visits-{uuid.uuid4().hex}", CHECK)
    calendar = materialize(t.calendar.where("day(fecha) % 9 = 0"), "calendar")  # three days of the month
    rows = shift.on_days(visit, calendar, CHECK)
    collected = rows.collect()
    assert {r["fecha_inicio"].day % 9 for r in collected} == {0} and len(collected) == visit.where("day(fecha_inicio) % 9 = 0").count()
    assert re.search(r"PartitionFilters: \[[^\n]*dynamicpruning", executed(rows))
    stages = shift.shift_stages(visit, t.queue_log, t.party, calendar, t.opening_hours_wide, CHECK)
    scan = executed(stages["synthetic"])
    assert re.search(r"PartitionFilters: \[[^\n]*dynamicpruning", scan)
    days = {r["fecha"] for r in stages["synthetic"].select("fecha").distinct().collect()}
    assert days and {d.day % 9 for d in days} == {0}
    # the result is that of a model that reads all days
    before, shift.on_days = shift.on_days, lambda v, c, p: v
    try:
        whole = shift.shift_stages(visit, t.queue_log, t.party, calendar, t.opening_hours_wide, CHECK)
    finally:
        shift.on_days = before
    assert sorted(map(str, whole["filled"].collect())) == sorted(map(str, stages["filled"].collect()))


def test_registered_model_writes_only_needed_days(plans):
    p = plans["shift_demand"]
    assert re.search(r"PartitionFilters: \[[^\n]*fecha_inicio[^\n]*>= 2024-01-0", p)  # the trailing window
    assert re.search(r"PartitionFilters: \[[^\n]*dynamicpruning", p)  # the calendar


def test_three_result_sets_from_one_pass_over_the_grid(spark):
    from carecast.params import CHECK
    from carecast.plans import jobs
    from carecast.sources.adapters import DomainTables

    t = DomainTables.of(spark, SMALL_SF)
    tables = jobs.Tables(*(getattr(t, n) for n in jobs.Tables.__dataclass_fields__))
    visit = jobs.classify_job(tables, f"{shared_dir(spark)}/visits-{uuid.uuid4().hex}", CHECK)
    sets = jobs.shift_job(visit, tables, None, CHECK)
    for df in sets.values():
        p = executed(df)
        assert p.count("Location: ") == 1 and "slot-statistics" in p and "Exchange" not in p and "Window" not in p
    assert sets["result"].count() == sets["demand"].count() == sets["deviation"].count() > 0
