"""Incremental refresh equals the batch report; the job layer runs end to end."""

import datetime as dt
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from carecast import storage
from carecast.params import CHECK
from carecast.plans import covid, jobs, shift, visits
from carecast.registry import round_doubles
from carecast.session import job_scope, materialize, shared_dir
from carecast.sources.adapters import DomainTables
from carecast.streaming import start
from tests.conftest import SMALL_SF


def _rows(df):
    return sorted(tuple(r) for r in round_doubles(df).collect())


def test_incremental_daily_totals_match_batch(spark):
    t = DomainTables.of(spark, SMALL_SF)
    base = os.path.join(shared_dir(spark), f"stream-{uuid.uuid4().hex[:8]}")
    incoming, out, ckpt = (os.path.join(base, x) for x in ("incoming", "out", "ckpt"))
    raw = t.visit_raw
    first, second = raw.where("fecha_inicio < DATE '2024-01-15'"), raw.where("fecha_inicio >= DATE '2024-01-10'")
    first.write.parquet(os.path.join(incoming, "part1"))
    args = (spark, incoming + "/*", t.org_unit, t.covid_claim, t.ministry_case, out, ckpt)
    start(*args).awaitTermination()
    second.write.parquet(os.path.join(incoming, "part2"))  # overlaps days 10..14: they are refreshed
    start(*args).awaitTermination()

    got = spark.read.parquet(out)
    both = first.unionByName(second)
    want = covid.covid_daily(visits.classify_visits(both, t.org_unit), t.covid_claim, t.ministry_case)
    cols = want.columns
    assert _rows(got.select(*cols)) == _rows(want.select(*cols))


def test_run_all_jobs(spark):
    t = DomainTables.of(spark, SMALL_SF)
    tables = jobs.Tables(*(getattr(t, n) for n in jobs.Tables.__dataclass_fields__))
    base = os.path.join(shared_dir(spark), f"jobs-{uuid.uuid4().hex[:8]}")
    out = jobs.run_all(spark, tables, os.path.join(base, "visit"), os.path.join(base, "shift_tool"), CHECK)
    assert out["covid_daily"].count() > 0 and out["demand_vs_capacity"].count() > 0
    sink = spark.read.parquet(os.path.join(base, "shift_tool"))
    assert sink.count() == out["shift_result"].count() > 0
    inline = covid.covid_daily(visits.classify_visits(t.visit_raw, t.org_unit, CHECK), t.covid_claim,
                               t.ministry_case, CHECK)
    assert _rows(out["covid_daily"].select(*inline.columns)) == _rows(inline)


def test_incremental_movement_detail_matches_batch(spark):
    t = DomainTables.of(spark, SMALL_SF)
    base = os.path.join(shared_dir(spark), f"stream-md-{uuid.uuid4().hex[:8]}")
    incoming, out, ckpt = (os.path.join(base, x) for x in ("incoming", "out", "ckpt"))
    raw = t.visit_raw
    raw.where("fecha_inicio < DATE '2024-01-20'").write.parquet(os.path.join(incoming, "a"))
    args = (spark, incoming + "/*", t.org_unit, t.covid_claim, t.ministry_case, out, ckpt,
            "movement_detail")
    start(*args).awaitTermination()
    raw.where("fecha_inicio >= DATE '2024-01-20'").write.parquet(os.path.join(incoming, "b"))
    start(*args).awaitTermination()
    want = covid.movement_detail(visits.classify_visits(raw, t.org_unit), t.covid_claim,
                                 t.ministry_case)
    got = spark.read.parquet(out).select(*want.columns)
    assert _rows(got) == _rows(want) and len(_rows(want)) > 0


def test_cluster_conf_sizes_partitions_from_input():
    from carecast.session import cluster_conf

    assert cluster_conf(1 << 40)["spark.sql.shuffle.partitions"] == str((1 << 40) // (256 << 20))
    assert cluster_conf(100 << 40)["spark.sql.shuffle.partitions"] == "50000"
    assert cluster_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf()["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_now_is_the_time_of_each_call_and_micro_batch(spark, monkeypatch):
    import datetime as dt

    from carecast import params

    class Clock(dt.datetime):
        at = dt.datetime(2024, 1, 12, 12)

        @classmethod
        def now(cls, tz=None):
            return cls.at

    monkeypatch.setattr(params.dt, "datetime", Clock)
    t = DomainTables.of(spark, SMALL_SF)
    early = visits.live_visits(t.visit_raw).count()
    base = os.path.join(shared_dir(spark), f"stream-clock-{uuid.uuid4().hex[:8]}")
    incoming, out, ckpt = (os.path.join(base, x) for x in ("incoming", "out", "ckpt"))
    t.visit_raw.where("fecha_inicio < DATE '2024-01-10'").write.parquet(os.path.join(incoming, "a"))
    query = start(spark, incoming + "/*", t.org_unit, t.covid_claim, t.ministry_case, out, ckpt, available_now=False)
    try:
        query.processAllAvailable()
        Clock.at = dt.datetime(2024, 1, 26, 12)  # the session and the stream outlive the day
        assert visits.live_visits(t.visit_raw).count() > early
        t.visit_raw.where("fecha_inicio >= DATE '2024-01-10'").write.parquet(os.path.join(incoming, "b"))
        refreshed = 0
        for _ in range(75):  # the stream looks for files each minute
            refreshed = spark.read.parquet(out).where("fecha_inicio > DATE '2024-01-12'").count()
            if refreshed:
                break
            time.sleep(1)
        assert refreshed
    finally:
        query.stop()


def domain(spark):
    t = DomainTables.of(spark, SMALL_SF)
    return jobs.Tables(*(getattr(t, n) for n in jobs.Tables.__dataclass_fields__))


def test_refreshed_days_equal_a_full_run_and_emptied_days_go(spark):
    tables = domain(spark)
    base = os.path.join(shared_dir(spark), f"refresh-{uuid.uuid4().hex[:8]}")
    path, again = os.path.join(base, "visit"), os.path.join(base, "again")
    jobs.classify_job(tables, path, CHECK)
    gone, cancelled, less, new = (dt.date(2024, 1, d) for d in (9, 10, 11, 12))
    raw = tables.visit_raw.where(f"fecha_inicio <> DATE '{gone}'")  # a day without visits, one all cancelled, one with fewer, one with more
    raw = raw.withColumn("ind_anulacion", F.when(F.col("fecha_inicio") == cancelled, "D").otherwise(F.col("ind_anulacion")))
    raw = raw.where(f"fecha_inicio <> DATE '{less}' OR episodio % 2 = 0")
    extra = raw.where(f"fecha_inicio = DATE '{new}'").withColumn("episodio", F.col("episodio") + 1_000_000)
    changed = jobs.Tables(**{**vars(tables), "visit_raw": raw.unionByName(extra).unionByName(extra)})
    days = spark.createDataFrame([(d,) for d in (gone, cancelled, less, new, new, None, dt.date(2030, 1, 1))], "fecha_inicio date")
    want = jobs.classify_job(changed, again, CHECK)
    for _ in range(2):  # a repeated refresh changes nothing
        got = jobs.refresh_visits(changed, path, days, CHECK)
        assert storage.names(spark, path) == storage.names(spark, again)
        assert f"fecha_inicio={gone}" not in storage.names(spark, path)
        assert _rows(got.select(*want.columns)) == _rows(want) and got.count() > 0


def test_a_day_emptied_in_the_stream_leaves_the_report(spark):
    from carecast.streaming.incremental import refresh_days

    t = DomainTables.of(spark, SMALL_SF)
    out = os.path.join(shared_dir(spark), f"emptied-{uuid.uuid4().hex[:8]}")
    args = (t.org_unit, t.covid_claim, t.ministry_case, out, "covid_daily", CHECK)
    refresh_days(t.visit_raw.select("fecha_inicio"), t.visit_raw, *args)
    day = spark.read.parquet(out).selectExpr("min(fecha_inicio) AS d").first()["d"]
    refresh_days(spark.createDataFrame([(day,)], "fecha_inicio date"), t.visit_raw.where(f"fecha_inicio <> DATE '{day}'"), *args)
    left = spark.read.parquet(out)
    assert left.where(f"fecha_inicio = DATE '{day}'").count() == 0 and left.count() > 0


def test_nothing_is_left_of_a_run(spark):
    base = os.path.join(shared_dir(spark), f"scope-{uuid.uuid4().hex[:8]}")
    before = storage.names(spark, shared_dir(spark))
    out = jobs.run_all(spark, domain(spark), f"{base}/visit", f"{base}/shift_tool", CHECK, f"{base}/results")
    assert storage.names(spark, shared_dir(spark)) == sorted([*before, os.path.basename(base)])
    assert all(df.count() > 0 for df in out.values()) and storage.names(spark, f"{base}/results") == sorted(out)


def test_a_failing_job_drops_its_intermediates(spark):
    before = storage.names(spark, shared_dir(spark))
    with pytest.raises(ValueError, match="stop"), job_scope(spark):
        held = materialize(spark.range(5), "held")
        with job_scope(spark):  # an inner job leaves its folders to the outer one
            inner = materialize(spark.range(7), "inner")
        assert (held.count(), inner.count()) == (5, 7) and len(storage.names(spark, shared_dir(spark))) == len(before) + 2
        raise ValueError("stop")
    assert storage.names(spark, shared_dir(spark)) == before
    assert materialize(spark.range(3), "unscoped").count() == 3


def test_append_is_all_or_nothing(spark):
    path = os.path.join(shared_dir(spark), f"sink-{uuid.uuid4().hex[:8]}")
    rows = spark.range(0, 1000, 1, 8).selectExpr("CAST(id AS STRING) AS centro", "id * 1.5D AS tdv3")
    shift.append_shift_tool(rows, path)
    shift.append_shift_tool(rows.toDF("other", "names"), path)  # by position, not idempotent
    assert spark.read.parquet(path).count() == 2000 and spark.read.parquet(path).columns == ["centro", "tdv3"]
    files = storage.names(spark, path)
    failing = rows.withColumn("tdv3", F.expr("CASE WHEN centro = '777' THEN raise_error('bad row') ELSE tdv3 END"))
    with pytest.raises(Exception, match="bad row"):
        shift.append_shift_tool(failing, path)
    with pytest.raises(ValueError, match="sink has columns"):
        shift.append_shift_tool(rows.select("centro"), path)
    assert storage.names(spark, path) == files and spark.read.parquet(path).count() == 2000
