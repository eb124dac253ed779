"""Domain tables loaded from paths, other formats and catalog names, with schema checks."""

import os
import uuid

import pytest

from carecast.plans import jobs
from carecast.registry import round_doubles
from carecast.session import shared_dir
from carecast.sources import catalog
from carecast.sources.adapters import DomainTables
from tests.conftest import SMALL_SF


def test_load_tables_from_mixed_locations(spark):
    t = DomainTables.of(spark, SMALL_SF)
    base = os.path.join(shared_dir(spark), f"catalog-{uuid.uuid4().hex[:8]}")
    locations = {}
    for name in ["visit_raw", "org_unit", "covid_claim", "ministry_case", "queue_log", "calendar",
                 "capacity"]:
        path = os.path.join(base, name)
        getattr(t, name).write.parquet(path)
        locations[name] = path
    t.party.write.option("header", "true").csv(os.path.join(base, "party"))
    locations["party"] = "csv:" + os.path.join(base, "party")
    t.capacity.createOrReplaceTempView("capacity_elsewhere")
    locations["capacity"] = "capacity_elsewhere"
    hours = os.path.join(base, "hours")
    t.opening_hours_wide.write.parquet(hours)

    tables = catalog.load_tables(spark, locations, hours)
    got = jobs.covid_daily_job(jobs.classify_job(tables, os.path.join(base, "visit")), tables)
    want = jobs.covid_daily_job(
        jobs.classify_job(jobs.Tables(*(getattr(t, n) for n in jobs.Tables.__dataclass_fields__)),
                          os.path.join(base, "visit2")), tables)
    rows = lambda df: sorted(tuple(r) for r in round_doubles(df.select(*sorted(df.columns))).collect())
    assert rows(got) == rows(want) and len(rows(got)) > 0
    demand = jobs.demand_job(spark.read.parquet(os.path.join(base, "visit")), tables)
    assert demand.count() > 0


def test_schema_mismatch_is_reported(spark):
    bad = spark.createDataFrame([("x", "y")], "rut string, numero_bp string")
    with pytest.raises(ValueError, match="numero_bp"):
        from carecast.sources import schemas
        schemas.check(bad, schemas.PARTY)
