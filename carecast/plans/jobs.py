"""The four source scripts as cluster jobs.

The source persists the classified visits as a permanent table that the
other three scripts read; ``classify_job`` writes it once, partitioned by
visit date (a REBALANCE hint lets AQE even out file sizes per day), and
the demand jobs read it back, so their date filters prune partitions.
Intermediate results that several stages reuse are written under the
cluster's ``spark.checkpoint.dir`` (lineage cut, survives executor loss) and
dropped when the whole run has written its results, or has failed.

``refresh_visits`` keeps the visit table up to date by days: DISTINCT and all
attributes look at one day's rows only, so the changed days are classified anew
and their partitions replaced.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import storage
from ..operators.joins import written_claim_keys
from ..params import Params, now_unless_given
from ..session import job_scope, shared_dir
from ..sources import schemas
from . import covid, demand, shift, visits


@dataclass
class Tables:
    """Domain tables of one run (any DataFrames: catalog tables, parquet paths, adapters).

    Text may be spelled in any way the source's collation holds equal: the jobs
    fold what ``sources.catalog.load_tables`` hasn't folded yet.
    """

    visit_raw: DataFrame
    org_unit: DataFrame
    covid_claim: DataFrame
    ministry_case: DataFrame
    party: DataFrame
    queue_log: DataFrame
    calendar: DataFrame
    capacity: DataFrame
    opening_hours_wide: DataFrame


@now_unless_given
def classify_job(tables: Tables, path: str, params: Params | None = None) -> DataFrame:
    """Write the classified visit table to ``path`` (partitioned by day) and return it."""
    v = visits.classify_visits(tables.visit_raw, tables.org_unit, params)
    (v.hint("rebalance", "fecha_inicio")
     .write.mode("overwrite").partitionBy("fecha_inicio").parquet(path))
    return v.sparkSession.read.parquet(path)


def overwrite_days(df: DataFrame, days: DataFrame, path: str) -> None:
    """Replace the partitions of ``days`` (fecha_inicio) of the table at ``path`` by the rows of ``df``, which has no other days.

    Dynamic partition overwrite replaces the days that have rows; a day that has
    none any more loses its partition. Running it again changes nothing. Only
    the emptied days, at most the days asked for, reach the driver.
    """
    (df.hint("rebalance", "fecha_inicio").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("fecha_inicio").parquet(path))
    emptied = days.join(df.select("fecha_inicio").distinct(), "fecha_inicio", "left_anti")
    storage.drop_partitions(df.sparkSession, path, "fecha_inicio", [r["fecha_inicio"].isoformat() for r in emptied.collect()])


def changed_days(days: DataFrame) -> DataFrame:
    """Distinct dates of the column ``fecha_inicio``."""
    return days.selectExpr("CAST(fecha_inicio AS DATE) AS fecha_inicio").where("fecha_inicio IS NOT NULL").distinct()


@now_unless_given
def refresh_visits(tables: Tables, path: str, days: DataFrame, params: Params | None = None) -> DataFrame:
    """Classify the visits of ``days`` anew, replace these days in the visit table at ``path``, return the table."""
    days = changed_days(days)
    touched = tables.visit_raw.join(days, "fecha_inicio", "left_semi")
    overwrite_days(visits.classify_visits(touched, tables.org_unit, params), days, path)
    return days.sparkSession.read.parquet(path)


@now_unless_given
def movement_detail_job(visit: DataFrame, tables: Tables, params: Params | None = None, keys: DataFrame | None = None) -> DataFrame:
    return covid.movement_detail(visit, tables.covid_claim, tables.ministry_case, params, keys)


@now_unless_given
def covid_daily_job(visit: DataFrame, tables: Tables, params: Params | None = None, keys: DataFrame | None = None) -> DataFrame:
    return covid.covid_daily(visit, tables.covid_claim, tables.ministry_case, params, keys)


@now_unless_given
def demand_job(visit: DataFrame, tables: Tables, params: Params | None = None) -> DataFrame:
    return demand.demand_vs_capacity(tables.queue_log, tables.party, visit, tables.capacity, params)


@now_unless_given
def shift_job(visit: DataFrame, tables: Tables, sink_path: str | None = None,
              params: Params | None = None) -> dict[str, DataFrame]:
    """Half-hour model. Returns the two result sets of the source (``demand``:
    slot demand, ``deviation``: slot std devs) and the combined ``result``;
    appends ``result`` to the shift-tool table when ``sink_path`` is given.
    All three are columns of the slot statistics, which one pass over the grid
    computes and writes; the folder stays until the scope of the run ends, if it has one.
    """
    st = shift.shift_stages(visit, tables.queue_log, tables.party, tables.calendar,
                            tables.opening_hours_wide, params, persist=True)
    if sink_path:
        shift.append_shift_tool(st["result"], sink_path)
    return {"demand": st["hourly"], "deviation": st["stddev"], "result": st["result"]}


#: The result columns that the organisation table spells, and its column for each.
WRITTEN_AS = {"territorio": "territorio_m", "agencia": "agencia_m", "centro": "centro_m"}


@now_unless_given
def run_all(spark: SparkSession, tables: Tables, visit_path: str, sink_path: str | None = None,
            params: Params | None = None, results_path: str | None = None) -> dict[str, DataFrame]:
    """Classify once, then every report over the written visit table.

    Each result is written to ``results_path``/its name (default: a new folder in
    the shared one, which is the caller's) and read from there, its places spelled as
    the organisation table does where that wasn't folded at load; then all intermediates are dropped.
    """
    results = results_path or os.path.join(shared_dir(spark), f"results-{uuid.uuid4().hex[:12]}")
    with job_scope(spark):
        visit = classify_job(tables, visit_path, params)
        keys = written_claim_keys(tables.covid_claim, tables.ministry_case, params.dedupe_claims)
        out = {
            "movement_detail": movement_detail_job(visit, tables, params, keys),
            "covid_daily": covid_daily_job(visit, tables, params, keys),
            "demand_vs_capacity": demand_job(visit, tables, params),
        }
        out.update({f"shift_{k}": v for k, v in shift_job(visit, tables, sink_path, params).items()})
        names = schemas.spellings(tables.org_unit, list(WRITTEN_AS.values()))
        for name, df in out.items():
            shown = schemas.respelled(df, names, {c: s for c, s in WRITTEN_AS.items() if c in df.columns})
            shown.write.mode("overwrite").parquet(os.path.join(results, name))
    stored = {name: spark.read.parquet(os.path.join(results, name)) for name in out}
    return stored | {"demand_vs_capacity": stored["demand_vs_capacity"].orderBy(*demand.ORDER)}
