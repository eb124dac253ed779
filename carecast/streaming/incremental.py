"""Incremental refresh of the daily reports as visit files arrive.

The source workload is batch only; this runs the same batch plans from a
Structured Streaming file source. Each micro-batch only says *which days*
changed: the daily totals of a (centre, day) depend on that day's visits
alone, so the batch re-runs the classification and the report for those
days from the full visit table and replaces just their partitions; a day
that has no visits left loses its partition. Replaying a micro-batch after a
failure rewrites the same partitions, so the sink stays exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..params import Params, now_unless_given
from ..plans import covid, visits
from ..plans.jobs import changed_days, overwrite_days
from ..session import job_scope
from ..sources import schemas

Report = Callable[[DataFrame, DataFrame, DataFrame, DataFrame, Params], DataFrame]

REPORTS: dict[str, Report] = {
    "covid_daily": lambda v, org, cc, mc, p: covid.covid_daily(visits.classify_visits(v, org, p), cc, mc, p),
    "movement_detail": lambda v, org, cc, mc, p: covid.movement_detail(
        visits.classify_visits(v, org, p), cc, mc, p),
}


@now_unless_given
def refresh_days(days: DataFrame, visit_raw: DataFrame, org_unit: DataFrame, covid_claim: DataFrame,
                 ministry_case: DataFrame, out_path: str, report: str = "covid_daily",
                 params: Params | None = None) -> None:
    """Recompute ``report`` for the dates in ``days`` and overwrite their partitions."""
    days = changed_days(days)
    with job_scope(days.sparkSession):
        touched = visit_raw.join(days, "fecha_inicio", "left_semi")
        overwrite_days(REPORTS[report](touched, org_unit, covid_claim, ministry_case, params), days, out_path)


def start(spark: SparkSession, incoming_dir: str, org_unit: DataFrame, covid_claim: DataFrame,
          ministry_case: DataFrame, out_path: str, checkpoint: str,
          report: str = "covid_daily", params: Params | None = None,
          visit_raw: Callable[[], DataFrame] | None = None,
          available_now: bool = True) -> StreamingQuery:
    """Watch ``incoming_dir`` for new visit_raw parquet files and refresh ``report``.

    ``visit_raw`` loads the full visit table (default: every file under
    ``incoming_dir``); it is called per micro-batch so new files are listed.
    Without ``params``, "now" is the time of each micro-batch.
    """
    arrivals = spark.readStream.schema(schemas.plain(schemas.VISIT_RAW)).parquet(incoming_dir)
    load = visit_raw or (lambda: spark.read.schema(schemas.plain(schemas.VISIT_RAW)).parquet(incoming_dir))

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        refresh_days(batch, load(), org_unit, covid_claim, ministry_case, out_path, report, params)

    w = arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
