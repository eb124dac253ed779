"""Join building blocks.

Broadcast policy: no side is broadcast by hint. The planner checks each
join side against ``spark.sql.autoBroadcastJoinThreshold`` using plan
statistics (file sizes after pruning), so dimensions read from small
tables broadcast up front; sides whose size is only known at runtime
(aggregates of large tables) start as shuffle joins and AQE re-checks
them with the actual shuffle sizes (``spark.sql.adaptive.
autoBroadcastJoinThreshold``), switching to a broadcast only when they
are small and splitting skewed partitions otherwise. Every broadcast is
therefore size-checked by Spark, with the shuffle join as the fallback.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.claims import claim_number
from ..session import materialize


def ministry_keys(ministry_case: DataFrame) -> DataFrame:
    """Distinct ministry claim ids (existence flag, no fan-out)."""
    return ministry_case.selectExpr("id_siniestro AS minsal_key").distinct()


def claim_keys(covid_claim: DataFrame, ministry_case: DataFrame, dedupe: bool = False) -> DataFrame:
    """One row per claim number of either list: ``covid_n`` covid claim rows, ``minsal`` 1 if the ministry has it.

    The source joins every covid claim row (a repeated claim number multiplies
    the visit); keeping the multiplicity as a count gives the same totals
    without materialising the duplicates. ``dedupe`` counts each once. Both
    lists go through one aggregation, which combines a hot number map-side.
    """
    covid = covid_claim.selectExpr(f"{claim_number('siniestro_covid19')} AS clave", "CAST(1 AS BIGINT) AS covid_n", "0 AS minsal")
    cases = ministry_case.selectExpr("id_siniestro AS clave", "CAST(0 AS BIGINT) AS covid_n", "1 AS minsal")
    rows = covid.unionByName(cases).where("clave IS NOT NULL")
    return rows.groupBy("clave").agg((F.max if dedupe else F.sum)("covid_n").alias("covid_n"), F.max("minsal").alias("minsal"))


def written_claim_keys(covid_claim: DataFrame, ministry_case: DataFrame, dedupe: bool = False) -> DataFrame:
    """``claim_keys`` as a written table, which the reports of one run share."""
    return materialize(claim_keys(covid_claim, ministry_case, dedupe), "claim-keys")


def with_claim_flags(visit: DataFrame, keys: DataFrame) -> DataFrame:
    """Add ``covid_flag`` and ``minsal_flag`` (0/1) and the row weight ``w``.

    ``w`` is how many rows the visit contributes after the covid join
    (1 without a match, the number of matching claim rows otherwise).
    ``keys`` comes from ``written_claim_keys``. The join's right side is then a
    plain scan: the planner knows its size, and beyond the broadcast threshold
    AQE can cut a claim number (or NULL) that holds many visits into several
    tasks, which it doesn't do where the right side is an aggregate on the join key.
    """
    out = visit.join(keys, visit.siniestro == keys.clave, "left")
    return out.selectExpr(
        *visit.columns,
        "CAST(coalesce(covid_n, 0) > 0 AS INT) AS covid_flag",
        "coalesce(minsal, 0) AS minsal_flag",
        "greatest(coalesce(covid_n, CAST(1 AS BIGINT)), CAST(1 AS BIGINT)) AS w",
    )
