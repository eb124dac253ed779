"""carecast: care demand and capacity analytics as Spark DataFrame jobs.

Layout:
  functions/  Column expressions (calendar, text folding, rule lookups)
  sources/    table loading, schemas, adapters from the driver tables, sinks
  operators/  reusable DataFrame -> DataFrame steps (joins, measures, slots, stats)
  plans/      the five end-to-end jobs
  streaming/  incremental (micro-batch) runner for the daily reports
"""

from .params import Params

__all__ = ["Params"]
