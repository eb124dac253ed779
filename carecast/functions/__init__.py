"""Column-level functions as Spark SQL expression text (built-ins only, no UDFs).

Each function takes column names / expression text and returns
expression text; ``col(expr)`` (or ``selectExpr``) turns it into a
Column. Building text and crossing into the JVM once per expression
keeps plan construction cheap for the long CASE chains of the rules.
"""

from .calendar import (
    add_minutes, date_literal, half_hour, month_name, slot_label, ts_literal, week_number,
    weekday_label, weekday_name, weekday_num, year_month, year_week,
)
from .claims import (
    box_count, claim_cond, claim_number, class_count, classify_movement, decode_claim_type,
    flag_label, measure_flags, synthetic_end_time, time_type,
)
from .text import case, ci_contains, ci_eq, ci_in, ci_not_in, col, fold, key, listed, lit, null_safe_concat, num

__all__ = [
    "add_minutes", "date_literal", "half_hour", "month_name", "slot_label", "ts_literal",
    "week_number", "weekday_label", "weekday_name", "weekday_num", "year_month", "year_week",
    "box_count", "claim_cond", "claim_number", "class_count", "classify_movement",
    "decode_claim_type", "flag_label", "measure_flags", "synthetic_end_time", "time_type",
    "case", "ci_contains", "ci_eq", "ci_in", "ci_not_in", "col", "fold", "key", "listed", "lit", "null_safe_concat", "num",
]
