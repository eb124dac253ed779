"""String comparison and concatenation with the source dialect's rules.

The source compares text case-insensitively (its labels differ in case
from the data: 'PreIngreso EP' vs 'Preingreso EP') and ignores trailing
blanks. Both sides are folded with ``lower(rtrim(..))``; accents stay
significant.

Functions here build Spark SQL expression text from column names (or
other expression text); ``col`` turns it into a Column with one JVM call,
which keeps plan construction cheap for long CASE chains.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit(value) -> str:
    """A SQL literal for a Python str / int / float / None."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def num(value: float) -> str:
    """A numeric literal: integers as such, fractions as DOUBLE (``20.6D``)."""
    return str(int(value)) if float(value).is_integer() else f"{float(value)!r}D"


def col(expr: str) -> Column:
    return F.expr(expr)


def fold(c: str) -> str:
    return f"lower(rtrim({c}))"


def _fold_literal(value: str) -> str:
    return lit(value.rstrip(" ").lower())


def key(c: str) -> str:
    """One spelling for all that the source's collation holds equal: capitals, no trailing blanks."""
    return f"upper(rtrim({c}))"


def listed(c: str, values: Iterable[str]) -> str:
    """A label in the spelling of ``values``; one that isn't among them in the spelling of ``key``."""
    known = "map(" + ", ".join(f"{_fold_literal(v)}, {lit(v)}" for v in values) + ")"
    return f"coalesce(try_element_at({known}, {fold(c)}), {key(c)})"


def ci_eq(c: str, value: str) -> str:
    return f"({fold(c)} = {_fold_literal(value)})"


def ci_in(c: str, values: Iterable[str]) -> str:
    return f"({fold(c)} IN ({', '.join(_fold_literal(v) for v in values)}))"


def ci_not_in(c: str, values: Iterable[str]) -> str:
    """SQL ``NOT IN``: NULL input is neither in nor out, so a filter drops it."""
    return f"(NOT {ci_in(c, values)})"


def ci_contains(c: str, pattern: str) -> str:
    """``c LIKE '%pattern%'`` under a case-insensitive collation."""
    return f"contains({fold(c)}, {_fold_literal(pattern)})"


def null_safe_concat(*parts: str) -> str:
    """Concatenation where NULL parts count as '' (never NULL). Parts are SQL text."""
    return "concat(" + ", ".join(f"coalesce(CAST({p} AS STRING), '')" for p in parts) + ")"


def case(arms: Iterable[tuple[str, str]], otherwise: str | None = None) -> str:
    """``CASE WHEN cond THEN value ... [ELSE otherwise] END`` from SQL text pairs."""
    body = " ".join(f"WHEN {c} THEN {v}" for c, v in arms)
    tail = f" ELSE {otherwise}" if otherwise is not None else ""
    return f"CASE {body}{tail} END"
