"""Lookups over movement codes, claim types and flags (CASE expressions).

Rule tables live in ``rules``; each lookup becomes one CASE expression,
evaluated inside whole-stage codegen. Arguments and results are Spark
SQL expression text.
"""

from __future__ import annotations

from .. import rules
from .calendar import add_minutes
from .text import case, ci_eq, ci_in, fold, lit


def claim_cond(claim_type: str, cond: str | None) -> str:
    """Claim condition of a rule: None (any), "ep" (occupational) or "not_ep"."""
    if cond is None:
        return "TRUE"
    is_ep = ci_eq(claim_type, rules.OCCUPATIONAL)
    return is_ep if cond == "ep" else f"(NOT {is_ep})"


def _literal_map(pairs) -> str:
    return "map(" + ", ".join(f"{k}, {v}" for k, v in pairs) + ")"


def classify_movement(code: str, table: dict[str, str] = rules.MOVEMENT_CLASS) -> str:
    """Movement code -> visit class; unknown or NULL codes -> 'Otros'.

    One lookup in a constant map keyed by the folded code (the CASE chain
    of the source, as a hash lookup with a small generated body).
    """
    m = _literal_map((lit(src.rstrip(" ").lower()), lit(cls)) for src, cls in table.items())
    return f"coalesce(try_element_at({m}, {fold(code)}), {lit(rules.OTHER)})"


def decode_claim_type(code: str) -> str:
    m = _literal_map((str(k), lit(v)) for k, v in rules.CLAIM_TYPE.items())
    return f"coalesce(try_element_at({m}, CAST({code} AS INT)), {lit(rules.OTHER)})"


def time_type(code: str, claim_type: str) -> str:
    """Movement code + claim type -> service-time label; first rule wins."""
    return case(
        ((f"{ci_in(code, codes)} AND {claim_cond(claim_type, cond)}", lit(label))
         for codes, cond, label in rules.TIME_TYPE_RULES),
        lit(rules.OTHER),
    )


def flag_label(covid: str, ministry: str) -> str:
    return case(
        ((f"{covid} = {cv} AND {ministry} = {mn}", lit(label))
         for (cv, mn), label in rules.FLAG_LABELS.items()),
        lit(rules.FLAG_LABELS[(0, 0)]),
    )


def claim_number(code: str) -> str:
    """Numeric part of a prefixed claim code ('C123' -> 123).

    An empty remainder reads as 0, like the source dialect's cast of ''.
    Non-numeric text still raises under ANSI casting.
    """
    rest = f"trim(substring(rtrim({code}), 2))"
    return f"CASE WHEN {rest} = '' THEN CAST(0 AS BIGINT) ELSE CAST({rest} AS BIGINT) END"


def measure_flags(clasif: str, claim_type: str, rule_set: str = "narrow") -> dict[str, str]:
    """0/1 indicator per movement measure for one visit row.

    ``rule_set`` is "narrow" (telemedicine and phone visits fall in
    'otros') or "wide" (they fold into ingreso / control agendado).
    """
    table = rules.NARROW_MEASURES if rule_set == "narrow" else rules.WIDE_MEASURES
    out: dict[str, str] = {}
    listed: list[str] = []
    for name, (classes, cond) in table.items():
        out[name] = f"CASE WHEN {ci_in(clasif, classes)} AND {claim_cond(claim_type, cond)} THEN 1 ELSE 0 END"
        listed.extend(classes)
    # NOT IN over a NULL class is unknown -> 0, as in the source.
    out["otros"] = f"CASE WHEN NOT {ci_in(clasif, listed)} THEN 1 ELSE 0 END"
    return {k: out[k] for k in rules.MEASURE_ORDER}


def synthetic_end_time(start: str, clasif: str, claim_type: str) -> str:
    """Estimated end of an attention from its class (no match -> NULL)."""
    return case(
        (f"{ci_eq(clasif, cls)} AND {claim_cond(claim_type, cond)}", add_minutes(start, minutes))
        for cls, cond, minutes in rules.SYNTHETIC_MINUTES
    )


def box_count(state: str, clasif: str, claim_type: str, cls: str, cond: str | None, n: str) -> str:
    """``n`` when the ticket row is in a box state and matches the class, else 0."""
    return (f"CASE WHEN {ci_in(state, rules.BOX_STATES)} AND {ci_eq(clasif, cls)} "
            f"AND {claim_cond(claim_type, cond)} THEN {n} ELSE CAST(0 AS BIGINT) END")


def class_count(clasif: str, claim_type: str, cls: str, cond: str | None, n: str) -> str:
    return (f"CASE WHEN {ci_eq(clasif, cls)} AND {claim_cond(claim_type, cond)} "
            f"THEN {n} ELSE CAST(0 AS BIGINT) END")
