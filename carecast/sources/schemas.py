"""Domain table schemas (snake_case ASCII names) and a metadata-only check.

The source workload has no DDL; these are reconstructed from column use.
``conform`` casts a frame to its schema and ``check`` validates names and
types without running a job.

The source compares text by a collation that ignores case and trailing
blanks, in joins, GROUP BY and DISTINCT too. Its text columns are declared
``TEXT`` here, a collated string type, and everything else follows from the
declaration: ``fold_keys`` replaces each such column of a table by its collation
key, a plain string that is equal where the collation holds values equal, so
plain equality does the same everywhere after it. Keys carry a mark in their
column metadata (kept by selects, groups and Parquet), so jobs and operators
fold what they are given and what is folded already costs nothing.

Columns aren't left collated in the jobs: Spark groups collated strings by
sorting whole rows instead of hashing (3 to 6 times slower measured), reads no
filter on them into the scan, and refuses them as bucket columns.

Spelling for display is kept apart: ``spellings`` lists how a table writes each
key (the smallest in byte order, as the collation leaves the choice open), and
``respelled`` puts it back into a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules
from ..functions.text import key, listed

S, L, I, D, DT, TS = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.TimestampNTZType()
)
#: Text as the source compares it: case and trailing blanks don't count, accents do.
TEXT = T.StringType("UTF8_LCASE_RTRIM")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


VISIT_RAW = _struct(
    ("episodio", L), ("bp_paciente", L), ("fecha_inicio", DT), ("hora_inicio", TS),
    ("cl_mov_desc", TEXT), ("tipo_siniestro_orig", I), ("uo_tratamiento", TEXT),
    ("ind_anulacion", TEXT), ("siniestro", L),
)
ORG_UNIT = _struct(
    ("uo_tratamiento", TEXT), ("uo_medica", TEXT), ("territorio_m", TEXT), ("agencia_m", TEXT), ("centro_m", TEXT),
)
COVID_CLAIM = _struct(("siniestro_covid19", TEXT))
MINISTRY_CASE = _struct(("id_siniestro", L))
PARTY = _struct(("rut", TEXT), ("numero_bp", L))
QUEUE_LOG = _struct(
    ("centro", TEXT), ("rut_paciente", TEXT), ("ticket", L), ("fecha", DT), ("hora_inicia", TS),
    ("hora_fin", TS), ("cargo", TEXT), ("estado", TEXT), ("minutos", D), ("hr_inicio", TS),
    ("fila", TEXT), ("validacion", I), ("tipo_atencion", TEXT), ("descripcion_tipo", TEXT),
)
CALENDAR = _struct(("fecha", DT))
CAPACITY = _struct(("centro", TEXT), ("cargo", TEXT), ("estado", TEXT), ("fte", D))
# opening_hours_wide: diasem, mediahora, then one int column per centre.
OPENING_HOURS_KEYS = _struct(("diasem", TEXT), ("mediahora", TEXT))

# Derived visit table (visit classification output), in column order.
VISIT = _struct(
    *[(f.name, f.dataType) for f in VISIT_RAW.fields],  # labels made by the rules are plain strings
    ("mes", I), ("nmes", S), ("anno", I), ("dia", I), ("hora", I), ("media_hora", S),
    ("dia_semana", S), ("numero_semana", I), ("tipo_siniestro_origen", S), ("clasif", S),
    ("dia_semana_esp", S), ("dia_semana_num", I), ("anno_mes", S),
    ("territorio", TEXT), ("agencia", TEXT), ("centro", TEXT), ("uo_medica", TEXT),
)

SHIFT_TOOL = _struct(
    ("centro", S), ("diasem", S), ("mediahora", S), ("tdv3", D), ("tca3", D), ("qdv3", D),
    ("qca3", D), ("devest_variable", D), ("devest_controles", D), ("lapse", S),
)

DOMAIN = {
    "visit_raw": VISIT_RAW, "org_unit": ORG_UNIT, "covid_claim": COVID_CLAIM,
    "ministry_case": MINISTRY_CASE, "party": PARTY, "queue_log": QUEUE_LOG,
    "calendar": CALENDAR, "capacity": CAPACITY,
}


#: Every collated column, in whatever table it occurs.
TEXT_COLUMNS = {f.name for schema in [*DOMAIN.values(), OPENING_HOURS_KEYS, VISIT] for f in schema.fields if f.dataType == TEXT}
#: Labels of a known list: their keys are the list's spellings. Other keys are in capitals.
LISTED_COLUMNS = {"cl_mov_desc": list(rules.MOVEMENT_CLASS), "diasem": rules.WEEKDAY_ES, "estado": [*rules.BOX_STATES, rules.APPROVED],
                  "cargo": [rules.STAFF_ROLE], "fila": rules.QUEUE_ROWS, "descripcion_tipo": [rules.TIMED_DESCRIPTION]}
#: In a column's metadata: its values are collation keys.
MARK = "collation_key"


def collation_key(name: str) -> str:
    """The key of a collated column, as SQL text."""
    plain = f"CAST(`{name}` AS STRING COLLATE UTF8_BINARY)"
    return listed(plain, LISTED_COLUMNS[name]) if name in LISTED_COLUMNS else key(plain)


def _is_text(f: T.StructField) -> bool:
    """Whether a column is text the source compares by its collation, by declaration here or by its own type."""
    return isinstance(f.dataType, T.StringType) and (f.name in TEXT_COLUMNS or f.dataType.collation != "UTF8_BINARY")


def fold_keys(df: DataFrame) -> DataFrame:
    """``df`` with collation keys in its text columns; those that are keys already stay as they are."""
    open_ = {f.name for f in df.schema.fields if _is_text(f) and not f.metadata.get(MARK)}
    if not open_:
        return df

    def column(name: str) -> Column:
        return F.expr(collation_key(name)).alias(name, metadata={MARK: True}) if name in open_ else F.col(f"`{name}`")

    return df.select(*[column(c) for c in df.columns])


#: A stored table's second bucket level, which spreads the rows of a hot key (``catalog.write_bucketed``).
SALT = "_sal"


def salt_of(df: DataFrame) -> list[str]:
    """The salt column, if the table has one: kept among the group keys, it saves the exchange."""
    return [SALT] if SALT in df.columns else []


def plain(schema: T.StructType) -> T.StructType:
    """``schema`` with plain strings, for readers of files that know no collations."""
    return T.StructType([T.StructField(f.name, S if f.dataType == TEXT else f.dataType, f.nullable) for f in schema.fields])


def spellings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """columna, clave, escrito: how ``df``, not folded, writes each key of these columns (its smallest spelling)."""
    each = [df.selectExpr(f"'{c}' AS columna", f"{collation_key(c)} AS clave", f"CAST(`{c}` AS STRING COLLATE UTF8_BINARY) AS escrito") for c in columns]
    return (reduce(DataFrame.unionAll, each).where("clave IS NOT NULL")
            .groupBy("columna", "clave").agg(F.min("escrito").alias("escrito")))


def respelled(df: DataFrame, written: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with keys written as in ``written``; ``columns``: result column -> the column of ``spellings`` it comes from.

    A key that the table of spellings lacks stays as it is.
    """
    out = df
    for name, source in columns.items():
        names = written.where(F.col("columna") == source).select(F.col("clave").alias("_clave"), F.col("escrito").alias("_escrito"))
        joined = out.join(names, out[name] == names["_clave"], "left")
        out = joined.select(*[F.coalesce("_escrito", F.col(f"`{c}`")).alias(c) if c == name else F.col(f"`{c}`") for c in df.columns])
    return out


def fold_centres(hours_wide: DataFrame) -> DataFrame:
    """The wide opening hours with weekdays folded, and the centres, which are column names."""
    keys = OPENING_HOURS_KEYS.fieldNames()
    return fold_keys(hours_wide).toDF(*[c if c in keys else c.rstrip(" ").upper() for c in hours_wide.columns])


def _fits(have: T.DataType | None, want: T.DataType) -> bool:
    return isinstance(have, T.StringType) if want == TEXT else have == want


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types, text as collation keys."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return fold_keys(df.select(*[
        F.col(f.name) if _fits(have.get(f.name), f.dataType) else F.col(f.name).cast(S if f.dataType == TEXT else f.dataType)
        for f in schema.fields
    ]))


def check(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Raise if ``df`` lacks a column of ``schema`` or has another type (text may be collated or plain)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = [
        f"{f.name}: expected {f.dataType.simpleString()}, got "
        f"{have[f.name].simpleString() if f.name in have else 'missing'}"
        for f in schema.fields
        if not _fits(have.get(f.name), f.dataType)
    ]
    if problems:
        raise ValueError("schema mismatch: " + "; ".join(problems))
    return df
