"""Domain-shaped tables derived from the driver's parquet tables.

The source workload reads hospital tables that are not available; these
adapters derive tables of the same shape from the driver data so every
job reads real rows whose volume grows with the scale factor:

=================== ============================================================
visit_raw           events: one visit per event, every 29th twice (movement code,
                    claim type, treating unit and cancel flag follow from the ids;
                    some movements and claim numbers are NULL)
org_unit            nation x region: one treating unit per nation
covid_claim         customers whose key is a multiple of 7, coded 'C<key>', some twice
ministry_case       orders of customers whose key is a multiple of 3
party               customers: rut 'R<key>' -> business partner <key>, some twice
queue_log           events of users in centres 1, 2, 3, 5, 7 (one unit of centre 1 and
                    of 2 are centres that the demand model leaves out); some minutes NULL
calendar            distinct event dates
capacity            all nations, dealt to ten centres, with staffed FTE
opening_hours_wide  distinct (weekday, half hour) of events, Monday..Saturday,
                    one column per centre C_0..C_9
=================== ============================================================

The rules are deterministic so the DuckDB oracle spells the same tables.
Some rows spell their text in small letters or capitals with trailing blanks,
which ``schemas.conform`` folds as a load does; ``written_org_unit`` and
``written_queue_log`` are the tables before that.

Size bounds: ``nation`` and ``region`` have 25 and 5 rows at every scale
factor (fixed by the TPC-H schema), so ``org_unit`` and ``capacity``
have 25 rows; ``opening_hours_wide`` has at most 6 x 48 rows.
Whether any of them is broadcast is left to the planner and its size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import rules
from ..functions.calendar import slot_label, weekday_num
from ..functions.text import lit
from . import schemas

# ---------------------------------------------------------------- FIXED VALUES
# Adapter constants (test-data derivation, not part of the source workload).
MOVEMENT_CODES = list(rules.MOVEMENT_CLASS) + ["X"]  # 12 known codes, then an unknown one
UNIT_CODES = ["PECMAPRI", "XMAPRI1", "xmapri2", "MAPRI_3", "OTHER"]
QUEUE_CENTRES = [1, 2, 3, 5, 7]
QUEUE_ROWS = ["A", "B", "M", "Z"]
EXCLUDED_CENTRE, PATTERN_CENTRE = "CAA", "Anexo Sel Norte"
N_UNITS = 25
N_CENTRES = 10
# ------------------------------------------------------------ END FIXED VALUES

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list, index: str) -> str:
    """values[index] for a 0-based integer index expression."""
    return f"element_at(array({', '.join(lit(v) for v in values)}), CAST({index} AS INT) + 1)"


def _respelled(value: str, where: str) -> str:
    """The same key for the source's collation: small letters and trailing blanks in some rows."""
    return f"CASE WHEN {where} THEN concat(lower({value}), '  ') ELSE {value} END"


def _twice(df: DataFrame, where: str) -> DataFrame:
    """``df`` with a second copy of the rows that ``where`` picks."""
    return df.selectExpr("*", f"explode(sequence(1, CASE WHEN {where} THEN 2 ELSE 1 END)) AS copia").drop("copia")


def _centre(unit: str) -> str:
    """The centre of a treating unit's number: units 21 and 22 belong to centres that are left out by name and by pattern."""
    return (f"CASE {unit} WHEN 21 THEN {lit(EXCLUDED_CENTRE)} WHEN 22 THEN {lit(PATTERN_CENTRE)} "
            f"ELSE concat('C_', CAST({unit} % {N_CENTRES} AS STRING)) END")


def visit_raw(events: DataFrame) -> DataFrame:
    n = len(MOVEMENT_CODES)
    df = _twice(events, "event_id % 29 = 0").selectExpr(
        "event_id AS episodio",
        "user_id AS bp_paciente",
        "CAST(ts AS DATE) AS fecha_inicio",
        "ts AS hora_inicio",
        f"CASE WHEN event_id % 31 <> 0 THEN {_respelled(_pick(MOVEMENT_CODES, f'event_id % {n}'), 'event_id % 7 = 3')} END AS cl_mov_desc",
        f"CAST((event_id div {n}) % 6 AS INT) AS tipo_siniestro_orig",
        _respelled(f"concat('UO_', CAST(user_id % {N_UNITS} AS STRING))", "event_id % 5 = 1") + " AS uo_tratamiento",
        "CASE event_id % 17 WHEN 0 THEN 'D' WHEN 1 THEN 'X' WHEN 2 THEN NULL ELSE 'N' END"
        " AS ind_anulacion",
        "CASE WHEN event_id % 37 <> 0 THEN user_id END AS siniestro",
    )
    return schemas.conform(df, schemas.VISIT_RAW)


def written_org_unit(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "concat('UO_', CAST(n_nationkey AS STRING)) AS uo_tratamiento",
        f"{_pick(UNIT_CODES, f'n_nationkey % {len(UNIT_CODES)}')} AS uo_medica",
        _respelled("r_name", "n_nationkey % 4 = 2") + " AS territorio_m",
        "n_name AS agencia_m",
        _respelled(_centre("n_nationkey"), "n_nationkey % 3 = 2") + " AS centro_m",
    )


def org_unit(nation: DataFrame, region: DataFrame) -> DataFrame:
    return schemas.conform(written_org_unit(nation, region), schemas.ORG_UNIT)


def covid_claim(customer: DataFrame) -> DataFrame:
    df = _twice(customer.where("c_custkey % 7 = 0"), "c_custkey % 21 = 0").selectExpr(
        "concat('C', CAST(c_custkey AS STRING)) AS siniestro_covid19"
    )
    return schemas.conform(df, schemas.COVID_CLAIM)


def ministry_case(orders: DataFrame) -> DataFrame:
    df = orders.where("o_custkey % 3 = 0").selectExpr("o_custkey AS id_siniestro")
    return schemas.conform(df, schemas.MINISTRY_CASE)


def party(customer: DataFrame) -> DataFrame:
    df = _twice(customer, "c_custkey % 11 = 0").selectExpr(
        "concat('R', CAST(c_custkey AS STRING)) AS rut", "c_custkey AS numero_bp"
    )
    return schemas.conform(df, schemas.PARTY)


def written_queue_log(events: DataFrame) -> DataFrame:
    centre = f"((user_id % {N_UNITS}) % {N_CENTRES})"
    return events.where(f"{centre} IN ({', '.join(map(str, QUEUE_CENTRES))})").selectExpr(
        _respelled(_centre(f"(user_id % {N_UNITS})"), "event_id % 6 = 1") + " AS centro",
        _respelled("concat('R', CAST(user_id AS STRING))", "event_id % 4 = 1") + " AS rut_paciente",
        "event_id % 3 AS ticket",
        "CAST(ts AS DATE) AS fecha",
        "ts AS hora_inicia",
        "ts + make_dt_interval(0, 0, 20) AS hora_fin",
        _respelled(lit("Médico"), "event_id % 5 = 2") + " AS cargo",
        "CASE event_type WHEN 'view' THEN 'admision' WHEN 'signup' THEN 'Espera_Box_Atencion'"
        " ELSE CASE WHEN event_id % 3 = 1 THEN 'BOX_ATENCION ' ELSE 'box_atencion' END END AS estado",
        "CASE WHEN event_id % 13 <> 5 THEN value END AS minutos",
        "ts AS hr_inicio",
        _respelled(_pick(QUEUE_ROWS, f"event_id % {len(QUEUE_ROWS)}"), "event_id % 10 = 7") + " AS fila",
        "CASE WHEN event_id % 8 = 0 THEN 0 ELSE 1 END AS validacion",
        "concat('T', CAST(event_id % 2 AS STRING)) AS tipo_atencion",
        "CASE event_id % 9 WHEN 0 THEN 'otra' WHEN 4 THEN 'Atencion ' ELSE 'atencion' END AS descripcion_tipo",
    )


def queue_log(events: DataFrame) -> DataFrame:
    return schemas.conform(written_queue_log(events), schemas.QUEUE_LOG)


def calendar(events: DataFrame) -> DataFrame:
    return events.selectExpr("CAST(ts AS DATE) AS fecha").distinct()


def capacity(nation: DataFrame) -> DataFrame:
    df = nation.selectExpr(
        _respelled(f"concat('C_', CAST(n_nationkey % {N_CENTRES} AS STRING))", "n_nationkey % 3 = 1") + " AS centro",
        f"CASE WHEN n_nationkey % 4 = 0 THEN 'Enfermera' ELSE {_respelled(lit(rules.STAFF_ROLE), 'n_nationkey % 5 = 3')} END AS cargo",
        f"CASE WHEN n_nationkey = 9 THEN 'Borrador' ELSE {_respelled(lit(rules.APPROVED), 'n_nationkey % 5 = 1')} END AS estado",
        "CAST(n_nationkey + 1 AS DOUBLE) AS fte",
    )
    return schemas.conform(df, schemas.CAPACITY)


def opening_hours_wide(events: DataFrame) -> DataFrame:
    """One row per (weekday, half hour) seen in events, Monday..Saturday.

    Centre column C_k: NULL when (d + s + k) % 7 == 0 (no entry), 1 when
    the slot s lies in 16 .. 35 + k % 3 (open), else 0 (closed).
    """
    grid = (
        events.selectExpr(f"{weekday_num('CAST(ts AS DATE)')} AS d",
                          "CAST(hour(ts) * 2 + minute(ts) div 30 AS INT) AS s")
        .where("d <= 6")
        .distinct()
    )
    cols = [
        f"CASE WHEN (d + s + {k}) % 7 = 0 THEN CAST(NULL AS INT) "
        f"WHEN s BETWEEN 16 AND {35 + k % 3} THEN 1 ELSE 0 END AS C_{k}"
        for k in range(N_CENTRES)
    ]
    return grid.selectExpr(
        f"element_at(array({', '.join(lit(x) for x in rules.WEEKDAY_ES)}), d) AS diasem",
        f"{slot_label('s')} AS mediahora",
        *cols,
    )


class DomainTables:
    """Lazily built domain frames for one scale-factor directory.

    ``of`` reuses the handles for the same session and folder: the frames
    are lazy plans over read-only files, so sharing them between queries
    only saves the file listing and plan construction.
    """

    _shared: dict[tuple[int, str], "DomainTables"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "DomainTables":
        key = (id(spark), sf_dir)
        t = cls._shared.get(key)
        if t is None or t.spark is not spark:
            t = cls._shared[key] = cls(spark, sf_dir)
        return t

    def raw(self, name: str) -> DataFrame:
        key = "raw:" + name
        if key not in self._cache:
            self._cache[key] = read_table(self.spark, self.sf_dir, name)
        return self._cache[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            builders = {
                "visit_raw": lambda: visit_raw(self.raw("events")),
                "org_unit": lambda: org_unit(self.raw("nation"), self.raw("region")),
                "covid_claim": lambda: covid_claim(self.raw("customer")),
                "ministry_case": lambda: ministry_case(self.raw("orders")),
                "party": lambda: party(self.raw("customer")),
                "queue_log": lambda: queue_log(self.raw("events")),
                "calendar": lambda: calendar(self.raw("events")),
                "capacity": lambda: capacity(self.raw("nation")),
                "opening_hours_wide": lambda: opening_hours_wide(self.raw("events")),
            }
            if name not in builders:
                raise AttributeError(name)
            self._cache[name] = builders[name]()
        return self._cache[name]

