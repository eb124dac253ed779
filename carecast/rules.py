"""Domain rule tables.

FIXED VALUES — every string and number below must equal the source
workload's labels exactly: they are compared with data values, used as
join keys (weekday names), or weight the demand model. They are listed
plainly, in their natural order. Comparisons against them are
case-insensitive (see ``functions.text``), so the capitalisation here is
only what the outputs carry.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
# Movement code (cl_mov_desc) -> visit class (clasif). Unlisted codes: OTHER.
MOVEMENT_CLASS: dict[str, str] = {
    "Consulta Urgenc": "Ingreso",
    "Preingreso EP": "Preingreso EP",
    "Consulta Ambula": "Control Agendado",
    "Consulta Espont": "Control Espontaneo",
    "Apoyo Diagnosti": "Tareas Administrativas",
    "Por desarrollo": "Tareas Administrativas",
    "Apoyo Tratamien": "Tareas Administrativas",
    "Urgen.Telemed": "Ingreso Telemedicina",
    "Control Telemed": "Control Telemedicina",
    "Urg.Telefónica": "Ingreso Telefonico",
    "Control Telefon": "Control Telefonico",
    "Vig de la Salud": "Vigilancia de la Salud",
}
OTHER = "Otros"

# Claim type code (tipo_siniestro_orig) -> label. Unlisted codes: OTHER.
CLAIM_TYPE: dict[int, str] = {
    1: "Trabajo",
    2: "Trayecto",
    3: "Enfermedad profesional",
    4: "No ley",
}
OCCUPATIONAL = "Enfermedad profesional"

# Spanish calendar names (weekday 1 = Monday).
WEEKDAY_ES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
MONTH_ES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
WEEKDAY_FALLBACK = "Otro"

# Visit filters (visit classification).
CANCELLED_FLAGS = ["D", "X"]
PRIMARY_CARE_UNIT_PATTERN = "MAPRI"
EXCLUDED_MEDICAL_UNITS = [
    "PECMTMT", "PECMSM", "PECMCX", "PECMCMED", "PECMIMG",
    "PECMENFE", "PECMHOSP", "PECMAPRI", "PECMPROC",
]
MIN_YEAR = 2018

# Four-way covid x ministry label (movement detail).
FLAG_LABELS = {
    (1, 1): "MINSAL Covid",
    (0, 1): "MINSAL No Covid",
    (1, 0): "Otros Covid",
    (0, 0): "Otros",
}

# Movement measures: measure -> (classes, claim condition). The claim
# condition is None (any), "ep" (occupational only) or "not_ep".
# "otros" is the complement of every class listed in the rule set.
NARROW_MEASURES: dict[str, tuple[list[str], str | None]] = {
    "ingreso": (["Ingreso"], "not_ep"),
    "ingreso_ep": (["Ingreso"], "ep"),
    "preingreso_ep": (["Preingreso EP"], None),
    "control_agendado": (["Control Agendado"], None),
    "administrativo": (["Tareas Administrativas"], None),
    "control_espnt": (["Control Espontaneo"], None),
}
WIDE_MEASURES: dict[str, tuple[list[str], str | None]] = {
    "ingreso": (["Ingreso", "Ingreso Telemedicina", "Ingreso Telefonico"], "not_ep"),
    "ingreso_ep": (["Ingreso", "Ingreso Telemedicina", "Ingreso Telefonico"], "ep"),
    "preingreso_ep": (["Preingreso EP"], None),
    "control_agendado": (["Control Agendado", "Control Telemedicina", "Control Telefonico"], None),
    "administrativo": (["Tareas Administrativas", "Vig de la Salud"], None),
    "control_espnt": (["Control Espontaneo"], None),
}
MEASURE_ORDER = [
    "ingreso", "ingreso_ep", "preingreso_ep", "control_agendado",
    "administrativo", "otros", "control_espnt",
]

# Service minutes per attention type (weekly load and service-time defaults).
SERVICE_MINUTES = {
    "tareas_admin": 6.0,
    "control_espontaneo": 15.0,
    "control_agendado": 15.0,
    "ingreso": 20.6,
    "ingreso_ep": 37.0,
    "preingreso_ep": 28.0,
}
MINUTES_PER_FTE_DAY = 9 * 60

# Service-time type labels (measured demand) and the pivot column order.
TIME_TYPES = [
    "Tareas Admin", "Otros", "Control espontaneo", "Control Agendado",
    "Ingreso", "Ingreso EP", "Preingreso EP",
]
TIME_TYPE_RULES = [  # (movement codes, claim condition, label), first match wins
    (["Consulta Urgenc"], "ep", "Ingreso EP"),
    (["Consulta Urgenc"], "not_ep", "Ingreso"),
    (["Consulta Ambula"], None, "Control Agendado"),
    (["Consulta Espont"], None, "Control espontaneo"),
    (["Preingreso EP"], None, "Preingreso EP"),
    (["Por desarrollo", "Apoyo Diagnosti", "Apoyo Tratamien"], None, "Tareas Admin"),
]

# Centre exclusions: measured demand (exact names plus a pattern) and the
# half-hour model (exact names only).
DEMAND_EXCLUDED_CENTRES = [
    "CAA", "Urgencia", "CEM 3ER PISO", "CEM 2DO PISO", "CEM 1ER PISO", "CEM 4TO PISO",
    "CEM IMAGENOLOGIA", "CEM 5TO PISO", "CEM 6TO PISO", "CEM RAYOS", "Salud Mental",
]
DEMAND_EXCLUDED_PATTERN = "SEL"
SHIFT_EXCLUDED_CENTRES = [
    "CAA", "SEL", "Urgencia", "CEM 1ER PISO", "CEM 2DO PISO", "CEM 3ER PISO",
    "CEM 4TO PISO", "CEM 5TO PISO", "CEM 6TO PISO", "CEM IMAGENOLOGIA", "CEM RAYOS",
    "SALUD MENTAL",
]

# Queue log filters.
QUEUE_ROWS = ["A", "B", "M"]
BOX_STATES = ["box_atencion", "espera_box_atencion"]
TIMED_STATE = "box_atencion"
TIMED_DESCRIPTION = "atencion"
STAFF_ROLE = "Médico Atención Primaria"
APPROVED = "Aprobado"

# Synthetic attention end time (minutes after start) by class for centres
# without queue data. Fractions truncate when added to a time.
SYNTHETIC_MINUTES = [  # (class, claim condition, minutes), first match wins
    ("Ingreso", "not_ep", 36.6),
    ("Ingreso", "ep", 53),
    ("PreIngreso EP", None, 44),
    ("Control Agendado", None, 27),
    ("Control Espontaneo", None, 31),
    ("Tareas Administrativas", None, 6),
]
SYNTHETIC_STATE = "box_atencion"

# Half-hour model: per-attention weights (minutes) and the slot length.
SLOT_MINUTES = 30
SLOT_WEIGHTS = {
    "preingreso_ep": 28,
    "ingreso": 20.6,
    "ingreso_ep": 37,
    "control_espontaneo": 15,
    "tareas_administrativas": 6,
    "control_agendado": 15,
}
DEFAULT_WEEKS = 13
DEFAULT_LAPSE = "3 Meses"
PERCENTILE = 0.75
ROUND_SCALE = 5
# ------------------------------------------------------------ END FIXED VALUES
