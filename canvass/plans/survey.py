"""What a survey looks like: column roles, code lists, thresholds, texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# Status codes of a visit and their labels.
STATUS_LABELS = {
    1: "COMPLETA",
    2: "OCUPANTES AUSENTES",
    3: "PARCIALMENTE COMPLETA",
    4: "CITA",
    5: "RECHAZO",
    6: "PADRÓN DESOCUPADO",
    7: "NO ES PADRÓN / TERRENO / EN CONSTRUCCION",
    8: "NO TIENE BAÑO",
    9: "NO EXISTE RED DE SANEAMIENTO",
    10: "PADRÓN CON MÁS DE 10 VIVIENDAS",
}

# Words in a comment that speak of a status, first match wins. Code 3 has none.
COMMENT_RULES = [
    ("más de 10|mas de 10|más de diez", 10),
    ("no hay colector|sin colector|no existe red|no hay red|no tiene saneamiento", 9),
    ("no tiene baño|no cuenta con baño", 8),
    ("vacío|vacio|terreno|construcción|obras|baldío|baldio|inau|comercial|iglesia|galpón", 7),
    ("desocupado|vacía|vacia|no vive nadie|abandonado|sin muebles", 6),
    ("rechaz|negó|no quiso|no permite|no acepto|no interesa", 5),
    ("cita|agend|volver|mañana|después|despues|regresar|luego", 4),
    ("no salió nadie|no atendió|no se encuentra|ausente|no hay gente|golpeamos|palmas", 2),
    ("perfectamente|todo ok|sin inconvenientes|completa|fluida|finalizada|correcta|sin observaciones", 1),
]
NO_COMMENT_LABEL = "SIN CATEGORÍA CLARA"

# Audit categories.
EFFECTIVE = "EFECTIVA"
REFUSAL = "RECHAZO"
NOT_ELIGIBLE = "NO ELEGIBLE"
SCHEDULED = "AGENDADA/PENDIENTE"
OTHER = "OTRO/ERROR"
CATEGORIES = {
    EFFECTIVE: (1,),
    REFUSAL: (5,),
    NOT_ELIGIBLE: (6, 7, 8, 9, 10),
    SCHEDULED: (2, 3, 4),
}
CLOSED_CATEGORIES = (EFFECTIVE, NOT_ELIGIBLE, REFUSAL)
CATEGORY_RANKS = {EFFECTIVE: 4, SCHEDULED: 3, REFUSAL: 2, NOT_ELIGIBLE: 1}

# Codes that get the answer labels.
ATTENDANCE_LABELS = {1: "SI", 2: "NO"}
YES_NO_LABELS = {1: "SI", 2: "NO", 98: "NO RESPONDE"}

# Question lists.
NUMERIC_QUESTIONS = ("p1_07", "p2_02", "p3_06", "p4_01", "p10_03", "p5_09", "p5_19", "p8_01")
NSNR_QUESTIONS = (
    "p4_04", "p4_05", "p5_08", "p5_19", "p8_01",
    "p3_07a", "p3_07b", "p3_07c", "p3_07d", "p3_07e", "p3_07f", "p3_07g", "p3_07h", "p3_07i", "p3_07j",
    "p5_06", "p5_07", "p5_11",
)
TEXT_QUESTIONS = (
    "p3_03_otro", "p3_05_otro", "p3_06_otro", "p10_07", "p5_11_otro", "p5_17_otro",
    "p6_02_otro", "p7_02_otro", "p7_05", "p8_03", "p9_01_otro", "p9_02_otro",
)
SCALE_PREFIXES = ("fcs", "rcsi", "hhs")

# Labels whose form text is built at run time, so the form's own is no use.
LABEL_OVERRIDES = {
    "p5_19": "5,19 ¿Cuánto gasta en saneamiento?",
    "p4_04": "4,04 Ingresos mensuales del hogar",
    "p1_06": "1,06 ¿Cuantas viviendas hay en este padrón?",
    "p5_11": "5,11 ¿a quién solicitó el vaciado ",
}

# Treatment groups.
SIMPLE_SCHEME = "ESQUEMA FUNCIONAL SIMPLE"
DETAILED_SCHEME = "ESQUEMA FUNCIONAL DETALLADO"
CONTROL = "CONTROL"

NOT_YET = "not_yet"
UNASSIGNED = "🚫 No Asignada"


@dataclass(frozen=True)
class Survey:
    """Column roles and parameters of a survey. The defaults are the field survey's own."""

    key: str = "key"
    case_id: str = "id"
    unit: str = "padron_pull"
    block: str = "manzana_pull"
    agent: str = "tecnico_pull"
    interviewer: str = "ident_enc_resp"
    supervisor: str = "supervisor_pull"
    day: str = "day"
    submitted: str = "submission_date"
    started: str = "starttime"
    duration: str = "duration"
    status: str = "status_survey"
    status_label: str = "status_survey_resp"
    published_status: str = "pub_status"
    comment: str = "pub_comentario"
    treatment: str = "grupo_experimento"
    audio: str = "audio_encuesta"
    latitude: str = "georeferenciacion_latitude"
    longitude: str = "georeferenciacion_longitude"

    numeric_questions: Sequence[str] = NUMERIC_QUESTIONS
    nsnr_questions: Sequence[str] = NSNR_QUESTIONS
    text_questions: Sequence[str] = TEXT_QUESTIONS
    ignored_skips: Sequence[str] = ("status_survey",)

    test_days: Sequence[str] = ("Mar 23, 2026",)
    date_floor: str = "2026-02-27"
    hours_behind: int = 3
    zone: str = "America/Montevideo"
    utm_zone: int = 21
    max_metres: float = 15
    k_short: float = 3
    k_long: float = 5
    k_numeric: float = 3
    min_nsnr: int = 4

    treatment_codes: Sequence[str] = ("1", "3", "5")
    labels: Mapping[int, str] = field(default_factory=lambda: dict(STATUS_LABELS))


@dataclass(frozen=True)
class ManualInputs:
    """Lists kept by hand. All are given at run time; none is part of the code."""

    forced_keys: Sequence[str] = ()
    forced_values: Mapping[str, str] = field(
        default_factory=lambda: {"p10_00": "1", "p10_00_resp": "SI"}
    )
    blacklist: Sequence[str] = ()
    unit_corrections: Sequence[tuple[str, str]] = ()
    status_corrections: Sequence[tuple[str, int]] = ()
    accepted_duplicates: Sequence[str] = ()
