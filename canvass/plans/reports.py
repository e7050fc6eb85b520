"""Operational reports.

Each report is a function of tables and a :class:`Survey`. Column names are plain;
``canvass.plans.published`` holds the headings of the published sheets. Nothing is sorted
here: a sink sorts when the order is part of the report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import as_column, fill_numeric_nulls
from canvass.functions.dates import active_days, appointment_time, days_between, overdue_label
from canvass.functions.numbers import number, percent
from canvass.functions.rules import first_match
from canvass.functions.text import address_text, block_label, number_text, paste, trim_all
from canvass.operators import reshape, verdicts, visits
from canvass.operators.corrections import left_lookup, upsert
from canvass.operators.summaries import (
    contingency,
    count_where,
    distinct_count,
    first_by,
    mean_where,
    one_way,
    summarise,
    text_list,
)
from canvass.plans import survey as sv
from canvass.plans.survey import Survey

# Quality bands of a block.
QUALITY_BANDS = [(90, "✅ ALTA CALIDAD"), (70, "⚠️ REVISIÓN LEVE")]
LOW_QUALITY, NO_DATA = "🚨 CRÍTICA: REVISAR EQUIPO", "Sin Datos"

# States of a block's progress.
BLOCK_UNASSIGNED = "📁 NO ASIGNADA"
BLOCK_AUDIT_PENDING = "🔍 PENDIENTE AUDITORÍA"
BLOCK_COMPLETE = "🟢 COMPLETA"
BLOCK_NOT_STARTED = "⚪ SIN EMPEZAR"
BLOCK_INACTIVE = "🔥 MANZANA INACTIVA"
BLOCK_REVISIT = "🟡 REVISITAR (Pendientes)"
BLOCK_IN_PROGRESS = "🔵 EN PROCESO"
MOSTLY_NO_NETWORK = "🚨 Mayoria Sin Red"

# Indicators of the daily sheet, in sheet order.
DETAIL_INDICATORS = (
    "1.1 Número de duplas (Tec+Enc)",
    "1.2 Padrones conectados (Red)",
    "1.3 Padrones no conectados",
    "1.4 Esquema Funcional Simple",
    "1.5 Esquema Funcional Completo",
    "1.6 Grupo Control",
)
STATUS_INDICATORS = (
    "2.01 COMPLETA",
    "2.02 OCUPANTES AUSENTES",
    "2.03 PARCIALMENTE COMPLETA",
    "2.04 CITA",
    "2.05 RECHAZO",
    "2.06 VIVIENDA DESOCUPADA",
    "2.07 NO ES VIVIENDA / TERRENO / CONSTR.",
    "2.08 NO TIENE BAÑO",
    "2.09 NO EXISTE RED SANEAMIENTO",
    "2.10 PADRÓN > 10 VIVIENDAS",
)

# Alert columns that make up the error rate.
ERROR_RATE_ALERTS = (
    "alerts_gps", "alerts_time", "alerts_garbage", "alerts_nsnr", "alerts_outliers",
)


def _is(category: str) -> Column:
    return F.col("category") == category


# ---- history and cases -------------------------------------------------------------


def cases_table(submissions: DataFrame, s: Survey) -> DataFrame:
    """Every visit with its attempt number and the flag of the unit's latest visit."""
    chosen = submissions.select(
        as_column(s.unit).alias("unit"),
        as_column(s.block).alias("block"),
        as_column(s.key).alias("key"),
        as_column(s.started).alias("visited_at"),
        as_column(s.supervisor).alias("supervisor"),
        as_column(s.agent).alias("agent"),
        as_column(s.interviewer).alias("interviewer"),
        as_column(s.status_label).alias("status"),
        F.col("category").alias("result"),
    )
    numbered = visits.number_attempts(chosen, "unit", "visited_at", "key")
    return visits.mark_latest(numbered, "unit", "visited_at", "key", out="is_final")


def closure_review(submissions: DataFrame, s: Survey) -> DataFrame:
    """All visits of units visited again after a closing result."""
    closed = F.col("category").isin(*sv.CLOSED_CATEGORIES)
    return visits.closure_history(submissions, s.unit, s.submitted, s.key, closed)


def partial_review(submissions: DataFrame, s: Survey) -> DataFrame:
    """All visits of units with a partial interview."""
    return visits.history_of_matching(submissions, s.unit, s.key, F.col("status_num") == 3)


def audio_coverage(audited: DataFrame, s: Survey) -> DataFrame:
    """Effective interviews by day, with and without audio."""
    return contingency(audited.filter(_is(sv.EFFECTIVE)), s.day, "has_audio", [0, 1])


# ---- alerts ------------------------------------------------------------------------


def alert_pieces() -> Column:
    """Message of an alert: one marked piece per raised flag."""
    return verdicts.alert_pieces(
        {
            "flag_geofencing": [F.lit("📍 GPS: "), number_text("distance_m", 0), F.lit("m fuera")],
            "flag_duration_outlier": [
                F.lit("⏱️ Duración: "), number_text("duration_min", 1), F.lit("m"),
            ],
            "flag_garbage_text": [F.lit("🗑️ Basura: "), F.col("garbage_detail")],
            "flag_nsnr": [F.lit("❓ NS/NR: "), F.col("nsnr_detail")],
            "flag_extreme_values": [F.lit("📈 Valor: "), F.col("outlier_detail")],
            "flag_duplicated": [F.lit("👥 DUPLICADO: "), F.col("identity")],
            "flag_missing": [F.col("missing_detail")],
        }
    )


def alert_table(audited: DataFrame, s: Survey) -> DataFrame:
    """Alerting effective interviews with message, severity and recommended action."""
    rows = audited.filter((F.col("audit_alert") == 1) & _is(sv.EFFECTIVE))
    return rows.select(
        verdicts.severity().alias("severity"),
        as_column(s.key).alias("key"),
        as_column(s.started).alias("started"),
        as_column(s.supervisor).alias("supervisor"),
        as_column(s.agent).alias("agent"),
        as_column(s.interviewer).alias("interviewer"),
        as_column(s.block).alias("block"),
        as_column(s.unit).alias("unit"),
        F.col("category"),
        verdicts.recommended_action().alias("action"),
        alert_pieces().alias("alerts"),
    )


def scheme_review(
    audited: DataFrame, flags: Sequence[str], columns: Mapping[str, str], blanks: Sequence[str]
) -> DataFrame:
    """Rows with any of the flags set, chosen columns, and empty columns to write in."""
    hit = F.lit(False)
    for name in flags:
        hit = hit | (as_column(name).cast("string") == "1")
    return audited.filter(hit).select(
        *[as_column(src).alias(out) for out, src in columns.items()],
        *[F.lit("").alias(b) for b in blanks],
    )


# ---- blocks ------------------------------------------------------------------------


def block_scorecard(audited: DataFrame, s: Survey) -> DataFrame:
    """Counts, alert counts, mean missings and skips, and quality band per block."""
    figures = {
        "units_visited": F.count(F.lit(1)),
        "effective": F.sum("is_effective"),
        "alerts_gps": F.sum("flag_geofencing"),
        "alerts_garbage": F.sum("flag_garbage_text"),
        "alerts_time": F.sum("flag_duration_outlier"),
        "alerts_duplicates": F.sum("flag_duplicated"),
        "alerts_nsnr": F.sum("flag_nsnr"),
        "alerts_outliers": F.sum("flag_extreme_values"),
        "mean_missing": F.round(F.avg("total_missing"), 2),
        "mean_skips": F.round(F.avg("total_skips"), 2),
        "with_alert": F.sum("audit_alert"),
        "passed": F.sum("audit_pass"),
        "supervisor": first_by(s.supervisor, s.unit, s.key),
        "teams": text_list(s.agent),
    }
    rows = audited.filter(F.col("is_final") == 1)
    table = summarise(rows, {"block": block_label(s.block)}, figures)
    index = percent("passed", "units_visited", 1)
    bands = [(F.col("quality_index") >= floor, text) for floor, text in QUALITY_BANDS]
    bands.append((F.col("quality_index") < QUALITY_BANDS[-1][0], LOW_QUALITY))
    return table.withColumn("quality_index", index).withColumn(
        "quality_band", first_match(bands, NO_DATA)
    )


def block_assignment(enumerators: DataFrame, names: DataFrame) -> DataFrame:
    """Block and assigned agent from the enumerator sheet (``users``, ``name``)."""
    joined = left_lookup(enumerators, names.select("users", "enumerator_name"), ["users"], null_safe=True)
    # an unknown account keeps the assignment unknown
    agent = (
        F.when(F.col("users").isNull(), None)
        .when(F.col("users") == sv.NOT_YET, sv.UNASSIGNED)
        .otherwise(F.coalesce("enumerator_name", "users"))
    )
    return joined.select(block_label("name").alias("block"), agent.alias("assigned_agent"))


def block_targets(
    cases: DataFrame, assignment: DataFrame, *, block: str = "manzana", unit: str = "padron"
) -> DataFrame:
    """Units to visit per block with the block's agent; the template case 1 is left out."""
    real = cases.filter(as_column("id").cast("string") != "1")
    targets = summarise(
        real, {"block": block_label(block)}, {"units_total": distinct_count(unit, count_null=False)}
    )
    return left_lookup(targets, assignment, ["block"])


def block_work(audited: DataFrame, s: Survey) -> DataFrame:
    """What was done per block, in one aggregation."""
    passed = F.col("audit_pass") == 1
    visited = F.to_date(as_column(s.submitted))
    figures = {
        "effective": count_where(_is(sv.EFFECTIVE) & passed),
        "refusals": count_where(_is(sv.REFUSAL) & passed),
        "not_eligible": count_where(_is(sv.NOT_ELIGIBLE) & passed),
        "scheduled": count_where(_is(sv.SCHEDULED) & passed),
        "units_visited": distinct_count(s.unit, count_null=False),
        "in_review": count_where((F.col("audit_alert") == 1) & ~_is(sv.SCHEDULED)),
        "agents": text_list(s.agent),
        "interviewers": text_list(s.interviewer),
        "supervisor": first_by(s.supervisor, s.unit, s.key),
        "first_visit": F.min(visited),
        "last_visit": F.max(visited),
        "status_9": count_where(F.col("status_num") == 9),
        "status_10": count_where(F.col("status_num") == 10),
    }
    work = summarise(audited, {"block": block_label(s.block)}, figures)
    return work.withColumn("days_active", active_days("last_visit", "first_visit"))


def block_progress(targets: DataFrame, work: DataFrame, run_date: date) -> DataFrame:
    """Progress of each block against its target, with a traffic light and alert text."""
    counts = [
        "effective", "refusals", "not_eligible", "scheduled", "in_review", "units_visited",
        "status_9", "status_10",
    ]
    df = left_lookup(targets, work, ["block"])
    df = fill_numeric_nulls(df, counts)
    closed = F.col("effective") + F.col("refusals") + F.col("not_eligible")
    df = df.withColumns(
        {
            "not_visited": F.greatest(F.lit(0), F.col("units_total") - F.col("units_visited")),
            "percent_visited": percent("units_visited", "units_total", 1),
            "percent_progress": percent(closed, "units_total", 1),
            "days_idle": days_between(F.lit(run_date), "last_visit"),
        }
    )
    light = first_match(
        [
            (F.col("assigned_agent") == sv.UNASSIGNED, BLOCK_UNASSIGNED),
            ((F.col("percent_progress") == 100) & (F.col("in_review") > 0), BLOCK_AUDIT_PENDING),
            ((F.col("percent_progress") >= 100) & (F.col("in_review") == 0), BLOCK_COMPLETE),
            (F.col("units_visited") == 0, BLOCK_NOT_STARTED),
            ((F.col("days_idle") > 4) & (F.col("not_visited") > 0), BLOCK_INACTIVE),
            ((F.col("percent_visited") >= 100) & (F.col("scheduled") > 0), BLOCK_REVISIT),
        ],
        BLOCK_IN_PROGRESS,
    )
    no_network = F.when(F.col("status_9") > 0.5 * F.col("units_total"), MOSTLY_NO_NETWORK)
    open_alerts = F.when(
        F.col("in_review") > 0,
        F.concat(F.lit(" | 🔍 "), F.col("in_review").cast("string"), F.lit(" alertas")),
    )
    text = F.concat(F.coalesce(no_network, F.lit("")), F.coalesce(open_alerts, F.lit("")))
    return df.withColumns({"block_alerts": text, "light": light}).select(
        "block", "supervisor", F.col("assigned_agent").alias("agent"), "interviewers",
        "units_total", "not_visited", "effective", "refusals", "not_eligible", "scheduled",
        "in_review", "percent_visited", "percent_progress", "first_visit", "last_visit",
        "days_active", "days_idle", "block_alerts", "light",
    )


# ---- agents ------------------------------------------------------------------------


def agent_block_targets(cases: DataFrame, enumerators: DataFrame) -> DataFrame:
    """Distinct units per block, agent and supervisor, for assigned blocks.

    ``cases`` names its enumerator in ``enumerators`` (blanks around it do not matter);
    ``enumerators`` has ``id``, ``users`` (account) and ``name`` (block).
    """
    left = cases.withColumn("__enumerator", trim_all(as_column("enumerators").cast("string")))
    right = enumerators.select(
        trim_all(as_column("id").cast("string")).alias("__id"), trim_all(as_column("users").cast("string")).alias("__account"),
        as_column("name").alias("block"),
    )
    joined = left.join(right, F.col("__enumerator") == F.col("__id")).filter(
        F.col("__account") != sv.NOT_YET
    )
    keys = {"block": "block", "agent": "enumerator_name", "supervisor": "supervisor"}
    return summarise(joined, keys, {"units": distinct_count("padron", count_null=False)})


def agent_targets(per_block: DataFrame) -> DataFrame:
    """Blocks, target and supervisor per agent."""
    return summarise(
        per_block,
        {"agent": "agent"},
        {
            "blocks": text_list("block", ", "),
            "target": F.sum("units"),
            "supervisor": first_by("supervisor", "block", "supervisor"),
        },
    )


def agent_consolidated(audited: DataFrame, targets: DataFrame, s: Survey) -> DataFrame:
    """Results per agent and interviewer, with coverage of the agent's target.

    ``effective`` counts effective interviews and ``effective_with_alert`` those with an
    alert, each under its own name.
    """
    final = F.col("is_final") == 1
    figures = {
        "visits": F.count(F.lit(1)),
        "effective": count_where(final & _is(sv.EFFECTIVE)),
        "refusals": count_where(final & _is(sv.REFUSAL)),
        "not_eligible": count_where(final & _is(sv.NOT_ELIGIBLE)),
        "scheduled": count_where(final & _is(sv.SCHEDULED)),
        "others": count_where(final & _is(sv.OTHER)),
        "effective_with_alert": count_where(
            (F.col("is_effective") == 1) & (F.col("audit_alert") == 1)
        ),
        "all_alerts": count_where(F.col("audit_alert") == 1),
    }
    table = summarise(audited, {"agent": s.agent, "interviewer": s.interviewer}, figures)
    joined = left_lookup(table, targets, ["agent"], null_safe=True)
    done = F.col("effective") + F.col("refusals") + F.col("not_eligible")
    return joined.withColumn("coverage", percent(done, "target", 1)).withColumn(
        "target", F.coalesce("target", F.lit(0))
    )


def agent_productivity(audited: DataFrame, s: Survey) -> DataFrame:
    """Results, time, schemes, alerts and error rate per agent and interviewer."""
    effective = F.col("is_effective") == 1

    def with_flag(name: str) -> Column:
        return count_where(effective & (F.col(name) == 1))

    figures = {
        "units": F.count(F.lit(1)),
        "effective": count_where(_is(sv.EFFECTIVE)),
        "refusals": count_where(_is(sv.REFUSAL)),
        "not_eligible": count_where(_is(sv.NOT_ELIGIBLE)),
        "scheduled": count_where(_is(sv.SCHEDULED)),
        "mean_minutes": F.round(mean_where("duration_min", effective), 1),
        "simple_schemes": count_where(
            effective & (as_column("grupo_3") == "1") & (as_column("p10_13") == "1")
        ),
        "detailed_schemes": count_where(
            effective & (as_column("grupo_4") == "1") & (as_column("p10_13") == "1")
        ),
        "alerts_gps": with_flag("flag_geofencing"),
        "alerts_time": with_flag("flag_duration_outlier"),
        "alerts_garbage": with_flag("flag_garbage_text"),
        "alerts_nsnr": with_flag("flag_nsnr"),
        "alerts_outliers": with_flag("flag_extreme_values"),
        "alerts_duplicates": with_flag("flag_duplicated"),
        "alerts_missing": with_flag("flag_missing"),
    }
    table = summarise(audited, {"agent": s.agent, "interviewer": s.interviewer}, figures)
    alerts = sum((F.col(c) for c in ERROR_RATE_ALERTS[1:]), F.col(ERROR_RATE_ALERTS[0]))
    rated = table.withColumn("error_rate", percent(alerts, "effective", 1))
    return fill_numeric_nulls(rated, ["mean_minutes", "error_rate"])


def agent_report(progress: DataFrame, cases: DataFrame, clear: DataFrame, s: Survey) -> DataFrame:
    """Blocks, coverage, effort and open appointments per agent."""
    blocks = summarise(
        progress,
        {"agent": "agent"},
        {
            "blocks": distinct_count("block"),
            "units_total": F.sum("units_total"),
            "closed": F.sum(F.col("effective") + F.col("refusals") + F.col("not_eligible")),
        },
    )
    effort = summarise(
        cases,
        {"agent": "agent"},
        {
            "visits_made": F.count(F.lit(1)),
            "effective_visits": count_where(F.col("result") == sv.EFFECTIVE),
        },
    )
    states = summarise(
        clear,
        {"agent": s.agent},
        {
            "appointments": count_where(F.col("status_num") == 4),
            "absent": count_where(F.col("status_num") == 2),
            "units_visited": distinct_count(s.unit),
        },
    )
    joined = left_lookup(blocks, effort, ["agent"], null_safe=True)
    joined = left_lookup(joined, states, ["agent"], null_safe=True)
    out = joined.select(
        "agent",
        "blocks",
        "units_total",
        "units_visited",
        percent("units_visited", "units_total", 1).alias("percent_visited"),
        percent("closed", "units_total", 1).alias("percent_progress"),
        percent("effective_visits", "visits_made", 1).alias("effectiveness"),
        "appointments",
        "absent",
    )
    return fill_numeric_nulls(out)


def intervention_by_agent(clear: DataFrame, s: Survey) -> DataFrame:
    """Effective interviews per agent and treatment, with the agent's total."""
    rows = clear.filter(F.col("is_effective") == 1).withColumn(
        "__treatment", F.coalesce(as_column(s.treatment), F.lit("NA"))
    )
    named = [sv.DETAILED_SCHEME, sv.SIMPLE_SCHEME, sv.CONTROL, "NA"]
    return reshape.counts_to_columns(rows, s.agent, "__treatment", named, other="other")


# ---- days --------------------------------------------------------------------------


def daily_detail(audited: DataFrame, s: Survey) -> DataFrame:
    """Per day: teams, connected units and treatments of the final effective visits."""
    done = F.col("status_num") == 1
    connection = number("p10_09")
    treatment = as_column(s.treatment)
    figures = (
        F.count_distinct(paste(s.agent, s.interviewer)),
        count_where((connection == 1) & done),
        count_where(connection.isin(*[float(c) for c in range(2, 10)]) & done),
        count_where((treatment == sv.SIMPLE_SCHEME) & done),
        count_where((treatment == sv.DETAILED_SCHEME) & done),
        count_where((treatment == sv.CONTROL) & done),
    )
    rows = audited.filter(F.col("is_final") == 1)
    return summarise(rows, {"day": s.day}, dict(zip(DETAIL_INDICATORS, figures, strict=True)))


def daily_status(submissions: DataFrame, s: Survey) -> DataFrame:
    """Per day: visits by status over all attempts."""
    figures = {
        name: count_where(F.col("status_num") == code)
        for code, name in enumerate(STATUS_INDICATORS, start=1)
    }
    return summarise(submissions, {"day": s.day}, figures)


def daily_progress(
    detail: DataFrame, status: DataFrame, days: Sequence[str] | None = None
) -> DataFrame:
    """Indicators in rows, days in columns; days are found once unless given."""
    both = reshape.full_join_by(detail, status, "day")
    return reshape.transpose_summary(
        both, "day", [*DETAIL_INDICATORS, *STATUS_INDICATORS], values=days, name="Indicador"
    )


# ---- case management ---------------------------------------------------------------


def appointments(
    cases: DataFrame,
    comments: DataFrame,
    as_of: datetime,
    s: Survey,
    *,
    status: str = "CITA",
    order: Sequence[str] = ("fecha", "cita", "manzana", "agent", "nombre_participante", "telefono_1", "previous_attempt"),
) -> DataFrame:
    """Open appointments with the interviewer's comment and whether they are overdue.

    One row per case: the first in ``order``, then by comment. The default order takes in
    all published columns, so that the same cases give the same table in whatever order
    they come.
    """
    wanted = cases.filter((F.col("status") == status) & (as_column("id").cast("string") != "1"))
    left = wanted.select(
        as_column("id").cast("string").alias("id"),
        "fecha",
        F.col("enumerator_name").alias("agent"),
        "manzana", "nombre_participante", "telefono_1", "cita", "intento",
    )
    right = comments.select(
        as_column(s.case_id).cast("string").alias("id"), as_column(s.comment).alias("full_comment")
    )
    joined = left_lookup(left, right, ["id"], null_safe=True)
    instant = appointment_time("cita", s.zone)
    shown = joined.withColumns(
        {
            "previous_attempt": number("intento") - 1,
            "overdue": overdue_label(instant, as_of),
        }
    ).drop("intento")
    keys = [as_column(o).asc_nulls_last() for o in (*order, "full_comment")]
    return visits.keep_first(shown, ["id"], keys)


# Words of the written-out address.
ADDRESS_PARTS = (
    ("", "direccion"),
    ("", "n_predio"),
    ("Piso", "piso"),
    ("Apartamento", "apartamento"),
    ("Ref padrón", "referencia_padron"),
    ("Ref vivienda", "referencia_vivienda"),
)

# Case columns refreshed from the last interview.
CASE_REFRESH = {
    "direccion": ("full_address", "string"),
    "status": ("pub_status", "string"),
    "visita": ("pub_visita", "double"),
    "intento": ("pub_intento", "double"),
    "cita": ("pub_reprogramacion", "string"),
    "fecha": ("fecha", "string"),
    "nombre_participante": ("pub_nombre", "string"),
    "telefono_1": ("pub_telf_cita", "string"),
    "telefono_2": ("pub_telf_1", "string"),
    "telefono_3": ("pub_telf_2", "string"),
    "telefono_4": ("pub_telf_3", "string"),
    "formids": ("pub_form_id", "string"),
    "users": ("pub_users", "string"),
    "comentarios_enc": ("pub_comentario", "string"),
}


def case_refresh(
    cases: DataFrame,
    interviews: DataFrame,
    *,
    case_id: str = "id",
    time: str = "instance_time",
    key: str = "key",
    only_if_any_address: bool = False,
) -> DataFrame:
    """The case table with the last interview's values written back."""
    latest = visits.latest_only(interviews, case_id, time, key)
    address = address_text(ADDRESS_PARTS, only_if_any_address)
    ready = latest.withColumn("full_address", address)
    return upsert(cases, ready, case_id, CASE_REFRESH)


def status_counts(table: DataFrame, column: str) -> DataFrame:
    return one_way(table, column)
