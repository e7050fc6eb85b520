"""Block, agent and day reports over the audited interviews."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from canvass.catalog.alerts import SURVEY, audited
from canvass.catalog.registry import AUDITED, query, table
from canvass.functions.columns import select_mapping
from canvass.plans import published
from canvass.plans import reports as rp
from canvass.plans import survey as sv

RUN_DATE = date(2001, 6, 1)


def block_sql(x: str) -> str:
    return f"'Manzana ' || coalesce(nullif(regexp_extract({x}, '\\d+'), ''), 'NA')"


def rate_sql(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100, 1)"


def list_sql(x: str, sep: str = " | ") -> str:
    return f"string_agg(DISTINCT coalesce({x}, 'NA'), '{sep}' ORDER BY coalesce({x}, 'NA'))"


def count_sql(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


# ---- case sheet and enumerator sheet, made from customers and nations ---------------

_CASES = """cases AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END AS padron,
         CASE WHEN c_nationkey <> 24 THEN 'Nr ' || c_nationkey END AS manzana,
         ' ' || c_nationkey || ' ' AS enumerators,
         'T' || (c_nationkey % 10) AS enumerator_name, 'S' || (c_nationkey % 3) AS supervisor
  FROM customer)"""
_ENUMERATORS = """enumerators AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id,
         CASE WHEN n_nationkey % 7 = 0 THEN 'not_yet' WHEN n_nationkey % 11 <> 0 THEN 'u' || n_nationkey END AS users,
         n_name AS name FROM nation)"""
_NAMES = """names AS (SELECT 'u' || n_nationkey AS users, 'T' || (n_nationkey % 10) AS enumerator_name
  FROM nation WHERE n_nationkey < 20)"""


def _cases(spark, sf_dir):
    nation = F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")).alias("padron"),
        F.when(nation != 24, F.concat(F.lit("Nr "), nation.cast("string"))).alias("manzana"),
        F.concat(F.lit(" "), nation.cast("string"), F.lit(" ")).alias("enumerators"),
        F.concat(F.lit("T"), (nation % 10).cast("string")).alias("enumerator_name"),
        F.concat(F.lit("S"), (nation % 3).cast("string")).alias("supervisor"),
    )


def _enumerators(spark, sf_dir):
    nation = F.col("n_nationkey")
    account = F.when(nation % 7 == 0, sv.NOT_YET).when(
        nation % 11 != 0, F.concat(F.lit("u"), nation.cast("string"))
    )
    return table(spark, sf_dir, "nation").select(
        nation.cast("string").alias("id"), account.alias("users"), F.col("n_name").alias("name")
    )


def _names(spark, sf_dir):
    nation = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").filter(nation < 20).select(
        F.concat(F.lit("u"), nation.cast("string")).alias("users"),
        F.concat(F.lit("T"), (nation % 10).cast("string")).alias("enumerator_name"),
    )


# ---- blocks ------------------------------------------------------------------------


@query(
    "block_scorecard",
    f"""WITH {AUDITED}, g AS (
      SELECT {block_sql('manzana_pull')} AS "Manzana", count(*) AS n,
        CAST(count(*) AS BIGINT) AS "Total_Padrones_Visitados",
        CAST(sum(is_effective) AS BIGINT) AS "Total_Efectivas",
        CAST(sum(flag_geofencing) AS BIGINT) AS "Alertas_GPS",
        CAST(sum(flag_garbage_text) AS BIGINT) AS "Alertas_Texto_Basura",
        CAST(sum(flag_duration_outlier) AS BIGINT) AS "Alertas_Tiempos",
        CAST(sum(flag_duplicated) AS BIGINT) AS "Alertas_Duplicados",
        CAST(sum(flag_nsnr) AS BIGINT) AS "Alertas_NSNR",
        CAST(sum(flag_extreme_values) AS BIGINT) AS "Alertas_Valores_Extremos",
        round(CAST(avg(total_missing) AS DECIMAL(38, 12)), 2)::DOUBLE AS "Promedio_Missings",
        round(CAST(avg(total_skips) AS DECIMAL(38, 12)), 2)::DOUBLE AS "Promedio_Saltos",
        CAST(sum(audit_alert) AS BIGINT) AS "Encuestas_Con_Alerta",
        CAST(sum(audit_pass) AS BIGINT) AS "Encuestas_Exitosas",
        round(CAST(CAST(sum(audit_pass) AS DOUBLE) / count(*) * 100 AS DECIMAL(38, 12)), 1)::DOUBLE AS "Indice_Calidad",
        arg_min(supervisor_pull, (coalesce(padron_pull, 9223372036854775807), key)) AS "Supervisor",
        {list_sql('tecnico_pull')} AS "Equipos"
      FROM audited WHERE is_final = 1 GROUP BY 1)
    SELECT * EXCLUDE (n), CASE WHEN "Indice_Calidad" >= 90 THEN '✅ ALTA CALIDAD'
        WHEN "Indice_Calidad" >= 70 THEN '⚠️ REVISIÓN LEVE'
        WHEN "Indice_Calidad" < 70 THEN '🚨 CRÍTICA: REVISAR EQUIPO' ELSE 'Sin Datos' END AS "Estado_Auditoria"
    FROM g""",
)
def block_scorecard(spark, sf_dir):
    report = rp.block_scorecard(audited(spark, sf_dir), SURVEY)
    return select_mapping(report, published.BLOCK_SCORECARD)


_ASSIGNMENT = f"""{_ENUMERATORS}, {_NAMES}, assignment AS (
  SELECT {block_sql('name')} AS block,
         CASE WHEN e.users IS NULL THEN NULL WHEN e.users = 'not_yet' THEN '🚫 No Asignada'
              ELSE coalesce(enumerator_name, e.users) END AS assigned_agent
  FROM enumerators e LEFT JOIN names n ON e.users IS NOT DISTINCT FROM n.users)"""
_TARGETS = f"""{_CASES}, {_ASSIGNMENT}, targets AS (
  SELECT t.*, assigned_agent FROM (
    SELECT {block_sql('manzana')} AS block, CAST(count(DISTINCT padron) AS BIGINT) AS units_total
    FROM cases WHERE id <> 1 GROUP BY 1) t LEFT JOIN assignment USING (block))"""


@query("enumerator_assignment", f"WITH {_ASSIGNMENT} SELECT block, assigned_agent FROM assignment")
def enumerator_assignment(spark, sf_dir):
    return rp.block_assignment(_enumerators(spark, sf_dir), _names(spark, sf_dir))


@query("block_targets", f"WITH {_TARGETS} SELECT block, units_total, assigned_agent FROM targets")
def block_targets(spark, sf_dir):
    assignment = rp.block_assignment(_enumerators(spark, sf_dir), _names(spark, sf_dir))
    return rp.block_targets(_cases(spark, sf_dir), assignment)


_WORK = f"""work AS (
  SELECT {block_sql('manzana_pull')} AS block,
    {count_sql("category = 'EFECTIVA' AND audit_pass = 1")} AS effective,
    {count_sql("category = 'RECHAZO' AND audit_pass = 1")} AS refusals,
    {count_sql("category = 'NO ELEGIBLE' AND audit_pass = 1")} AS not_eligible,
    {count_sql("category = 'AGENDADA/PENDIENTE' AND audit_pass = 1")} AS scheduled,
    CAST(count(DISTINCT padron_pull) AS BIGINT) AS units_visited,
    {count_sql("audit_alert = 1 AND category <> 'AGENDADA/PENDIENTE'")} AS in_review,
    {list_sql('tecnico_pull')} AS agents, {list_sql('ident_enc_resp')} AS interviewers,
    arg_min(supervisor_pull, (coalesce(padron_pull, 9223372036854775807), key)) AS supervisor,
    min(CAST(submission_date AS DATE)) AS first_visit, max(CAST(submission_date AS DATE)) AS last_visit,
    {count_sql('status_num = 9')} AS status_9, {count_sql('status_num = 10')} AS status_10,
    max(CAST(submission_date AS DATE)) - min(CAST(submission_date AS DATE)) + 1 AS days_active
  FROM audited WHERE is_final = 1 GROUP BY 1)"""


@query(
    "block_work",
    f"""WITH {AUDITED}, {_WORK} SELECT * REPLACE (CAST(days_active AS INT) AS days_active) FROM work""",
)
def block_work(spark, sf_dir):
    return rp.block_work(audited(spark, sf_dir).filter("is_final = 1"), SURVEY)


_PROGRESS = f"""{AUDITED}, {_TARGETS}, {_WORK},
joined AS (
  SELECT t.*, w.* EXCLUDE (block, effective, refusals, not_eligible, scheduled, in_review, units_visited, status_9, status_10),
    coalesce(effective, 0) AS effective, coalesce(refusals, 0) AS refusals,
    coalesce(not_eligible, 0) AS not_eligible, coalesce(scheduled, 0) AS scheduled,
    coalesce(in_review, 0) AS in_review, coalesce(units_visited, 0) AS units_visited,
    coalesce(status_9, 0) AS status_9, coalesce(status_10, 0) AS status_10
  FROM targets t LEFT JOIN work w ON t.block = w.block),
rates AS (
  SELECT *, greatest(0, units_total - units_visited) AS not_visited,
    {rate_sql('units_visited', 'units_total')} AS percent_visited,
    {rate_sql('(effective + refusals + not_eligible)', 'units_total')} AS percent_progress,
    DATE '2001-06-01' - last_visit AS days_idle FROM joined),
progress AS (
  SELECT block, supervisor, assigned_agent AS agent, interviewers, units_total, not_visited, effective, refusals,
    not_eligible, scheduled, in_review, percent_visited, percent_progress, first_visit, last_visit,
    CAST(days_active AS INT) AS days_active, CAST(days_idle AS INT) AS days_idle,
    CASE WHEN status_9 > 0.5 * units_total THEN '🚨 Mayoria Sin Red' ELSE '' END
      || CASE WHEN in_review > 0 THEN ' | 🔍 ' || in_review || ' alertas' ELSE '' END AS block_alerts,
    CASE WHEN assigned_agent = '🚫 No Asignada' THEN '📁 NO ASIGNADA'
         WHEN percent_progress = 100 AND in_review > 0 THEN '🔍 PENDIENTE AUDITORÍA'
         WHEN percent_progress >= 100 AND in_review = 0 THEN '🟢 COMPLETA'
         WHEN units_visited = 0 THEN '⚪ SIN EMPEZAR'
         WHEN days_idle > 4 AND not_visited > 0 THEN '🔥 MANZANA INACTIVA'
         WHEN percent_visited >= 100 AND scheduled > 0 THEN '🟡 REVISITAR (Pendientes)'
         ELSE '🔵 EN PROCESO' END AS light
  FROM rates)"""


def progress(spark, sf_dir, done=None):
    assignment = rp.block_assignment(_enumerators(spark, sf_dir), _names(spark, sf_dir))
    targets = rp.block_targets(_cases(spark, sf_dir), assignment)
    done = audited(spark, sf_dir).filter("is_final = 1") if done is None else done
    return rp.block_progress(targets, rp.block_work(done, SURVEY), RUN_DATE)


@query(
    "block_progress",
    "WITH " + _PROGRESS + " SELECT "
    + ", ".join(f'{src} AS "{out}"' for out, src in published.BLOCK_PROGRESS) + " FROM progress",
)
def block_progress(spark, sf_dir):
    return select_mapping(progress(spark, sf_dir), published.BLOCK_PROGRESS)


# ---- agents ------------------------------------------------------------------------

_AGENT_TARGETS = f"""{_CASES}, {_ENUMERATORS},
per_block AS (
  SELECT name AS block, enumerator_name AS agent, supervisor, CAST(count(DISTINCT padron) AS BIGINT) AS units
  FROM cases JOIN enumerators e ON trim(enumerators) = e.id WHERE users <> 'not_yet' GROUP BY 1, 2, 3),
agent_targets AS (
  SELECT agent, {list_sql('block', ', ')} AS blocks, CAST(sum(units) AS BIGINT) AS target,
         arg_min(supervisor, (block, supervisor)) AS supervisor
  FROM per_block GROUP BY 1)"""


def _agent_targets(spark, sf_dir):
    return rp.agent_targets(
        rp.agent_block_targets(_cases(spark, sf_dir), _enumerators(spark, sf_dir))
    )


@query("agent_block_targets", f"WITH {_AGENT_TARGETS} SELECT block, agent, supervisor, units FROM per_block")
def agent_block_targets(spark, sf_dir):
    return rp.agent_block_targets(_cases(spark, sf_dir), _enumerators(spark, sf_dir))


@query("agent_targets", f"WITH {_AGENT_TARGETS} SELECT agent, blocks, target, supervisor FROM agent_targets")
def agent_targets(spark, sf_dir):
    return _agent_targets(spark, sf_dir)


@query(
    "agent_consolidated",
    f"""WITH {AUDITED}, {_AGENT_TARGETS}, c AS (
      SELECT tecnico_pull AS agent, ident_enc_resp AS interviewer,
        {count_sql("is_final = 1 AND category = 'EFECTIVA'")} AS effective,
        {count_sql("is_final = 1 AND category = 'RECHAZO'")} AS refusals,
        {count_sql("is_final = 1 AND category = 'NO ELEGIBLE'")} AS not_eligible,
        {count_sql("is_final = 1 AND category = 'AGENDADA/PENDIENTE'")} AS scheduled,
        {count_sql("is_final = 1 AND category = 'OTRO/ERROR'")} AS others,
        {count_sql("is_effective = 1 AND audit_alert = 1")} AS effective_with_alert,
        {count_sql("audit_alert = 1")} AS all_alerts
      FROM audited GROUP BY 1, 2)
    SELECT c.agent AS "Técnico", interviewer AS "Encuestador", blocks AS "Manzanas",
      coalesce(target, 0) AS "Metas (Asignados)", effective_with_alert AS "EFECTIVAS CON ALERTA",
      effective AS "EFECTIVAS", refusals AS "RECHAZOS", not_eligible AS "NO_ELEGIBLES",
      scheduled AS "AGENDADAS", others AS "OTROS_ERRORES", all_alerts AS "Total Alertas (Histórico)",
      {rate_sql('(effective + refusals + not_eligible)', 'target')} AS "% Avance Cobertura",
      supervisor AS "Supervisor"
    FROM c LEFT JOIN agent_targets t ON c.agent IS NOT DISTINCT FROM t.agent""",
)
def agent_consolidated(spark, sf_dir):
    report = rp.agent_consolidated(audited(spark, sf_dir), _agent_targets(spark, sf_dir), SURVEY)
    return select_mapping(report, published.AGENT_CONSOLIDATED)


@query(
    "agent_productivity",
    f"""WITH {AUDITED}, g AS (
      SELECT tecnico_pull AS agent, ident_enc_resp AS interviewer, CAST(count(*) AS BIGINT) AS units,
        {count_sql("category = 'EFECTIVA'")} AS effective, {count_sql("category = 'RECHAZO'")} AS refusals,
        {count_sql("category = 'NO ELEGIBLE'")} AS not_eligible,
        {count_sql("category = 'AGENDADA/PENDIENTE'")} AS scheduled,
        coalesce(round(CAST(avg(duration_min) FILTER (WHERE is_effective = 1) AS DECIMAL(38, 10)), 1)::DOUBLE, 0) AS mean_minutes,
        {count_sql("is_effective = 1 AND grupo_3 = '1' AND p10_13 = '1'")} AS simple_schemes,
        {count_sql("is_effective = 1 AND grupo_4 = '1' AND p10_13 = '1'")} AS detailed_schemes,
        {count_sql("is_effective = 1 AND flag_geofencing = 1")} AS alerts_gps,
        {count_sql("is_effective = 1 AND flag_duration_outlier = 1")} AS alerts_time,
        {count_sql("is_effective = 1 AND flag_garbage_text = 1")} AS alerts_garbage,
        {count_sql("is_effective = 1 AND flag_nsnr = 1")} AS alerts_nsnr,
        {count_sql("is_effective = 1 AND flag_extreme_values = 1")} AS alerts_outliers,
        {count_sql("is_effective = 1 AND flag_duplicated = 1")} AS alerts_duplicates,
        {count_sql("is_effective = 1 AND flag_missing = 1")} AS alerts_missing
      FROM audited WHERE is_final = 1 GROUP BY 1, 2),
    r AS (SELECT *, coalesce({rate_sql('(alerts_gps + alerts_time + alerts_garbage + alerts_nsnr + alerts_outliers)', 'effective')}, 0) AS error_rate FROM g)
    SELECT {', '.join(f'{src} AS "{out}"' for out, src in published.AGENT_PRODUCTIVITY)} FROM r""",
)
def agent_productivity(spark, sf_dir):
    final = audited(spark, sf_dir).filter("is_final = 1")
    return select_mapping(rp.agent_productivity(final, SURVEY), published.AGENT_PRODUCTIVITY)


@query(
    "agent_report",
    f"""WITH {_PROGRESS}, blocks AS (
      SELECT agent, CAST(count(DISTINCT block) AS BIGINT) AS blocks, CAST(sum(units_total) AS BIGINT) AS units_total,
             CAST(sum(effective + refusals + not_eligible) AS BIGINT) AS closed FROM progress GROUP BY 1),
    effort AS (SELECT tecnico_pull AS agent, count(*) AS visits_made, {count_sql("category = 'EFECTIVA'")} AS effective_visits
               FROM audited GROUP BY 1),
    states AS (SELECT tecnico_pull AS agent, {count_sql('status_num = 4')} AS appointments, {count_sql('status_num = 2')} AS absent,
                 CAST(count(DISTINCT padron_pull) + max(CAST(padron_pull IS NULL AS INT)) AS BIGINT) AS units_visited
               FROM audited WHERE is_final = 1 GROUP BY 1)
    SELECT b.agent AS "Técnico", blocks AS "# Manzanas", units_total AS "Padrones Totales",
      coalesce(units_visited, 0) AS "Padrones Visitados",
      coalesce({rate_sql('units_visited', 'units_total')}, 0) AS "% Recorrido",
      coalesce({rate_sql('closed', 'units_total')}, 0) AS "% Avance Real",
      coalesce({rate_sql('effective_visits', 'visits_made')}, 0) AS "Tasa de efectividad",
      coalesce(appointments, 0) AS "# de citas", coalesce(absent, 0) AS "# padrones con ocupantes ausentes"
    FROM blocks b LEFT JOIN effort e ON b.agent IS NOT DISTINCT FROM e.agent
                  LEFT JOIN states s ON b.agent IS NOT DISTINCT FROM s.agent""",
)
def agent_report(spark, sf_dir):
    visits = audited(spark, sf_dir)
    final = visits.filter("is_final = 1")
    cases = visits.select(F.col("tecnico_pull").alias("agent"), F.col("category").alias("result"))
    report = rp.agent_report(progress(spark, sf_dir, final), cases, final, SURVEY)
    return select_mapping(report, published.AGENT_REPORT)


@query(
    "intervention_by_agent",
    f"""WITH {AUDITED} SELECT tecnico_pull,
      {count_sql("grupo_experimento IS NULL")} AS "NA", {count_sql("grupo_experimento = 'CONTROL'")} AS "CONTROL",
      {count_sql("grupo_experimento = 'ESQUEMA FUNCIONAL DETALLADO'")} AS "ESQUEMA FUNCIONAL DETALLADO",
      {count_sql("grupo_experimento = 'ESQUEMA FUNCIONAL SIMPLE'")} AS "ESQUEMA FUNCIONAL SIMPLE",
      {count_sql("coalesce(grupo_experimento, 'NA') NOT IN ('NA', 'CONTROL', 'ESQUEMA FUNCIONAL DETALLADO', 'ESQUEMA FUNCIONAL SIMPLE')")} AS other,
      CAST(count(*) AS BIGINT) AS total
    FROM audited WHERE is_effective = 1 GROUP BY 1""",
)
def intervention_by_agent(spark, sf_dir):
    return rp.intervention_by_agent(audited(spark, sf_dir, final=False), SURVEY)


# ---- days --------------------------------------------------------------------------

_DETAIL = (
    "count(DISTINCT coalesce(tecnico_pull, 'NA') || ' ' || coalesce(ident_enc_resp, 'NA'))",
    count_sql("p10_09 = '1' AND status_num = 1"),
    count_sql("CAST(p10_09 AS DOUBLE) BETWEEN 2 AND 9 AND status_num = 1"),
    count_sql("grupo_experimento = 'ESQUEMA FUNCIONAL SIMPLE' AND status_num = 1"),
    count_sql("grupo_experimento = 'ESQUEMA FUNCIONAL DETALLADO' AND status_num = 1"),
    count_sql("grupo_experimento = 'CONTROL' AND status_num = 1"),
)
_DAY_SQL = f"""{AUDITED}, detail AS (
  SELECT day, {', '.join(f'CAST({sql} AS BIGINT) AS "{n}"' for n, sql in zip(rp.DETAIL_INDICATORS, _DETAIL))}
  FROM audited WHERE is_final = 1 GROUP BY 1),
status AS (
  SELECT day, {', '.join(f'{count_sql(f"status_num = {i}")} AS "{n}"' for i, n in enumerate(rp.STATUS_INDICATORS, start=1))}
  FROM audited GROUP BY 1)"""


def _days(spark, sf_dir):
    visits = audited(spark, sf_dir)
    return rp.daily_detail(visits, SURVEY), rp.daily_status(visits, SURVEY)


@query("daily_detail", f"WITH {_DAY_SQL} SELECT * FROM detail")
def daily_detail(spark, sf_dir):
    return _days(spark, sf_dir)[0]


@query("daily_status", f"WITH {_DAY_SQL} SELECT * FROM status")
def daily_status(spark, sf_dir):
    return _days(spark, sf_dir)[1]


# Months the orders of every scale cover; the sheet's columns are given, and any other month would be an error.
MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13)]


@query(
    "daily_progress_wide",
    f"""WITH {_DAY_SQL}, both_tables AS (
      SELECT coalesce(d.day, s.day) AS day, d.* EXCLUDE (day), s.* EXCLUDE (day)
      FROM detail d FULL JOIN status s ON d.day IS NOT DISTINCT FROM s.day),
    long AS (UNPIVOT both_tables ON COLUMNS(* EXCLUDE (day)) INTO NAME "Indicador" VALUE v)
    SELECT "Indicador", {', '.join(f"CAST(coalesce(sum(v) FILTER (WHERE day = '{m}'), 0) AS BIGINT) AS \"{m}\"" for m in MONTHS)}
    FROM long GROUP BY 1""",
)
def daily_progress_wide(spark, sf_dir):
    detail, status = _days(spark, sf_dir)
    return rp.daily_progress(detail, status, MONTHS)


@query(
    "coverage_by_day",
    f"""WITH {AUDITED} SELECT day, {count_sql('o = 0')} AS "0", {count_sql('o = 1')} AS "1" FROM (
      SELECT day, CAST(p10_13 = '1' AS INT) AS o FROM audited WHERE category = 'EFECTIVA') GROUP BY 1""",
)
def coverage_by_day(spark, sf_dir):
    """Effective interviews by day, with and without a recording."""
    df = audited(spark, sf_dir, final=False).withColumn("has_audio", (F.col("p10_13") == "1").cast("int"))
    return rp.audio_coverage(df, SURVEY)
