"""The whole audit over survey submissions that Spark derives from orders and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from canvass.catalog.geo import HALF, _utm_sql
from canvass.catalog.registry import query, table
from canvass.catalog.texts import garbage_sql, squish_sql
from canvass.functions.columns import select_mapping
from canvass.functions.geo import with_utm
from canvass.operators.formlogic import FormRule
from canvass.plans import audit, published
from canvass.plans import reports as rp
from canvass.plans.survey import ManualInputs, Survey

SURVEY = Survey(test_days=("Jan 5, 1997",), date_floor="1996-01-01", k_short=1.6, k_long=1.7, k_numeric=1.5, min_nsnr=3)
RULES = [
    FormRule("p1_07", required=True, relevant="status_survey = '1'", label="People"),
    FormRule("p2_02", required=True, relevant="p1_07 > '3'", label="Age"),
    FormRule("p7_05", required=False, relevant="status_survey IN ('1', '2', '3')", label="Remarks"),
    FormRule("status_survey", required=True, relevant="p4_04 IS NOT NULL", label="Status"),
]
LABELS = {"p1_07": "People"}

# Answers as text, the same expressions for both engines.
_ANSWERS = {
    "key": "concat('uuid:', CAST(o_orderkey AS STRING))",
    "id": "CAST(c_custkey AS STRING)",
    "padron_pull": "CASE WHEN c_custkey % 50 <> 0 THEN CAST(c_custkey AS STRING) END",
    "manzana_pull": "CAST(c_nationkey AS STRING)",
    "tecnico_pull": "concat('T', CAST(o_orderkey % 10 AS STRING))",
    "ident_enc_resp": "concat('E', CAST(o_orderkey % 7 AS STRING))",
    "supervisor_pull": "concat('S', CAST(c_nationkey % 3 AS STRING))",
    "duration": "CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_orderkey * 7919 % 5000 AS STRING) ELSE 'n/a' END",
    "status_survey": "substr(o_orderpriority, 1, 1)",
    "status_survey_resp": "o_orderpriority",
    "pub_status": "o_orderpriority",
    "pub_comentario": (
        "CASE o_orderkey % 7 WHEN 0 THEN 'No quiso responder' WHEN 1 THEN ' Volver MAÑANA ' "
        "WHEN 2 THEN 'todo OK' ELSE c_mktsegment END"
    ),
    "grupo_experimento": "o_orderstatus",
    "audio_encuesta": "CASE WHEN o_orderkey % 3 = 0 THEN 'a.mp3' END",
    "p1_07": "CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderkey * 31 % 9 AS STRING) END",
    "p2_02": "CASE WHEN o_orderkey % 9 = 0 THEN '99' WHEN o_orderkey % 9 < 7 THEN CAST(o_orderkey * 17 % 90 AS STRING) END",
    "p4_04": "CASE WHEN o_orderkey % 4 = 0 THEN ' 98 ' WHEN o_orderkey % 4 < 3 THEN '5' END",
    "p4_05": "CASE WHEN o_orderkey % 6 < 2 THEN '99' ELSE '1' END",
    "p5_08": "CASE WHEN o_orderkey % 5 < 2 THEN '-1' ELSE 'x' END",
    "p7_05": "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 15 = 1 THEN 'asdfgh' WHEN o_orderkey % 15 = 2 THEN 'aaaaaaaa' ELSE c_mktsegment END",
    "p11_02_nombre": "CASE WHEN o_orderkey % 3 <> 0 THEN concat('José ', CAST(c_custkey % 20 AS STRING)) END",
    "p11_02_apellido": "CASE WHEN o_orderkey % 6 <> 0 THEN 'Núñez' END",
    "p11_03a": "CAST(c_nationkey AS STRING)",
    "nombre_contacto": "c_name",
    "telefono": "CAST(o_orderkey % 4 AS STRING)",
}
_LON = "-56.1 + (c_custkey % 100) * 0.001 + (o_orderkey % 40) * 0.00001"
_LAT = "-34.85 + floor(c_custkey / 100) * 0.001"


def survey_raw(spark, sf_dir):
    """Submissions as the form server delivers them: every column a text."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    at = F.col("o_orderdate").cast("timestamp")
    clock = "MMM d, yyyy h:mm:ss a"
    placed = F.col("o_orderkey") % 19 != 0
    return joined.select(
        *[F.expr(sql).alias(name) for name, sql in _ANSWERS.items()],
        F.date_format(at, "MMM d, yyyy").alias("day"),
        F.date_format(at + F.make_dt_interval(hours=F.lit(14)), clock).alias("submission_date"),
        F.date_format(at + F.make_dt_interval(hours=F.lit(13)), clock).alias("starttime"),
        F.when(placed, F.expr(_LON).cast("string")).alias("georeferenciacion_longitude"),
        F.when(placed, F.expr(_LAT).cast("string")).alias("georeferenciacion_latitude"),
    )


def survey_polygons(spark, sf_dir):
    """A box around the place of each customer; every 13th has none."""
    key = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").filter(key % 13 != 0)
    placed = with_utm(
        customers, -56.1 + (key % 100) * 0.001, -34.85 + F.floor(key / 100) * 0.001, SURVEY.utm_zone
    )
    x, y = F.round("utm_x").cast("bigint"), F.round("utm_y").cast("bigint")
    text = F.format_string(
        "POLYGON ((%d %d, %d %d, %d %d, %d %d, %d %d))",
        x - HALF, y - HALF, x + HALF, y - HALF, x + HALF, y + HALF, x - HALF, y + HALF,
        x - HALF, y - HALF,
    )
    return placed.select(key.cast("string").alias("padron"), text.alias("wkt_geom"))


def run(spark, sf_dir):
    accepted = ["uuid:1", "uuid:2", "uuid:3"]
    return audit.run_audit(
        survey_raw(spark, sf_dir), survey_polygons(spark, sf_dir), RULES, survey=SURVEY,
        manual=ManualInputs(accepted_duplicates=accepted), labels=LABELS,
    )


def _clean(x: str) -> str:
    n = f"TRY_CAST({x} AS DOUBLE)"
    return f"CASE WHEN {n} NOT IN (-1, 98, 99) THEN {n} END"


def _extreme(q: str) -> str:
    n = f"TRY_CAST({q} AS DOUBLE)"
    return f"CASE WHEN sd_{q} > 0 THEN CAST(abs({n} - mu_{q}) > 1.5 * sd_{q} AND {n} <> mu_{q} AS INT) ELSE 0 END"


_CAPITALS = "translate(upper({x}), 'ÁÉÍÓÚÑ', 'AEIOUN')"


def _identity(person: str, contact: str) -> str:
    raw = f"""CASE WHEN status_survey = '1' THEN {person} WHEN status_survey = '4' THEN {contact}
              ELSE coalesce(padron_pull, 'NA') || '_' || status_survey_resp END"""
    return squish_sql(_CAPITALS.format(x=raw))


_NAME = "coalesce(p11_02_nombre, 'NA') || '_' || coalesce(p11_02_apellido, 'NA')"
_NSNR = " + ".join(f"CAST(coalesce(trim({q}) IN ('-1', '98', '99'), FALSE) AS INT)" for q in ("p4_04", "p4_05", "p5_08"))

SURVEY_SQL = f"""
raw AS (
  SELECT {', '.join(f'{sql} AS {name}' for name, sql in _ANSWERS.items()).replace('STRING', 'VARCHAR')},
         CAST(c_custkey AS BIGINT) AS cust, o_orderdate + INTERVAL 11 HOUR AS submitted,
         o_orderdate + INTERVAL 10 HOUR AS started, CAST(o_orderdate AS DATE) AS d, o_orderkey,
         {_LON} AS lon, {_LAT} AS lat
  FROM orders JOIN customer ON o_custkey = c_custkey),
kept AS (SELECT * FROM raw WHERE d <> DATE '1997-01-05' AND submitted >= DATE '1996-01-01' AND started >= DATE '1996-01-01'),
final AS (
  SELECT *, CASE status_survey WHEN '1' THEN 'EFECTIVA' WHEN '5' THEN 'RECHAZO' ELSE 'AGENDADA/PENDIENTE' END AS category,
         TRY_CAST(duration AS DOUBLE) / 60 AS minutes, {_NSNR} AS total_nsnr
  FROM kept QUALIFY row_number() OVER (PARTITION BY padron_pull ORDER BY submitted DESC, key) = 1),
figures AS (
  SELECT category, avg(minutes) AS mu, stddev_samp(minutes) AS sd,
         avg({_clean('p1_07')}) AS mu_p1_07, stddev_samp({_clean('p1_07')}) AS sd_p1_07,
         avg({_clean('p2_02')}) AS mu_p2_02, stddev_samp({_clean('p2_02')}) AS sd_p2_02
  FROM final GROUP BY 1),
checked AS (
  SELECT f.*, CAST(coalesce(minutes < mu - 1.6 * sd, FALSE) AS INT) AS alert_short,
         CAST(coalesce(minutes > mu + 1.7 * sd, FALSE) AS INT) AS alert_long,
         {_extreme('p1_07')} AS ex_p1_07, {_extreme('p2_02')} AS ex_p2_02,
         CAST(status_survey = '1' AND p1_07 IS NULL AS INT) AS m_p1_07,
         CAST(coalesce(p1_07 > '3', FALSE) AND p2_02 IS NULL AS INT) AS m_p2_02,
         CAST(NOT (status_survey = '1') AND p1_07 IS NOT NULL AS INT)
           + CAST(NOT coalesce(p1_07 > '3', FALSE) AND p2_02 IS NOT NULL AS INT)
           + CAST(NOT (status_survey IN ('1', '2', '3')) AND p7_05 IS NOT NULL AS INT)
           + CAST(p4_04 IS NULL AS INT) AS total_skips,
         {_identity(_NAME + " || '_' || p11_03a", "id || '_' || nombre_contacto || '_' || telefono")} AS identity,
         {garbage_sql('p7_05')} AS trash_p7_05
  FROM final f JOIN figures USING (category)),
twins AS (
  SELECT *, CAST(count(*) OVER (PARTITION BY identity) > 1 AND identity <> '' AND key NOT IN ('uuid:1', 'uuid:2', 'uuid:3') AS INT) AS total_dup
  FROM checked),
points AS (SELECT t.*, u.x, u.y FROM twins t, LATERAL ({_utm_sql('lon', 'lat')}) u WHERE o_orderkey % 19 <> 0),
boxes AS (
  SELECT CAST(c_custkey AS VARCHAR) AS unit, round(u.x) AS cx, round(u.y) AS cy
  FROM customer, LATERAL ({_utm_sql('-56.1 + (c_custkey % 100) * 0.001', '-34.85 + floor(c_custkey / 100) * 0.001')}) u
  WHERE c_custkey % 13 <> 0),
placed AS (
  SELECT p.*, CASE WHEN cx IS NOT NULL THEN
           sqrt(greatest(abs(x - cx) - {HALF}, 0) ** 2 + greatest(abs(y - cy) - {HALF}, 0) ** 2) END AS distance_m
  FROM points p LEFT JOIN boxes ON padron_pull = unit),
flagged AS (
  SELECT *, m_p1_07 + m_p2_02 AS total_missing, coalesce(ex_p1_07, 0) + coalesce(ex_p2_02, 0) AS total_extremes,
         CAST(alert_short = 1 OR alert_long = 1 AS INT) AS flag_duration_outlier,
         CAST(coalesce(ex_p1_07, 0) + coalesce(ex_p2_02, 0) > 0 AS INT) AS flag_extreme_values,
         total_dup AS flag_duplicated, CAST(coalesce(distance_m > 15, FALSE) AS INT) AS flag_geofencing,
         CAST(m_p1_07 + m_p2_02 > 0 AS INT) AS flag_missing, CAST(total_nsnr >= 3 AS INT) AS flag_nsnr,
         trash_p7_05 AS flag_garbage_text FROM placed),
audited AS (
  SELECT *, CAST(category = 'RECHAZO' OR raised = 0 AS INT) AS audit_pass,
         CAST(category = 'EFECTIVA' AND raised > 0 AS INT) AS audit_alert
  FROM (SELECT *, flag_duration_outlier + flag_extreme_values + flag_duplicated + flag_geofencing + flag_missing
                  + flag_nsnr + flag_garbage_text AS raised FROM flagged))
"""

_COLUMNS = [
    "key", "padron_pull", "category", "total_nsnr", "alert_short", "alert_long", "total_missing",
    "total_skips", "total_extremes", "total_dup", "identity", "trash_p7_05",
    "flag_duration_outlier", "flag_extreme_values", "flag_duplicated", "flag_geofencing",
    "flag_missing", "flag_nsnr", "flag_garbage_text", "audit_pass", "audit_alert",
]


@query("survey_audit", f"WITH {SURVEY_SQL} SELECT {', '.join(_COLUMNS)}, round(distance_m, 3) AS distance_m FROM audited")
def survey_audit(spark, sf_dir):
    out = run(spark, sf_dir).audited
    return out.select(*_COLUMNS, F.round("distance_m", 3).alias("distance_m"))


@query(
    "survey_alerts",
    f"""WITH {SURVEY_SQL} SELECT key AS "ID Encuesta", padron_pull AS "Padron",
      CASE WHEN flag_duplicated = 1 OR flag_garbage_text = 1 THEN '🔴 CRÍTICO'
           WHEN flag_geofencing = 1 OR flag_extreme_values = 1 THEN '🟡 ADVERTENCIA'
           ELSE '🔵 REVISIÓN' END AS "Status",
      concat_ws(' | ',
        CASE WHEN flag_geofencing = 1 THEN '📍 GPS: ' || CAST(CAST(round(distance_m) AS BIGINT) AS VARCHAR) || 'm fuera' END,
        CASE WHEN flag_duration_outlier = 1 THEN
          '⏱️ Duración: ' || regexp_replace(CAST(round(CAST(minutes AS DECIMAL(30, 12)), 1)::DECIMAL(30, 1) AS VARCHAR), '[.]0$', '') || 'm' END,
        CASE WHEN flag_garbage_text = 1 THEN '🗑️ Basura: p7_05: ''' || p7_05 || '''' END,
        CASE WHEN flag_nsnr = 1 THEN '❓ NS/NR: ' || concat_ws(', ',
          {', '.join(f"CASE WHEN trim({q}) IN ('-1', '98', '99') THEN '{q}' END" for q in ('p4_04', 'p4_05', 'p5_08'))}) END,
        CASE WHEN flag_extreme_values = 1 THEN '📈 Valor: ' || concat_ws(' | ',
          CASE WHEN ex_p1_07 = 1 THEN 'People: [' || p1_07 || ']' END,
          CASE WHEN ex_p2_02 = 1 THEN 'p2_02: [' || p2_02 || ']' END) END,
        CASE WHEN flag_duplicated = 1 THEN '👥 DUPLICADO: ' || identity END,
        CASE WHEN flag_missing = 1 THEN concat_ws(' | ',
          CASE WHEN m_p1_07 = 1 THEN '🚫 Faltante: People' END, CASE WHEN m_p2_02 = 1 THEN '🚫 Faltante: p2_02' END) END) AS "Alertas"
      FROM audited WHERE audit_alert = 1""",
)
def survey_alerts(spark, sf_dir):
    """The alert sheet of the whole audit."""
    report = rp.alert_table(run(spark, sf_dir).audited, SURVEY)
    sheet = select_mapping(report, published.ALERT_TABLE)
    return sheet.select("ID Encuesta", "Padron", "Status", F.col("Alertas Detalladas").alias("Alertas"))


@query(
    "survey_scorecard",
    f"""WITH {SURVEY_SQL} SELECT 'Manzana ' || coalesce(regexp_extract(manzana_pull, '\\d+'), 'NA') AS block, CAST(count(*) AS BIGINT) AS units_visited,
      CAST(sum(CAST(category = 'EFECTIVA' AS INT)) AS BIGINT) AS effective,
      CAST(sum(flag_geofencing) AS BIGINT) AS alerts_gps, CAST(sum(flag_garbage_text) AS BIGINT) AS alerts_garbage,
      CAST(sum(flag_duration_outlier) AS BIGINT) AS alerts_time, CAST(sum(flag_duplicated) AS BIGINT) AS alerts_duplicates,
      CAST(sum(flag_nsnr) AS BIGINT) AS alerts_nsnr, CAST(sum(flag_extreme_values) AS BIGINT) AS alerts_outliers,
      round(CAST(avg(total_missing) AS DECIMAL(38, 12)), 2)::DOUBLE AS mean_missing,
      round(CAST(avg(total_skips) AS DECIMAL(38, 12)), 2)::DOUBLE AS mean_skips,
      CAST(sum(audit_alert) AS BIGINT) AS with_alert, CAST(sum(audit_pass) AS BIGINT) AS passed,
      round(CAST(CAST(sum(audit_pass) AS DOUBLE) / count(*) * 100 AS DECIMAL(38, 12)), 1)::DOUBLE AS quality_index,
      arg_min(supervisor_pull, (coalesce(padron_pull, '~'), key)) FILTER (WHERE supervisor_pull IS NOT NULL) AS supervisor,
      string_agg(DISTINCT tecnico_pull, ' | ' ORDER BY tecnico_pull) AS teams,
      CASE WHEN round(CAST(CAST(sum(audit_pass) AS DOUBLE) / count(*) * 100 AS DECIMAL(38, 12)), 1) >= 90 THEN '✅ ALTA CALIDAD'
           WHEN round(CAST(CAST(sum(audit_pass) AS DOUBLE) / count(*) * 100 AS DECIMAL(38, 12)), 1) >= 70 THEN '⚠️ REVISIÓN LEVE'
           ELSE '🚨 CRÍTICA: REVISAR EQUIPO' END AS quality_band
    FROM audited GROUP BY 1""",
)
def survey_scorecard(spark, sf_dir):
    """All columns of the block scorecard of the whole audit."""
    return rp.block_scorecard(run(spark, sf_dir).audited, SURVEY).select(*[source for _, source in published.BLOCK_SCORECARD])


@query(
    "survey_discrepancies",
    f"""WITH {SURVEY_SQL}, said AS (
      SELECT *, CASE o_orderkey % 7 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 1 END AS comment_code,
             CASE o_orderkey % 7 WHEN 0 THEN 'RECHAZO' WHEN 1 THEN 'CITA' WHEN 2 THEN 'COMPLETA' END AS comment_label
      FROM kept)
    SELECT key, pub_comentario, status_survey, comment_code, comment_label,
           '⚠️ DISCREPANCIA: Marcó ' || status_survey || ' pero escribió ''' || comment_label || '''' AS comment_alert
    FROM said WHERE comment_code IS NOT NULL AND status_survey <> CAST(comment_code AS VARCHAR)""",
)
def survey_discrepancies(spark, sf_dir):
    return run(spark, sf_dir).discrepancies()
