"""Flags, verdicts, labels and alert texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from canvass.catalog.quality import RULES, form_answers
from canvass.catalog.registry import AUDITED, INTERVIEWS, interviews, query, table
from canvass.functions.columns import select_mapping
from canvass.functions.rules import category
from canvass.operators import formlogic, verdicts, visits
from canvass.operators.summaries import summarise
from canvass.plans import published
from canvass.plans import reports as rp
from canvass.plans import survey as sv
from canvass.plans.survey import Survey

SURVEY = Survey()


def audited(spark, sf_dir, final: bool = True):
    """Interviews with flags and verdicts, and optionally the final-visit flag."""
    df = interviews(spark, sf_dir).withColumns(
        {
            "category": category("status_num", sv.CATEGORIES, sv.OTHER),
            "is_effective": (F.col("status_num") == 1).cast("int"),
        }
    )
    df = verdicts.binary_flags(
        df,
        {
            "flag_refusal": F.col("status_num") == 5,
            "flag_skips": F.col("total_skips") > 0,
            "flag_missing": F.col("total_missing") > 0,
            "flag_duration_outlier": F.col("duration_min") > 45,
            "flag_extreme_values": F.col("total_extremes") > 0,
            "flag_duplicated": F.col("total_dup") == 1,
            "flag_geofencing": F.col("distance_m") > 24,
            "flag_nsnr": F.col("alert_nsnr") == 1,
        },
    )
    df = verdicts.verdicts(
        df, "category", always_pass=(sv.REFUSAL, sv.NOT_ELIGIBLE), can_alert=(sv.EFFECTIVE,)
    )
    if not final:
        return df
    return visits.mark_latest(df, "padron_pull", "submission_date", "key")


_FLAGS = ", ".join([*verdicts.VERDICT_FLAGS, "flag_skips", "flag_refusal"])


@query("audit_flags", f"WITH {AUDITED} SELECT key, {_FLAGS} FROM audited")
def audit_flags(spark, sf_dir):
    return audited(spark, sf_dir, final=False).select("key", *_FLAGS.split(", "))


@query("audit_verdicts", f"WITH {AUDITED} SELECT key, category, audit_pass, audit_alert FROM audited")
def audit_verdicts(spark, sf_dir):
    df = audited(spark, sf_dir, final=False)
    return df.select("key", "category", "audit_pass", "audit_alert")


@query(
    "audit_table",
    f"""WITH {AUDITED} SELECT key, padron_pull, tecnico_pull, category, {_FLAGS}, audit_pass, audit_alert,
        total_missing, total_skips FROM audited""",
)
def audit_table(spark, sf_dir):
    return verdicts.audit_table(
        audited(spark, sf_dir, final=False),
        ["key", "padron_pull", "tecnico_pull", "category"],
        ["audit_pass", "audit_alert"],
        ["total_missing", "total_skips", "not_there"],
    )


_LABELS = ", ".join(
    f"CASE WHEN {flag} = 1 THEN '{yes}' ELSE '{no}' END AS {out}"
    for out, (flag, yes, no) in verdicts.LABELS.items()
)


@query("flag_labels", f"WITH {AUDITED} SELECT key, {_LABELS} FROM audited")
def flag_labels(spark, sf_dir):
    out = verdicts.add_flag_labels(audited(spark, sf_dir, final=False))
    return out.select("key", *verdicts.LABELS)


@query(
    "presence_flag",
    """SELECT c_custkey, CAST(nullif(c_mktsegment, 'BUILDING') IS NOT NULL AS INT) AS has_audio FROM customer""",
)
def presence_flag(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn(
        "audio", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    )
    return verdicts.presence_flag(customers, "audio", "has_audio").select("c_custkey", "has_audio")


_PIECES = """concat_ws(' | ',
    CASE WHEN flag_geofencing = 1 THEN '📍 GPS: ' || CAST(CAST(round(distance_m, 0) AS BIGINT) AS VARCHAR) || 'm fuera' END,
    CASE WHEN flag_duration_outlier = 1 THEN '⏱️ Duración: ' || regexp_replace(printf('%.1f', round(CAST(duration_min AS DECIMAL(38, 10)), 1)), '\\.0$', '') || 'm' END,
    CASE WHEN flag_garbage_text = 1 THEN '🗑️ Basura: ' || coalesce(garbage_detail, 'NA') END,
    CASE WHEN flag_nsnr = 1 THEN '❓ NS/NR: ' || coalesce(nsnr_detail, 'NA') END,
    CASE WHEN flag_extreme_values = 1 THEN '📈 Valor: ' || coalesce(outlier_detail, 'NA') END,
    CASE WHEN flag_duplicated = 1 THEN '👥 DUPLICADO: ' || identity END,
    CASE WHEN flag_missing = 1 THEN coalesce(missing_detail, 'NA') END)"""


@query(
    "alert_table",
    f"""WITH {AUDITED} SELECT
      CASE WHEN flag_duplicated = 1 OR flag_garbage_text = 1 THEN '🔴 CRÍTICO'
           WHEN flag_geofencing = 1 OR flag_extreme_values = 1 THEN '🟡 ADVERTENCIA'
           ELSE '🔵 REVISIÓN' END AS "Status",
      key AS "ID Encuesta", starttime AS "Fecha", supervisor_pull AS "Supervisor",
      tecnico_pull AS "Tecnico", ident_enc_resp AS "Encuestador", manzana_pull AS "Manzana",
      padron_pull AS "Padron", category AS "Tipo de encuesta",
      CASE WHEN flag_duplicated = 1 THEN 'Revisar registro'
           WHEN flag_garbage_text = 1 THEN 'Revisar texto'
           WHEN flag_geofencing = 1 THEN 'Verificar ubicación'
           WHEN flag_extreme_values = 1 THEN 'Confirmar dato numérico'
           WHEN flag_missing = 1 THEN 'Revisar datos faltantes'
           WHEN flag_nsnr = 1 THEN 'Revisar cantidad atipica de NSNR'
           WHEN flag_duration_outlier = 1 THEN 'Duración atipica'
           ELSE 'Revisión general' END AS "Accion",
      {_PIECES} AS "Alertas Detalladas"
    FROM audited WHERE audit_alert = 1""",
)
def alert_table(spark, sf_dir):
    report = rp.alert_table(audited(spark, sf_dir, final=False), SURVEY)
    return select_mapping(report, published.ALERT_TABLE)


@query(
    "detail_texts",
    r"""WITH f AS (
      SELECT c_custkey AS id, nullif(c_mktsegment, 'MACHINERY') AS segment,
             CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS balance,
             CASE WHEN c_nationkey % 6 <> 0 THEN c_nationkey END AS nation FROM customer)
    SELECT id,
      nullif(concat_ws(' | ',
        CASE WHEN coalesce(nation < 10, FALSE) AND segment IS NULL THEN '🚫 Faltante: Segmento' END,
        CASE WHEN balance IS NULL THEN '🚫 Faltante: balance' END,
        CASE WHEN coalesce(balance > 0, FALSE) AND nation IS NULL THEN '🚫 Faltante: nation' END), '') AS missing_detail,
      nullif(concat_ws(', ', CASE WHEN CAST(nation AS VARCHAR) IN ('-1', '98', '99', '7') THEN 'nation' END,
                             CASE WHEN segment IN ('BUILDING') THEN 'segment' END), '') AS hits
    FROM f""",
)
def detail_texts(spark, sf_dir):
    flagged = formlogic.flag_missing(form_answers(spark, sf_dir), RULES)
    hits = verdicts.detail_text(
        [
            verdicts.Item(F.col("nation").cast("string").isin("-1", "98", "99", "7"), F.lit("nation")),
            verdicts.Item(F.col("segment") == "BUILDING", F.lit("segment")),
        ],
        ", ",
    )
    missing = verdicts.missing_detail(["segment", "balance", "nation"], {"segment": "Segmento"})
    return flagged.select("id", missing.alias("missing_detail"), hits.alias("hits"))


@query(
    "garbage_detail",
    """SELECT p_partkey, nullif(concat_ws(' | ',
          CASE WHEN p_name LIKE '%rod%' THEN 'p_name: ''' || p_name || '''' END), '') AS detail FROM part""",
)
def garbage_detail(spark, sf_dir):
    """The text shown for a garbage answer, with a hand-set flag in place of the test."""
    df = table(spark, sf_dir, "part").withColumns(
        {"trash_p_name": F.col("p_name").contains("rod").cast("int"), "trash_p_brand": F.lit(0)}
    )
    return df.select("p_partkey", verdicts.garbage_detail(["p_brand", "p_name"]).alias("detail"))


@query(
    "outlier_detail",
    """SELECT event_id, CASE WHEN value > 200 THEN 'Valor: [' || regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') || ']' END AS detail
       FROM events""",
)
def outlier_detail(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("ex_value", (F.col("value") > 200).cast("int"))
    return df.select("event_id", verdicts.outlier_detail(["value"], {"value": "Valor"}).alias("detail"))


@query(
    "alert_totals",
    f"""WITH {AUDITED} SELECT category, CAST(sum(audit_pass) AS BIGINT) AS passed,
        CAST(sum(audit_alert) AS BIGINT) AS alerts, CAST(sum(audit_pass * audit_alert) AS BIGINT) AS both_verdicts
        FROM audited GROUP BY category""",
)
def alert_totals(spark, sf_dir):
    df = audited(spark, sf_dir, final=False)
    return summarise(
        df,
        {"category": "category"},
        {
            "passed": F.sum("audit_pass"),
            "alerts": F.sum("audit_alert"),
            "both_verdicts": F.sum(F.col("audit_pass") * F.col("audit_alert")),
        },
    )


@query(
    "scheme_review",
    f"""WITH {INTERVIEWS} SELECT padron_pull AS "PADRÓN", day AS "FECHA", supervisor_pull AS "SUPERVISOR", tecnico_pull AS "TÉCNICO",
      ident_enc_resp AS "ENCUESTADOR", status_survey_resp AS "FUENTE", p10_09 AS "TIPO DE CONEXIÓN", grupo_experimento AS "TIPO DE ESQUEMA",
      concat(CAST(key AS VARCHAR), '.jpg') AS "FOTO FRENTE ESQUEMA", identity AS "FOTO REVERSO ESQUEMA",
      '' AS "STATUS DE REVISIÓN", '' AS "COMENTARIOS DE LA ARQUI"
    FROM interviews WHERE grupo_3 = '1' OR grupo_4 = '1'""",
)
def scheme_review(spark, sf_dir):
    """The published sheet with all of its columns."""
    rows = interviews(spark, sf_dir).withColumns({
        "fuente_resp": F.col("status_survey_resp"),
        "p10_09_resp": F.col("p10_09"),
        "foto_ef_anverso": F.concat(F.col("key").cast("string"), F.lit(".jpg")),
        "foto_ef_reverso": F.col("identity"),
    })
    return rp.scheme_review(rows, published.SCHEME_REVIEW_FLAGS, published.SCHEME_REVIEW, published.SCHEME_REVIEW_BLANKS)
