"""Case table, appointments and write-back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from canvass.catalog.alerts import SURVEY
from canvass.catalog.registry import INTERVIEWS, interviews, query, table
from canvass.catalog.texts import squish_sql
from canvass.functions.columns import select_mapping
from canvass.operators.corrections import upsert
from canvass.operators.visits import latest_only
from canvass.plans import published
from canvass.plans import reports as rp

AS_OF = datetime(1998, 6, 1, 12, 0)


@query(
    "cases_table",
    f"""WITH {INTERVIEWS} SELECT padron_pull AS id_padron, manzana_pull AS manzana, key, starttime AS fecha_visita,
      supervisor_pull AS supervisor, tecnico_pull AS tecnico, ident_enc_resp AS encuestador,
      status_survey_resp AS status, category AS resultado_visita,
      CAST(row_number() OVER (PARTITION BY padron_pull ORDER BY starttime NULLS LAST, key) AS BIGINT) AS intento,
      CAST(row_number() OVER (PARTITION BY padron_pull ORDER BY starttime DESC NULLS LAST, key) = 1 AS INT) AS encuesta_final
    FROM interviews""",
)
def cases_table(spark, sf_dir):
    df = interviews(spark, sf_dir)
    labelled = df.withColumn(
        "category",
        F.when(F.col("status_num") == 1, "EFECTIVA")
        .when(F.col("status_num") == 5, "RECHAZO")
        .otherwise("AGENDADA/PENDIENTE"),
    )
    return select_mapping(rp.cases_table(labelled, SURVEY), published.CASES)


def _case_sheet(spark, sf_dir):
    """Orders as cases with an appointment; ids repeat, some appointments do not parse."""
    at = F.date_format(F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=F.lit(9)), "yyyy-MM-dd HH:mm")
    cita = (
        F.when(F.col("o_orderkey") % 11 == 0, "sin fecha")
        .when(F.col("o_orderkey") % 13 != 0, F.concat(F.lit("Dia: "), F.replace(at, F.lit(" "), F.lit(" Hora: "))))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderkey").alias("case_no"),
        F.when(F.col("o_orderpriority").startswith("4"), "CITA").otherwise(F.col("o_orderpriority")).alias("status"),
        F.col("o_orderstatus").alias("fecha"),
        F.concat(F.lit("T"), (F.col("o_orderkey") % 10).cast("string")).alias("enumerator_name"),
        F.col("o_orderstatus").alias("manzana"),
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("nombre_participante"),
        F.lit("000").alias("telefono_1"),
        cita.alias("cita"),
        (F.col("o_orderkey") % 6).alias("intento"),
    )


@query(
    "appointments_overdue",
    """WITH c AS (
      SELECT o_custkey AS id, o_orderkey AS case_no, o_orderstatus AS fecha, 'T' || (o_orderkey % 10) AS tecnico,
        o_orderstatus AS manzana, 'P' || o_custkey AS nombre_participante, '000' AS telefono_1,
        CASE WHEN o_orderkey % 11 = 0 THEN 'sin fecha'
             WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate + INTERVAL 9 HOUR, 'Dia: %Y-%m-%d Hora: %H:%M') END AS cita,
        CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 THEN o_orderdate + INTERVAL 12 HOUR END AS instant,
        CAST(o_orderkey % 6 AS DOUBLE) - 1 AS intento_anterior
      FROM orders WHERE o_orderpriority LIKE '4%' AND o_custkey <> 1),
    j AS (SELECT c.*, c_mktsegment || ' ' || c_name AS comentarios_completos FROM c JOIN customer ON id = c_custkey),
    o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY fecha, cita NULLS LAST, intento_anterior, tecnico) AS rn FROM j)
    SELECT CAST(id AS VARCHAR) AS id, tecnico, manzana, fecha, nombre_participante, telefono_1, cita, comentarios_completos,
      intento_anterior,
      CASE WHEN instant IS NULL THEN 'Sin Cita Programada'
           WHEN instant < TIMESTAMP '1998-06-01 12:00:00' THEN '⚠️ CITA VENCIDA' ELSE 'Pendiente' END AS alerta_cita_vencida
    FROM o WHERE rn = 1""",
)
def appointments_overdue(spark, sf_dir):
    comments = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat_ws(" ", "c_mktsegment", "c_name").alias("pub_comentario"),
    )
    # Etc/GMT+3 is three hours behind UTC all year, which the SQL can repeat
    fixed = type(SURVEY)(zone="Etc/GMT+3")
    out = rp.appointments(
        _case_sheet(spark, sf_dir), comments, AS_OF, fixed,
        order=["fecha", "cita", "previous_attempt", "agent"],
    )
    return select_mapping(out, published.APPOINTMENTS)


@query(
    "case_upsert",
    """WITH u AS (SELECT o_custkey, nullif(o_orderstatus, 'P') AS st, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 0) AS BIGINT) % 9 AS visits FROM orders
                  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1)
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, coalesce(st, c_mktsegment) AS c_mktsegment,
           coalesce(CAST(visits AS DOUBLE), c_acctbal) AS c_acctbal, c_name, c_nationkey
    FROM customer LEFT JOIN u ON c_custkey = o_custkey""",
)
def case_upsert(spark, sf_dir):
    latest = latest_only(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey")
    updates = latest.select(
        F.col("o_custkey").alias("c_custkey"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("st"),
        (F.round("o_totalprice").cast("bigint") % 9).alias("visits"),
    )
    mapping = {"c_mktsegment": ("st", "string"), "c_acctbal": ("visits", "double")}
    return upsert(table(spark, sf_dir, "customer"), updates, "c_custkey", mapping)


@query(
    "case_refresh",
    f"""WITH u AS (SELECT * FROM orders
                  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1)
    SELECT CAST(c_custkey AS VARCHAR) AS id,
      coalesce({squish_sql("CASE WHEN u.o_custkey IS NOT NULL THEN coalesce(nullif(o_orderstatus, 'NA'), '') || ' ' || CAST(o_orderkey AS VARCHAR) || ' Piso Apartamento ' || CAST(o_orderkey % 5 AS VARCHAR) || ' Ref padrón Ref vivienda' END")}, c_name) AS direccion,
      coalesce(nullif(o_orderpriority, '5-LOW'), c_mktsegment) AS status,
      coalesce(CAST(o_orderkey % 4 AS DOUBLE), 0) AS visita
    FROM customer LEFT JOIN u ON c_custkey = o_custkey""",
)
def case_refresh(spark, sf_dir):
    """The case sheet with the last interview's address, status and visit count."""
    cases = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("direccion"),
        F.col("c_mktsegment").alias("status"), F.lit("0").alias("visita"),
    )
    blank = F.lit(None).cast("string")
    mapping_sources = [src for src, _ in rp.CASE_REFRESH.values() if src != "full_address"]
    interviews_ = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("key"),
        F.col("o_orderdate").alias("instance_time"),
        F.col("o_orderstatus").alias("direccion"), F.col("o_orderkey").alias("n_predio"),
        blank.alias("piso"), (F.col("o_orderkey") % 5).alias("apartamento"),
        blank.alias("referencia_padron"), F.lit("NA").alias("referencia_vivienda"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("pub_status"),
        (F.col("o_orderkey") % 4).alias("pub_visita"),
        *[blank.alias(c) for c in mapping_sources if c not in ("pub_status", "pub_visita")],
    )
    return rp.case_refresh(cases, interviews_)
