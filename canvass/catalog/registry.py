"""Registry of queries, and the survey view of the given tables that most of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL equal to it."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the scan's own split size decides how it is spread."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as visits: a customer is a unit, some visits have none."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("unit"),
        F.col("o_orderdate").alias("ts"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("code"),
        F.col("o_orderstatus").alias("grp"),
        (F.col("o_orderkey") % 10).cast("int").alias("agent"),
        F.col("o_totalprice").alias("price"),
    )


SUBMISSIONS = """
subs AS (
  SELECT o_orderkey AS key,
         CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END AS unit,
         o_orderdate AS ts,
         CAST(substr(o_orderpriority, 1, 1) AS INT) AS code,
         o_orderstatus AS grp,
         CAST(o_orderkey % 10 AS INT) AS agent,
         o_totalprice AS price
  FROM orders)
"""

CATEGORY_SQL = """
CASE WHEN code = 1 THEN 'EFECTIVA' WHEN code = 5 THEN 'RECHAZO'
     WHEN code IN (6, 7, 8, 9, 10) THEN 'NO ELEGIBLE'
     WHEN code IN (2, 3, 4) THEN 'AGENDADA/PENDIENTE' ELSE 'OTRO/ERROR' END
"""


# Orders with their customers read as audited interviews. The expressions are the same text
# for both engines; verdicts and final visits are added by the operators under test.
_INTERVIEW = {
    "key": "o_orderkey",
    "id": "c_custkey",
    "padron_pull": "CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END",
    "manzana_pull": "CASE WHEN c_nationkey <> 24 THEN concat('Mz ', CAST(c_nationkey AS STRING)) END",
    "tecnico_pull": "CASE WHEN o_orderkey % 10 <> 3 THEN concat('T', CAST(o_orderkey % 10 AS STRING)) END",
    "ident_enc_resp": "concat('E', CAST(o_orderkey % 7 AS STRING))",
    "supervisor_pull": "concat('S', CAST(c_nationkey % 3 AS STRING))",
    "day": "substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7)",
    "submission_date": "o_orderdate",
    "starttime": "o_orderdate",
    "status_num": "CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)",
    "status_survey": "substr(o_orderpriority, 1, 1)",
    "status_survey_resp": "o_orderpriority",
    "pub_comentario": "concat(c_mktsegment, ' ', o_orderstatus)",
    "grupo_experimento": (
        "CASE o_orderkey % 4 WHEN 0 THEN 'ESQUEMA FUNCIONAL SIMPLE' "
        "WHEN 1 THEN 'ESQUEMA FUNCIONAL DETALLADO' WHEN 2 THEN 'CONTROL' END"
    ),
    "grupo_3": "CASE WHEN o_orderkey % 4 = 0 THEN '1' WHEN o_orderkey % 9 <> 0 THEN '0' END",
    "grupo_4": "CASE WHEN o_orderkey % 4 = 1 THEN '1' ELSE '0' END",
    "p10_13": "CASE WHEN o_orderkey % 5 <> 0 THEN '1' ELSE '2' END",
    "p10_09": "CASE WHEN o_orderkey % 12 <> 0 THEN CAST(o_orderkey % 12 AS STRING) END",
    "duration_min": "CASE WHEN o_orderkey % 31 <> 0 THEN o_totalprice / 10000 END",
    "distance_m": "CASE WHEN o_orderkey % 37 <> 0 THEN o_totalprice / 20000 END",
    "total_missing": "CAST(CASE WHEN o_orderkey % 19 = 0 THEN 1 + o_orderkey % 3 ELSE 0 END AS INT)",
    "total_skips": "CAST(o_orderkey % 3 AS INT)",
    "total_extremes": "CAST(CASE WHEN o_orderkey % 13 = 0 THEN 2 ELSE 0 END AS INT)",
    "total_dup": "CAST(CASE WHEN o_orderkey % 17 = 0 THEN 1 WHEN o_orderkey % 41 <> 0 THEN 0 END AS INT)",
    "alert_nsnr": "CAST(CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END AS INT)",
    "flag_garbage_text": "CAST(CASE WHEN o_orderkey % 29 = 0 THEN 1 ELSE 0 END AS INT)",
    "identity": "concat(c_name, '_', c_mktsegment)",
    "garbage_detail": "CASE WHEN o_orderkey % 29 = 0 THEN concat('p7_05: ''', c_mktsegment, '''') END",
    "nsnr_detail": "CASE WHEN o_orderkey % 23 = 0 THEN 'p4_04, p5_08' END",
    "outlier_detail": "CASE WHEN o_orderkey % 26 = 0 THEN concat('p1_07: [', CAST(o_orderkey AS STRING), ']') END",
    "missing_detail": "CASE WHEN o_orderkey % 19 = 0 THEN '🚫 Faltante: p2_02' END",
}


def interviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return joined.select(*[F.expr(sql).alias(name) for name, sql in _INTERVIEW.items()])


INTERVIEWS = (
    "interviews AS (SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in _INTERVIEW.items()).replace("STRING", "VARCHAR")
    + ", CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'EFECTIVA' WHEN '5' THEN 'RECHAZO'"
    + " ELSE 'AGENDADA/PENDIENTE' END AS category"
    + " FROM orders JOIN customer ON o_custkey = c_custkey)"
)

# Flags, verdicts and the final visit over ``interviews``.
AUDITED = f"""{INTERVIEWS},
flagged AS (
  SELECT *,
    CAST(coalesce(status_num = 5, FALSE) AS INT) AS flag_refusal,
    CAST(coalesce(total_skips > 0, FALSE) AS INT) AS flag_skips,
    CAST(coalesce(total_missing > 0, FALSE) AS INT) AS flag_missing,
    CAST(coalesce(duration_min > 45, FALSE) AS INT) AS flag_duration_outlier,
    CAST(coalesce(total_extremes > 0, FALSE) AS INT) AS flag_extreme_values,
    CAST(coalesce(total_dup = 1, FALSE) AS INT) AS flag_duplicated,
    CAST(coalesce(distance_m > 24, FALSE) AS INT) AS flag_geofencing,
    CAST(coalesce(alert_nsnr = 1, FALSE) AS INT) AS flag_nsnr,
    CAST(coalesce(status_num = 1, FALSE) AS INT) AS is_effective,
    CAST(row_number() OVER (PARTITION BY padron_pull ORDER BY submission_date DESC NULLS LAST, key) = 1 AS INT) AS is_final
  FROM interviews),
raised AS (
  SELECT *, flag_duration_outlier + flag_extreme_values + flag_duplicated + flag_geofencing
            + flag_missing + flag_nsnr + flag_garbage_text AS raised FROM flagged),
audited AS (
  SELECT *, CAST(category IN ('RECHAZO', 'NO ELEGIBLE') OR raised = 0 AS INT) AS audit_pass,
         CAST(category = 'EFECTIVA' AND raised > 0 AS INT) AS audit_alert FROM raised)
"""
