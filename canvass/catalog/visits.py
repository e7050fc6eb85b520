"""Visit history."""

from __future__ import annotations

from pyspark.sql import functions as F

from canvass.catalog.registry import CATEGORY_SQL, SUBMISSIONS, query, submissions
from canvass.functions.rules import category
from canvass.operators import summaries, visits
from canvass.operators.outliers import flag
from canvass.plans import survey as sv
from canvass.plans.audit import one_hots

LATEST = "row_number() OVER (PARTITION BY unit ORDER BY ts DESC NULLS LAST, key)"


def _classified(spark, sf_dir):
    return submissions(spark, sf_dir).withColumn(
        "category", category("code", sv.CATEGORIES, sv.OTHER)
    )


@query(
    "latest_visit",
    f"""WITH {SUBMISSIONS}
    SELECT key, unit, CAST({LATEST} = 1 AS INT) AS is_final FROM subs""",
)
def latest_visit(spark, sf_dir):
    marked = visits.mark_latest(submissions(spark, sf_dir), "unit", "ts", "key")
    return marked.select("key", "unit", "is_final")


@query(
    "latest_visit_only",
    f"""WITH {SUBMISSIONS}
    SELECT key, unit, ts, code, price FROM subs QUALIFY {LATEST} = 1""",
)
def latest_visit_only(spark, sf_dir):
    kept = visits.latest_only(submissions(spark, sf_dir), "unit", "ts", "key")
    return kept.select("key", "unit", "ts", "code", "price")


@query(
    "latest_visit_by_priority",
    f"""WITH {SUBMISSIONS}, c AS (SELECT *, {CATEGORY_SQL} AS category FROM subs)
    SELECT key, unit, category,
           CAST(row_number() OVER (
             PARTITION BY unit
             ORDER BY CASE category WHEN 'EFECTIVA' THEN 4 WHEN 'AGENDADA/PENDIENTE' THEN 3
                                    WHEN 'RECHAZO' THEN 2 WHEN 'NO ELEGIBLE' THEN 1 ELSE 0 END DESC,
                      ts DESC NULLS LAST, key) = 1 AS INT) AS is_final
    FROM c""",
)
def latest_visit_by_priority(spark, sf_dir):
    marked = visits.mark_latest(
        _classified(spark, sf_dir), "unit", "ts", "key",
        priority_column="category", priority=sv.CATEGORY_RANKS,
    )
    return marked.select("key", "unit", "category", "is_final")


@query(
    "effective_not_final",
    f"""WITH {SUBMISSIONS}, m AS (SELECT *, {LATEST} AS rn FROM subs)
    SELECT key, unit, ts FROM m WHERE rn > 1 AND code = 1""",
)
def effective_not_final(spark, sf_dir):
    marked = visits.mark_latest(_classified(spark, sf_dir), "unit", "ts", "key")
    out = visits.effective_not_final(marked, "is_final", "category", sv.EFFECTIVE)
    return out.select("key", "unit", "ts")


@query(
    "attempt_number",
    f"""WITH {SUBMISSIONS}
    SELECT key, unit, CAST(row_number() OVER (
             PARTITION BY unit ORDER BY ts ASC NULLS LAST, key) AS BIGINT) AS attempt
    FROM subs""",
)
def attempt_number(spark, sf_dir):
    numbered = visits.number_attempts(submissions(spark, sf_dir), "unit", "ts", "key")
    return numbered.select("key", "unit", F.col("attempt").cast("bigint"))


_HISTORY = f"""WITH {SUBMISSIONS}, c AS (
      SELECT *, code IN (1, 5) AS closing, count(*) OVER (PARTITION BY unit) AS n FROM subs),
    h AS (
      SELECT *, coalesce(bool_or(closing) OVER (
               PARTITION BY unit ORDER BY ts NULLS LAST, key
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS closed_before
      FROM c WHERE n > 1),
    a AS (
      SELECT *, CASE WHEN closed_before AND NOT closing THEN '⚠️ REVISITAR TRAS CIERRE'
                     WHEN closed_before AND closing THEN '⚠️ DOBLE CIERRE'
                     ELSE 'Seguimiento normal' END AS history_alert
      FROM h)"""


@query(
    "reopen_after_close",
    f"""{_HISTORY}
    SELECT key, unit, ts, closed_before, history_alert FROM a
    QUALIFY bool_or(closed_before) OVER (PARTITION BY unit)""",
)
def reopen_after_close(spark, sf_dir):
    out = visits.closure_history(
        submissions(spark, sf_dir), "unit", "ts", "key", F.col("code").isin(1, 5)
    )
    return out.select("key", "unit", "ts", "closed_before", "history_alert")


@query(
    "closed_before_flag",
    f"""{_HISTORY} SELECT key, unit, CAST(closed_before AS INT) AS closed_before FROM a""",
)
def closed_before_flag(spark, sf_dir):
    out = visits.closure_history(
        submissions(spark, sf_dir), "unit", "ts", "key", F.col("code").isin(1, 5),
        only_affected=False,
    )
    return out.select("key", "unit", F.col("closed_before").cast("int").alias("closed_before"))


@query(
    "partial_history",
    f"""WITH {SUBMISSIONS}
    SELECT key, unit, ts, code FROM subs
    QUALIFY bool_or(code = 3) OVER (PARTITION BY unit)""",
)
def partial_history(spark, sf_dir):
    out = visits.history_of_matching(
        submissions(spark, sf_dir), "unit", "key", F.col("code") == 3
    )
    return out.select("key", "unit", "ts", "code")


@query(
    "partial_unit_count",
    f"""WITH {SUBMISSIONS}
    SELECT CAST(count(DISTINCT unit) + max(CAST(unit IS NULL AS INT)) AS BIGINT) AS units
    FROM (SELECT unit FROM subs QUALIFY bool_or(code = 3) OVER (PARTITION BY unit))""",
)
def partial_unit_count(spark, sf_dir):
    out = visits.history_of_matching(
        submissions(spark, sf_dir), "unit", "key", F.col("code") == 3
    )
    return out.agg(summaries.distinct_count("unit").cast("bigint").alias("units"))


@query(
    "repeated_history",
    f"""WITH {SUBMISSIONS}
    SELECT key, unit, code FROM subs QUALIFY count(*) OVER (PARTITION BY unit) > 1""",
)
def repeated_history(spark, sf_dir):
    out = visits.history_of_repeated(submissions(spark, sf_dir), "unit", "key")
    return out.select("key", "unit", "code")


@query(
    "unique_units_check",
    f"""WITH {SUBMISSIONS}
    SELECT unit, CAST(count(*) AS BIGINT) AS n FROM subs GROUP BY unit HAVING count(*) > 1""",
)
def unique_units_check(spark, sf_dir):
    return visits.repeated_keys(submissions(spark, sf_dir), ["unit"])


@query(
    "status_categories",
    f"""WITH {SUBMISSIONS}, s AS (SELECT nullif(code, 4) AS code, grp FROM subs),
    c AS (SELECT *, {CATEGORY_SQL} AS category FROM s)
    SELECT grp, category, CAST(count(*) AS BIGINT) AS n,
           CAST(sum(CASE WHEN code = 1 THEN 1 WHEN code IS NOT NULL THEN 0 END) AS BIGINT) AS effective,
           CAST(sum(CASE WHEN code IN (2, 3, 4) THEN 1 ELSE 0 END) AS BIGINT) AS scheduled,
           CAST(count(CASE WHEN code = 5 THEN 1 WHEN code IS NOT NULL THEN 0 END) AS BIGINT) AS refusal_known
    FROM c GROUP BY grp, category""",
)
def status_categories(spark, sf_dir):
    df = submissions(spark, sf_dir).withColumn("code", F.nullif(F.col("code"), F.lit(4)))
    df = df.withColumns(one_hots(F.col("code"))).withColumn(
        "category", category("code", sv.CATEGORIES, sv.OTHER)
    )
    return summaries.summarise(
        df,
        {"grp": "grp", "category": "category"},
        {
            "n": F.count(F.lit(1)),
            "effective": F.sum("is_effective"),
            "scheduled": F.sum("is_scheduled"),
            "refusal_known": F.count("is_refusal"),
        },
    )


@query(
    "final_status_per_unit",
    f"""WITH {SUBMISSIONS}, f AS (SELECT * FROM subs QUALIFY {LATEST} = 1),
    c AS (SELECT *, {CATEGORY_SQL} AS category FROM f)
    SELECT category, CAST(count(*) AS BIGINT) AS units,
           CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS price,
           CAST(sum(CASE WHEN price > 300000 THEN 1 ELSE 0 END) AS BIGINT) AS high
    FROM c GROUP BY category""",
)
def final_status_per_unit(spark, sf_dir):
    """Flagship: final status per unit, counted by category."""
    final = visits.latest_only(_classified(spark, sf_dir), "unit", "ts", "key")
    return summaries.summarise(
        final,
        {"category": "category"},
        {
            "units": F.count(F.lit(1)),
            "price": F.sum(F.col("price").cast("decimal(18,2)")).cast("decimal(28,2)"),
            "high": F.sum(flag(F.col("price") > 300000)),
        },
    )
