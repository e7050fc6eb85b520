"""Key lists, overrides, corrections, recodes and column filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from canvass.catalog.registry import SUBMISSIONS, query, submissions, table
from canvass.functions.columns import fill_numeric_nulls
from canvass.functions.dates import on_or_after, submission_time
from canvass.functions.rules import keep_for_codes, recode
from canvass.operators import corrections
from canvass.plans.survey import STATUS_LABELS


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.nullif(F.col("doc_id") % 20, F.lit(0)).alias("part"),
        F.when(F.col("doc_id") % 20 != 0, F.col("doc_id")).alias("key"),
        "lang",
        "n_chars",
    )


_DOCUMENTS = """
d AS (SELECT nullif(doc_id % 20, 0) AS part,
             CASE WHEN doc_id % 20 <> 0 THEN doc_id END AS key, lang, n_chars FROM documents)
"""


def _toxic(spark, sf_dir):
    return table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")


@query(
    "blacklist",
    f"""WITH {_DOCUMENTS}
    SELECT * FROM d WHERE NOT coalesce(key IN (SELECT doc_id FROM labels WHERE toxic = 1), FALSE)""",
)
def blacklist(spark, sf_dir):
    return corrections.drop_keys(_documents(spark, sf_dir), "key", _toxic(spark, sf_dir))


@query(
    "whitelist",
    f"""WITH {_DOCUMENTS}
    SELECT * FROM d WHERE key IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def whitelist(spark, sf_dir):
    return corrections.only_keys(_documents(spark, sf_dir), "key", _toxic(spark, sf_dir))


@query(
    "keyed_override",
    f"""WITH {SUBMISSIONS}, k AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity >= 49)
    SELECT key, unit,
           CASE WHEN key IN (SELECT l_orderkey FROM k) THEN 1 ELSE code END AS code,
           CASE WHEN key IN (SELECT l_orderkey FROM k) THEN 'SI' ELSE grp END AS grp
    FROM subs""",
)
def keyed_override(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").filter("l_quantity >= 49").select("l_orderkey")
    out = corrections.override_for_keys(
        submissions(spark, sf_dir), "key", keys, {"code": 1, "grp": "SI"}
    )
    return out.select("key", "unit", "code", "grp")


@query(
    "id_correction",
    """SELECT c_custkey AS key, coalesce(s_name, c_name) AS id,
              coalesce(s_name, CAST(c_nationkey AS VARCHAR)) AS unit
       FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
)
def id_correction(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("id"), F.col("c_nationkey").alias("unit")
    )
    dictionary = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return corrections.correct_by_key(customers, "key", dictionary, ["id", "unit"])


_STATUS_VALUES = ", ".join(f"({k}, '{v}')" for k, v in STATUS_LABELS.items())


@query(
    "status_correction",
    f"""WITH {SUBMISSIONS}, fixes AS (
      SELECT doc_id AS k, 4 + quality + 20 * toxic AS new_code FROM labels),
    names(id, label) AS (VALUES {_STATUS_VALUES})
    SELECT key, coalesce(CAST(new_code AS VARCHAR), CAST(code AS VARCHAR)) AS code,
           coalesce(label, grp) AS status_label
    FROM subs LEFT JOIN fixes ON key = k LEFT JOIN names ON new_code = id""",
)
def status_correction(spark, sf_dir):
    """Codes without a label change the code and leave the label."""
    fixes = table(spark, sf_dir, "labels").select(
        "doc_id", (4 + F.col("quality") + 20 * F.col("toxic")).alias("code")
    )
    df = submissions(spark, sf_dir).withColumnRenamed("grp", "status_label")
    out = corrections.correct_status(
        df, "key", fixes, STATUS_LABELS, code="code", label_columns=["status_label"]
    )
    return out.select("key", "code", "status_label")


@query(
    "null_unless",
    f"""WITH {SUBMISSIONS}
    SELECT key, CASE WHEN code IN (1, 3, 5) THEN grp END AS treatment FROM subs""",
)
def null_unless(spark, sf_dir):
    return submissions(spark, sf_dir).select(
        "key", keep_for_codes("grp", "code", [1, 3, 5]).alias("treatment")
    )


@query(
    "recode_labels",
    f"""WITH {SUBMISSIONS}
    SELECT key, CASE nullif(code, 5) WHEN 1 THEN 'SI' WHEN 2 THEN 'NO'
                ELSE CAST(nullif(code, 5) AS VARCHAR) END AS label FROM subs""",
)
def recode_labels(spark, sf_dir):
    code = F.nullif(F.col("code"), F.lit(5))
    return submissions(spark, sf_dir).select("key", recode(code, {1: "SI", 2: "NO"}).alias("label"))


@query(
    "day_filter",
    """WITH e AS (
      SELECT event_id, strftime(ts, '%b %-d, %Y') AS day,
             date_trunc('second', ts) - INTERVAL 3 HOUR AS local_time
      FROM events)
    SELECT event_id, day, local_time, CAST(local_time AS DATE) AS local_day FROM e
    WHERE day <> 'Jan 9, 2024' AND local_time >= DATE '2024-01-04'""",
)
def day_filter(spark, sf_dir):
    """Times are written out as the form server writes them, then read back."""
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "MMM d, yyyy").alias("day"),
        F.date_format("ts", "MMM d, yyyy h:mm:ss a").alias("submitted"),
    )
    local = raw.withColumn("local_time", submission_time("submitted"))
    kept = local.filter((F.col("day") != "Jan 9, 2024") & on_or_after("local_time", "2024-01-04"))
    return kept.select(
        "event_id", "day", F.col("local_time").cast("timestamp_ntz").alias("local_time"),
        F.to_date("local_time").alias("local_day"),
    )


@query(
    "coalesce_fill",
    """SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), c_name) AS segment,
              coalesce(n, 0) AS orders, coalesce(top, 0) AS top_price
       FROM customer LEFT JOIN (
         SELECT CASE WHEN o_custkey % 4 <> 0 THEN o_custkey END AS k, CAST(count(*) AS BIGINT) AS n, max(o_totalprice) AS top
         FROM orders GROUP BY 1) ON c_custkey = k""",
)
def coalesce_fill(spark, sf_dir):
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy(F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey")).alias("k"))
        .agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("top_price"))
    )
    joined = corrections.left_lookup(
        table(spark, sf_dir, "customer"), per_customer, {"c_custkey": "k"}
    )
    segment = F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.col("c_name"))
    filled = fill_numeric_nulls(joined, ["orders", "top_price"])
    return filled.select("c_custkey", segment.alias("segment"), "orders", "top_price")


@query(
    "null_safe_lookup",
    """WITH c AS (SELECT c_custkey, nullif(c_nationkey, 3) AS k FROM customer),
    n AS (SELECT nullif(n_nationkey, 3) AS k, n_name FROM nation)
    SELECT c_custkey, c.k AS nation, n_name FROM c LEFT JOIN n ON c.k IS NOT DISTINCT FROM n.k""",
)
def null_safe_lookup(spark, sf_dir):
    """NULL keys meet, as in the joins of the reports."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.nullif(F.col("n_nationkey"), F.lit(3)).alias("k"), "n_name"
    )
    return corrections.left_lookup(customers, nations, {"nation": "k"}, null_safe=True)
