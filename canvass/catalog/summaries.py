"""Counts, distinct counts, lists and grouped figures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from canvass.catalog.registry import SUBMISSIONS, query, submissions, table
from canvass.functions.dates import active_days, days_between
from canvass.functions.numbers import percent
from canvass.operators.summaries import (
    contingency,
    count_by,
    count_where,
    distinct_count,
    first_by,
    mean_where,
    one_way,
    summarise,
    text_list,
)

_TYPES = ["view", "click", "purchase", "signup", "error"]


@query(
    "group_count",
    """SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2""",
)
def group_count(spark, sf_dir):
    return count_by(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query(
    "contingency",
    "SELECT CAST(ts AS DATE) AS day, "
    + ", ".join(f'CAST(count(*) FILTER (WHERE kind = \'{t}\') AS BIGINT) AS "{t}"' for t in _TYPES)
    + """ FROM (SELECT nullif(CAST(ts AS DATE), DATE '2024-01-05') AS ts, nullif(event_type, 'error') AS kind FROM events)
       WHERE ts IS NOT NULL GROUP BY 1""",
)
def contingency_query(spark, sf_dir):
    """Pairs with a NULL are left out, absent pairs are 0."""
    events = table(spark, sf_dir, "events").select(
        F.nullif(F.to_date("ts"), F.lit("2024-01-05").cast("date")).alias("day"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("kind"),
    )
    return contingency(events, "day", "kind", _TYPES)


@query(
    "one_way_counts",
    """SELECT kind, CAST(count(*) AS BIGINT) AS n FROM (SELECT nullif(event_type, 'error') AS kind FROM events) GROUP BY 1""",
)
def one_way_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.nullif(F.col("event_type"), F.lit("error")).alias("kind")
    )
    return one_way(events, "kind", keep_null=True)


@query(
    "conditional_counts",
    f"""WITH {SUBMISSIONS}
    SELECT agent, CAST(count(*) FILTER (WHERE code = 1) AS BIGINT) AS complete,
      CAST(count(*) FILTER (WHERE code = 3 AND price > 100000) AS BIGINT) AS partial,
      CAST(count(*) FILTER (WHERE unit > 500) AS BIGINT) AS known_units,
      round(avg(price) FILTER (WHERE code = 1), 4) AS mean_price,
      round(CAST(count(*) FILTER (WHERE code = 1) AS DOUBLE) / nullif(count(*) FILTER (WHERE code = 9), 0) * 100, 1) AS rate
    FROM subs GROUP BY agent""",
)
def conditional_counts(spark, sf_dir):
    """Unknown conditions do not count; a rate over nothing is NULL."""
    code = F.col("code")
    table_ = summarise(
        submissions(spark, sf_dir),
        {"agent": "agent"},
        {
            "complete": count_where(code == 1),
            "partial": count_where((code == 3) & (F.col("price") > 100000)),
            "known_units": count_where(F.col("unit") > 500),
            "mean_price": F.round(mean_where("price", code == 1), 4),
            "none": count_where(code == 9),
        },
    )
    return table_.withColumn("rate", percent("complete", "none")).drop("none")


@query(
    "distinct_null_aware",
    f"""WITH {SUBMISSIONS}
    SELECT agent, CAST(count(DISTINCT unit) AS BIGINT) AS units,
           CAST(count(DISTINCT unit) + max(CAST(unit IS NULL AS INT)) AS BIGINT) AS units_with_null,
           CAST(count(DISTINCT concat(CAST(code AS VARCHAR), ' ', grp)) AS BIGINT) AS pairs
    FROM subs GROUP BY agent""",
)
def distinct_null_aware(spark, sf_dir):
    return summarise(
        submissions(spark, sf_dir),
        {"agent": "agent"},
        {
            "units": distinct_count("unit", count_null=False),
            "units_with_null": distinct_count("unit").cast("bigint"),
            "pairs": F.count_distinct(F.concat_ws(" ", F.col("code").cast("string"), "grp")),
        },
    )


@query(
    "group_list",
    """SELECT c_nationkey, string_agg(DISTINCT coalesce(s, 'NA'), ' | ' ORDER BY coalesce(s, 'NA')) AS segments
       FROM (SELECT c_nationkey, nullif(c_mktsegment, 'BUILDING') AS s FROM customer) GROUP BY 1""",
)
def group_list(spark, sf_dir):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return summarise(
        table(spark, sf_dir, "customer"), {"c_nationkey": "c_nationkey"}, {"segments": text_list(segment)}
    )


@query(
    "first_value",
    f"""WITH {SUBMISSIONS}
    SELECT grp, code, first(agent_text ORDER BY ts, key) AS first_agent, first(unit ORDER BY ts DESC, key DESC) AS last_unit
    FROM (SELECT *, nullif(CAST(agent AS VARCHAR), '4') AS agent_text FROM subs) GROUP BY 1, 2""",
)
def first_value(spark, sf_dir):
    agent = F.nullif(F.col("agent").cast("string"), F.lit("4"))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return summarise(
        submissions(spark, sf_dir),
        {"grp": "grp", "code": "code"},
        {
            "first_agent": first_by(agent, "ts", "key"),
            "last_unit": first_by("unit", -micros, -F.col("key")),
        },
    )


@query(
    "group_figures",
    """SELECT user_id, min(value) AS low, max(value) AS high, round(avg(value), 6) AS mean,
          round(stddev_samp(value), 6) AS sd, CAST(max(CAST(ts AS DATE)) - min(CAST(ts AS DATE)) + 1 AS INT) AS days_active,
          CAST(DATE '2024-03-01' - max(CAST(ts AS DATE)) AS INT) AS days_idle
       FROM events GROUP BY 1""",
)
def group_figures(spark, sf_dir):
    day = F.to_date("ts")
    out = summarise(
        table(spark, sf_dir, "events"),
        {"user_id": "user_id"},
        {
            "low": F.min("value"),
            "high": F.max("value"),
            "mean": F.round(F.avg("value"), 6),
            "sd": F.round(F.stddev_samp("value"), 6),
            "first_day": F.min(day),
            "last_day": F.max(day),
        },
    )
    return out.select(
        "user_id", "low", "high", "mean", "sd",
        active_days("last_day", "first_day").alias("days_active"),
        days_between(F.lit(date(2024, 3, 1)), "last_day").alias("days_idle"),
    )
