"""Projections, reshaping, unions, ingest and ordered results."""

from __future__ import annotations

from pyspark.sql import functions as F

from canvass.catalog.registry import query, table
from canvass.functions import columns as cols
from canvass.functions.numbers import at_least, flag, without_sentinels
from canvass.operators import reshape, visits
from canvass.sources import forms

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "mirror_projection",
    """SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS part, l_quantity AS quantity,
              l_returnflag AS flag, l_shipdate FROM lineitem""",
)
def mirror_projection(spark, sf_dir):
    return cols.select_mapping(
        table(spark, sf_dir, "lineitem"),
        [
            ("id", "l_orderkey"), ("line", "l_linenumber"), ("part", "l_partkey"),
            ("quantity", "l_quantity"), ("flag", "l_returnflag"), ("l_shipdate", "l_shipdate"),
        ],
    )


@query("clean_rows", "SELECT o_orderkey AS key, o_custkey AS unit, o_orderdate AS started FROM orders WHERE o_orderstatus = 'F'")
def clean_rows(spark, sf_dir):
    """The clean table: passing rows through a column mapping."""
    passing = table(spark, sf_dir, "orders").filter(flag(F.col("o_orderstatus") == "F") == 1)
    return cols.select_mapping(
        passing, {"key": "o_orderkey", "unit": "o_custkey", "started": "o_orderdate"}
    )


@query(
    "cast_by_prefix",
    """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS fcs_code,
              TRY_CAST(o_orderpriority AS DOUBLE) AS "FCS_text", CAST(o_custkey AS DOUBLE) AS rcsi_unit FROM orders""",
)
def cast_by_prefix(spark, sf_dir):
    """Prefixes ignore case; what is not a number becomes NULL."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).alias("fcs_code"),
        F.col("o_orderpriority").alias("FCS_text"),
        F.col("o_custkey").cast("string").alias("rcsi_unit"),
    )
    return cols.cast_by_prefix(orders, ["fcs", "rcsi", "hhs"])


@query(
    "select_by_name",
    "SELECT o_orderkey, o_orderdate, o_orderstatus, o_orderpriority, o_totalprice FROM orders",
)
def select_by_name(spark, sf_dir):
    """By prefix, by pattern, and names that may be absent."""
    orders = table(spark, sf_dir, "orders")
    names = [*cols.by_prefix(orders, "O_ORDER"), *cols.by_regex(orders, "price$"), "absent"]
    moved = cols.move_before(orders, "o_orderdate", "o_custkey")
    return cols.select_present(cols.drop_by_prefix(moved, "o_cust"), names)


@query(
    "across_columns",
    "SELECT " + ", ".join(_KEYS) + ", "
    + ", ".join(f"round({m} * 2, 6) AS twice_{m}, CAST({m} > 10 AS INT) AS high_{m}" for m in _MEASURES)
    + " FROM lineitem",
)
def across_columns(spark, sf_dir):
    out = cols.across(
        table(spark, sf_dir, "lineitem"),
        [*_MEASURES, "absent"],
        {"twice": lambda c: F.round(c * 2, 6), "high": lambda c: flag(c > 10)},
    )
    return out.select(*_KEYS, *cols.by_prefix(out, "twice_", "high_"))


@query(
    "row_totals",
    """SELECT p_partkey, coalesce(CASE WHEN p_size NOT IN (-1, 98, 99, 7) THEN p_size END, 0) + p_partkey % 5 AS total,
         CAST(p_size > 10 AS INT) + CAST(p_type = 'ECONOMY' AS INT) + CAST(coalesce(nullif(p_size, 3) > 40, FALSE) AS INT) AS hits,
         greatest(coalesce(CASE WHEN p_size <> 7 THEN p_size END, 5), 5) AS floored,
         concat_ws(' | ', nullif(p_type, 'ECONOMY'), p_brand) AS merged, '' AS note
       FROM part""",
)
def row_totals(spark, sf_dir):
    size = without_sentinels("p_size", (-1, 98, 99, 7)).cast("bigint")
    hits = cols.row_count(
        [
            F.col("p_size") > 10,
            F.col("p_type") == "ECONOMY",
            F.nullif(F.col("p_size"), F.lit(3)) > 40,
        ]
    )
    merged = cols.merge_text([F.nullif(F.col("p_type"), F.lit("ECONOMY")), "p_brand"])
    out = table(spark, sf_dir, "part").select(
        "p_partkey",
        cols.row_sum([size, F.col("p_partkey") % 5]).alias("total"),
        hits.alias("hits"),
        at_least(F.when(F.col("p_size") != 7, F.col("p_size")), 5).alias("floored"),
        merged.alias("merged"),
    )
    return cols.add_constants(out, {"note": ""})


@query(
    "wide_to_long",
    " UNION ALL ".join(
        f"SELECT {', '.join(_KEYS)}, '{m}' AS name, CAST({m} AS DOUBLE) AS value FROM lineitem" for m in _MEASURES
    ),
)
def wide_to_long(spark, sf_dir):
    return reshape.to_long(table(spark, sf_dir, "lineitem"), _KEYS, _MEASURES, as_type="double")


_EVENTS = ["view", "click", "purchase", "signup", "error", "never"]


@query(
    "long_to_wide",
    """SELECT user_id, """
    + ", ".join(
        f'coalesce(max(n) FILTER (WHERE event_type = \'{t}\'), 0) AS "{t}"'
        for t in _EVENTS
    )
    + """ FROM (SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2) GROUP BY 1""",
)
def long_to_wide(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    return reshape.to_wide(counts, ["user_id"], "event_type", "n", _EVENTS, fill=0)


@query(
    "counts_to_columns",
    """SELECT c_nationkey, CAST(count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS BIGINT) AS "BUILDING",
         CAST(count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS BIGINT) AS "MACHINERY",
         CAST(count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS BIGINT) AS other,
         CAST(count(*) AS BIGINT) AS total
       FROM customer GROUP BY 1""",
)
def counts_to_columns(spark, sf_dir):
    return reshape.counts_to_columns(
        table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment", ["BUILDING", "MACHINERY"], other="other"
    )


@query(
    "full_join_days",
    """WITH a AS (SELECT nullif(user_id % 7, 0) AS day, CAST(count(*) AS BIGINT) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1),
    b AS (SELECT nullif(user_id % 9, 0) AS day, CAST(count(*) AS BIGINT) AS views FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT coalesce(a.day, b.day) AS day, clicks, views FROM a FULL JOIN b ON a.day IS NOT DISTINCT FROM b.day""",
)
def full_join_days(spark, sf_dir):
    events = table(spark, sf_dir, "events")

    def per(kind, modulus, out):
        day = F.nullif(F.col("user_id") % modulus, F.lit(0)).alias("day")
        rows = events.filter(F.col("event_type") == kind).groupBy(day)
        return rows.agg(F.count(F.lit(1)).alias(out))

    return reshape.full_join_by(per("click", 7, "clicks"), per("view", 9, "views"), "day")


@query(
    "union_forms",
    """SELECT n_name AS name, n_nationkey AS key, n_regionkey FROM nation
       UNION ALL BY NAME SELECT r_name AS name, r_regionkey AS key FROM region""",
)
def union_forms(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"), F.col("n_nationkey").alias("key"), "n_regionkey"
    )
    region = table(spark, sf_dir, "region").select(
        F.col("r_name").alias("name"), F.col("r_regionkey").alias("key")
    )
    return reshape.union_by_name([nation, region])


@query(
    "distinct_keep_row",
    """SELECT doc_id, lang, source, n_chars FROM documents
       QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1""",
)
def distinct_keep_row(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("digest", F.md5("text"))
    kept = visits.keep_first(docs, ["digest"], [F.col("doc_id").asc_nulls_last()])
    return kept.select("doc_id", "lang", "source", "n_chars")


@query(
    "json_flatten",
    """SELECT event_id, nullif(json_extract_string(props, '$.k'), '') AS props_k,
              json_extract_string(props, '$.absent.deep') AS props_absent_deep FROM events""",
)
def json_flatten(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    flat = forms.parse_json_column(events, "props", "k long, absent struct<deep string>")
    return cols.with_snake_names(flat)


@query(
    "all_text",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, nullif(c_name, '') AS c_name,
              nullif(CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END, '') AS segment FROM customer""",
)
def all_text(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("segment"),
    )
    return forms.all_text(customers)


@query(
    "top_rows",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25""",
)
def top_rows(spark, sf_dir):
    ordered = table(spark, sf_dir, "orders").orderBy(
        F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc_nulls_last()
    )
    return ordered.select("o_orderkey", "o_totalprice").limit(25)


@query(
    "ordered_report",
    """SELECT nullif(c_mktsegment, 'BUILDING') AS segment, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST""",
)
def ordered_report(spark, sf_dir):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    counts = table(spark, sf_dir, "customer").groupBy(segment).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc_nulls_last(), F.col("segment").asc_nulls_last())
