"""Duration, outlier, no-answer, form-logic and duplicate alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from canvass.catalog.registry import query, table
from canvass.catalog.texts import squish_sql
from canvass.operators import duplicates, formlogic, outliers
from canvass.operators.grouping import literal_table
from canvass.operators.formlogic import FormRule
from canvass.session import cut_lineage
from canvass.sources.tables import form_rules, with_groups

# ---- durations ---------------------------------------------------------------------

_DURATION = """WITH e AS (
      SELECT event_id, event_type, CASE WHEN event_id % 40 <> 0 THEN value / 60 END AS minutes FROM events),
    g AS (SELECT event_type, avg(minutes) AS mu, stddev_samp(minutes) AS sd FROM e GROUP BY 1),
    f AS (SELECT e.*, mu, sd,
                 CAST(coalesce(minutes < mu - 0.9 * sd, FALSE) AS INT) AS short,
                 CAST(coalesce(minutes > mu + 5 * sd, FALSE) AS INT) AS long
          FROM e JOIN g USING (event_type))"""


def _durations(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.when(F.col("event_id") % 40 != 0, F.col("value") / 60).alias("minutes"),
    )


@query(
    "duration_flags",
    f"""{_DURATION}
    SELECT event_id, short AS alert_short, CASE WHEN short = 1 THEN 0 ELSE long END AS alert_long,
           CASE WHEN short = 1 THEN 'Tiempo corto' WHEN long = 1 THEN 'Tiempo excesivo'
                ELSE 'Normal' END AS duration_alert,
           round(mu, 6) AS group_mean, round(sd, 6) AS group_sd,
           round(mu - 0.9 * sd, 6) AS threshold_short, round(mu + 5 * sd, 6) AS threshold_long
    FROM f""",
)
def duration_flags(spark, sf_dir):
    out = outliers.flag_durations(
        _durations(spark, sf_dir), "event_type", "minutes", "event_id", k_low=0.9, k_high=5
    )
    rounded = ["group_mean", "group_sd", "threshold_short", "threshold_long"]
    return out.select(
        "event_id", "alert_short", "alert_long", "duration_alert",
        *[F.round(c, 6).alias(c) for c in rounded],
    )


# ---- numeric outliers --------------------------------------------------------------

_EVENTS_NUMBERS = """e AS (
      SELECT event_id, event_type,
             CASE WHEN event_id % 25 = 0 THEN 99 WHEN event_id % 30 = 0 THEN NULL ELSE value END AS a,
             CASE WHEN event_type = 'view' THEN 7 ELSE CAST(user_id AS DOUBLE) END AS b
      FROM events)"""


def _event_numbers(spark, sf_dir):
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.when(key % 25 == 0, 99.0).when(key % 30 != 0, F.col("value")).alias("a"),
        F.when(F.col("event_type") == "view", 7.0)
        .otherwise(F.col("user_id").cast("double"))
        .alias("b"),
    )


def _outlier_sql(tested: str) -> str:
    def clean(c: str) -> str:
        return f"CASE WHEN {c} NOT IN (-1, 98, 99) THEN {c} END"

    def test(c: str) -> str:
        value = c if tested == "raw" else clean(c)
        return f"""CASE WHEN sd_{c} > 0 THEN
            CAST(abs(({value}) - mu_{c}) > 3 * sd_{c} AND ({value}) <> mu_{c} AS INT) ELSE 0 END"""

    return f"""WITH {_EVENTS_NUMBERS}, g AS (
      SELECT event_type, avg({clean('a')}) AS mu_a, stddev_samp({clean('a')}) AS sd_a,
             avg({clean('b')}) AS mu_b, stddev_samp({clean('b')}) AS sd_b FROM e GROUP BY 1),
    f AS (SELECT event_id, {test('a')} AS ex_a, {test('b')} AS ex_b, mu_a, mu_b FROM e JOIN g USING (event_type))
    SELECT event_id, ex_a, ex_b, round(mu_a, 6) AS mu_a, round(mu_b, 6) AS mu_b,
           coalesce(ex_a, 0) + coalesce(ex_b, 0) AS total_extremes,
           CAST(coalesce(ex_a, 0) + coalesce(ex_b, 0) > 0 AS INT) AS flag_extreme_values FROM f"""


def _outlier_query(spark, sf_dir, test):
    out = outliers.flag_outliers(
        _event_numbers(spark, sf_dir), "event_type", ["a", "b", "absent"], "event_id", test=test
    )
    return out.select(
        "event_id", "ex_a", "ex_b", F.round("mu_a", 6).alias("mu_a"), F.round("mu_b", 6).alias("mu_b"),
        "total_extremes", "flag_extreme_values",
    )


@query("numeric_outliers", _outlier_sql("raw"))
def numeric_outliers(spark, sf_dir):
    return _outlier_query(spark, sf_dir, "raw")


@query("numeric_outliers_clean", _outlier_sql("clean"))
def numeric_outliers_clean(spark, sf_dir):
    return _outlier_query(spark, sf_dir, "clean")


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "lineitem_outliers",
    f"""WITH g AS (
      SELECT l_returnflag, {', '.join(f'avg({m}) AS mu_{m}, stddev_samp({m}) AS sd_{m}' for m in _MEASURES)}
      FROM lineitem GROUP BY 1),
    f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(f'CAST(abs({m} - mu_{m}) > 1.5 * sd_{m} AND {m} <> mu_{m} AS INT) AS ex_{m}' for m in _MEASURES)}
          FROM lineitem JOIN g USING (l_returnflag))
    SELECT *, {' + '.join(f'ex_{m}' for m in _MEASURES)} AS total_extremes FROM f""",
)
def lineitem_outliers(spark, sf_dir):
    out = outliers.flag_outliers(
        table(spark, sf_dir, "lineitem"), "l_returnflag", _MEASURES, "l_orderkey", k=1.5, sentinels=(-1,)
    )
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[f"ex_{m}" for m in _MEASURES],
        "total_extremes",
    )


def _question_outliers_sql() -> str:
    parts = []
    for m in _MEASURES:
        parts.append(
            f"""SELECT '{m}' AS question, l_suppkey % 10 AS agent, CAST({m} AS DOUBLE) AS v FROM lineitem"""
        )
    long = " UNION ALL ".join(parts)
    return f"""WITH l AS ({long}),
    c AS (SELECT question, agent, CASE WHEN v NOT IN (-1, 98, 99) THEN v END AS v FROM l),
    g AS (SELECT question, avg(v) AS mu, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM c GROUP BY 1),
    a AS (SELECT question, agent, sum(CASE WHEN abs(v - mu) > 1.5 * sd THEN 1 ELSE 0 END) AS n
          FROM c JOIN g USING (question) GROUP BY 1, 2),
    t AS (SELECT question, agent, n FROM a QUALIFY row_number() OVER (PARTITION BY question ORDER BY n DESC, agent) = 1)
    SELECT g.question, round(mu, 2) AS mean, lo AS minimum, hi AS maximum,
           CASE WHEN t.n > 0 AND sd > 0 THEN t.agent END AS top_agent,
           CAST((SELECT sum(n) FROM a WHERE a.question = g.question) AS BIGINT) AS outliers
    FROM g JOIN t USING (question)"""


@query("question_outlier_summary", _question_outliers_sql())
def question_outlier_summary(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("agent", F.col("l_suppkey") % 10)
    return outliers.question_outlier_summary(lines, _MEASURES, "agent", k=1.5)


# ---- don't know / no answer --------------------------------------------------------

_ANSWERS = {
    "q1": "CASE WHEN l_orderkey % 7 = 0 THEN ' 98 ' WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END",
    "q2": "CASE WHEN l_partkey % 5 = 0 THEN '99' ELSE CAST(l_partkey AS VARCHAR) END",
    "q3": "CASE WHEN l_suppkey % 3 = 0 THEN '-1' ELSE l_returnflag END",
    "q4": "CASE WHEN l_quantity > 40 THEN '98' WHEN l_quantity > 35 THEN NULL ELSE 'x' END",
    "q5": "CASE WHEN l_linestatus = 'F' THEN '99' ELSE '9' END",
}
_NSNR_BASE = f"""a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_suppkey % 10 AS agent,
      {', '.join(f'{sql} AS {q}' for q, sql in _ANSWERS.items())} FROM lineitem)"""


def _answers(spark, sf_dir):
    text = {q: F.expr(sql.replace("VARCHAR", "STRING")) for q, sql in _ANSWERS.items()}
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        (F.col("l_suppkey") % 10).alias("agent"), *[c.alias(q) for q, c in text.items()],
    )


def _hit(q: str) -> str:
    return f"coalesce(trim({q}) IN ('-1', '98', '99'), FALSE)"


_COUNTED = f"""n AS (SELECT *, {' + '.join(f'CAST({_hit(q)} AS INT)' for q in _ANSWERS)} AS total_nsnr,
      {' + '.join(f'CAST({q} IS NOT NULL AS INT)' for q in _ANSWERS)} AS questions_seen FROM a)"""


@query(
    "nsnr_counts",
    f"""WITH {_NSNR_BASE}, {_COUNTED}
    SELECT l_orderkey, l_linenumber, l_partkey, total_nsnr, questions_seen,
           round(CASE WHEN questions_seen > 0 THEN total_nsnr / questions_seen * 100 ELSE 0 END, 6) AS nsnr_rate
    FROM n""",
)
def nsnr_counts(spark, sf_dir):
    out = outliers.nsnr_counts(_answers(spark, sf_dir), list(_ANSWERS))
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "total_nsnr", "questions_seen",
        F.round("nsnr_rate", 6).alias("nsnr_rate"),
    )


def _nsnr_flags_sql(limit: str, floor: str) -> str:
    return f"""WITH {_NSNR_BASE}, {_COUNTED},
    g AS (SELECT l_returnflag, avg(total_nsnr) AS mu, stddev_samp(total_nsnr) AS sd FROM n GROUP BY 1),
    j AS (SELECT *, greatest(mu + 2 * sd, {floor}) AS threshold FROM n JOIN g USING (l_returnflag))
    SELECT l_orderkey, l_linenumber, l_partkey, total_nsnr, round(mu, 6) AS mu_nsnr, round(sd, 6) AS sd_nsnr,
           round(threshold, 6) AS nsnr_threshold, CAST(total_nsnr >= {limit} AS INT) AS alert_nsnr FROM j"""


def _nsnr_flags(spark, sf_dir, **options):
    out = outliers.flag_nsnr(
        _answers(spark, sf_dir), "l_returnflag", list(_ANSWERS), "l_orderkey", k=2, **options
    )
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "total_nsnr", "alert_nsnr",
        *[F.round(c, 6).alias(c) for c in ("mu_nsnr", "sd_nsnr", "nsnr_threshold")],
    )


@query("nsnr_flags", _nsnr_flags_sql("4", "5"))
def nsnr_flags(spark, sf_dir):
    return _nsnr_flags(spark, sf_dir)


@query("nsnr_flags_dynamic", _nsnr_flags_sql("threshold", "1"))
def nsnr_flags_dynamic(spark, sf_dir):
    return _nsnr_flags(spark, sf_dir, floor=1, use_dynamic=True)


@query(
    "nsnr_summary",
    f"""WITH {_NSNR_BASE}, l AS ({' UNION ALL '.join(
        f"SELECT '{q}' AS question, agent, CAST({_hit(q)} AS INT) AS hit FROM a" for q in _ANSWERS)}),
    t AS (SELECT question, agent, count(*) AS rows, sum(hit) AS n FROM l GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY question ORDER BY n DESC, agent) AS rn FROM t)
    SELECT question, CAST(sum(rows) AS BIGINT) AS surveys, CAST(sum(n) AS BIGINT) AS total_nsnr,
           CAST(round(CAST(sum(n) AS DOUBLE) / sum(rows) * 100, 2) AS DOUBLE) AS incidence_rate,
           max(CASE WHEN rn = 1 AND n > 0 THEN agent END) AS top_agent,
           CAST(max(CASE WHEN rn = 1 THEN n END) AS BIGINT) AS top_agent_count
    FROM r GROUP BY question""",
)
def nsnr_summary(spark, sf_dir):
    return outliers.question_nsnr_summary(_answers(spark, sf_dir), list(_ANSWERS), "agent")


# ---- form logic --------------------------------------------------------------------

RULES = [
    FormRule("segment", required=True, relevant="nation < 10", label="<b>Segment</b> of the customer"),
    FormRule("balance", required=True, relevant=None, label="Account balance"),
    FormRule("orders", required=False, relevant="segment = 'BUILDING'", label="Orders"),
    FormRule("nation", required=True, relevant="balance > 0", label="Nation"),
    FormRule("not_in_data", required=True),
]
_FORM = """f AS (
      SELECT c_custkey AS id, nullif(c_mktsegment, 'MACHINERY') AS segment,
             CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS balance, n AS orders,
             CASE WHEN c_nationkey % 6 <> 0 THEN c_nationkey END AS nation
      FROM customer LEFT JOIN (SELECT CASE WHEN o_custkey % 4 <> 0 THEN o_custkey END AS k, CAST(count(*) AS BIGINT) AS n
                               FROM orders GROUP BY 1) ON c_custkey = k)"""


def form_answers(spark, sf_dir):
    known = F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").groupBy(known.alias("k")).agg(F.count(F.lit(1)).alias("orders"))
    customers = table(spark, sf_dir, "customer")
    joined = customers.join(orders, customers.c_custkey == orders.k, "left")
    return joined.select(
        F.col("c_custkey").alias("id"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"),
        F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")).alias("balance"),
        "orders",
        F.when(F.col("c_nationkey") % 6 != 0, F.col("c_nationkey")).alias("nation"),
    )


_MISSING = f"""{_FORM}, m AS (
      SELECT *, CAST(coalesce(nation < 10, FALSE) AND segment IS NULL AS INT) AS m_segment,
             CAST(balance IS NULL AS INT) AS m_balance,
             CAST(coalesce(balance > 0, FALSE) AND nation IS NULL AS INT) AS m_nation FROM f)"""
_SKIPS = f"""{_MISSING}, s AS (
      SELECT *, CAST(NOT coalesce(nation < 10, FALSE) AND segment IS NOT NULL AS INT) AS s_segment,
             0 AS s_balance,
             CAST(NOT coalesce(segment = 'BUILDING', FALSE) AND orders IS NOT NULL AS INT) AS s_orders,
             CAST(NOT coalesce(balance > 0, FALSE) AND nation IS NOT NULL AS INT) AS s_nation FROM m)"""


@query(
    "missing_flags",
    f"""WITH {_MISSING} SELECT id, m_segment, m_balance, m_nation,
        m_segment + m_balance + m_nation AS total_missing FROM m""",
)
def missing_flags(spark, sf_dir):
    out = formlogic.flag_missing(form_answers(spark, sf_dir), RULES)
    return out.select("id", "m_segment", "m_balance", "m_nation", "total_missing")


# The same form in its own words: a question inside groups whose conditions count as well.
FORM_ROWS = [
    ("all", None, None, None, None, 1),
    ("person", None, "yes", None, "all", 2),
    ("place", None, None, "${balance} > 0", "all", 3),
    ("segment", "Segment", None, "${nation} < 10", "person", 4),
    ("balance", "Balance", None, None, "person", 5),
    ("orders", "Orders", "no", "${segment} = 'BUILDING' or selected(${segment}, 'FURNITURE')", "all", 6),
    ("nation", "Nation", "yes", "not(${segment} = 'AUTOMOBILE')", "place", 7),
]


@query(
    "form_conditions",
    f"""WITH {_FORM} SELECT id,
      CAST(coalesce(nation < 10, FALSE) AND segment IS NULL AS INT) AS m_segment,
      CAST(balance IS NULL AS INT) AS m_balance,
      CAST(coalesce(balance > 0, FALSE) AND coalesce(segment <> 'AUTOMOBILE', TRUE) AND nation IS NULL AS INT) AS m_nation,
      CAST(NOT coalesce(nation < 10, FALSE) AND segment IS NOT NULL AS INT) AS s_segment,
      CAST(NOT coalesce(segment IN ('BUILDING', 'FURNITURE'), FALSE) AND orders IS NOT NULL AS INT) AS s_orders,
      CAST(NOT (coalesce(balance > 0, FALSE) AND coalesce(segment <> 'AUTOMOBILE', TRUE)) AND nation IS NOT NULL AS INT) AS s_nation FROM f""",
)
def form_conditions(spark, sf_dir):
    """Missing and skipped answers by the form's own conditions and its groups."""
    form = literal_table(spark, FORM_ROWS, "variable string,label string,required string,relevant string,group string,position int")
    answers = form_answers(spark, sf_dir)
    rules = form_rules(form, answers.columns)
    out = formlogic.flag_skips(formlogic.flag_missing(answers, rules), rules)
    return out.select("id", "m_segment", "m_balance", "m_nation", "s_segment", "s_orders", "s_nation")


@query(
    "required_groups",
    """WITH RECURSIVE form AS (
      SELECT 'r' || r_regionkey AS variable, NULL AS parent, r_regionkey % 2 = 0 AS required, CASE WHEN r_regionkey <> 1 THEN 'region ' || r_name END AS relevant FROM region
      UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey % 7 = 0, CASE WHEN n_nationkey % 3 = 0 THEN 'nation ' || n_name END FROM nation
      UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_custkey % 5 = 0, CASE WHEN c_custkey % 2 = 0 THEN 'customer ' || c_mktsegment END FROM customer
      UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, FALSE, 'order ' || o_orderstatus FROM orders),
    up AS (
      SELECT variable, parent, required, CASE WHEN relevant IS NULL THEN [] ELSE [relevant] END AS said FROM form
      UNION ALL SELECT up.variable, form.parent, up.required OR form.required, CASE WHEN form.relevant IS NULL THEN said ELSE list_concat([form.relevant], said) END
      FROM up JOIN form ON up.parent = form.variable)
    SELECT variable, required, array_to_string(said, ' and ') AS relevant FROM up WHERE parent IS NULL""",
)
def required_groups(spark, sf_dir):
    """Orders in customers, nations and regions as questions in three nested groups."""
    def level(name: str, variable: str, parent: str, required: str, relevant: str):
        return table(spark, sf_dir, name).selectExpr(f"{variable} as variable", f"{parent} as group", f"{required} as required", f"{relevant} as relevant")

    form = level("region", "'r' || r_regionkey", "cast(null as string)", "r_regionkey % 2 = 0", "case when r_regionkey <> 1 then 'region ' || r_name end")
    form = form.unionByName(level("nation", "'n' || n_nationkey", "'r' || n_regionkey", "n_nationkey % 7 = 0", "case when n_nationkey % 3 = 0 then 'nation ' || n_name end"))
    form = form.unionByName(level("customer", "'c' || c_custkey", "'n' || c_nationkey", "c_custkey % 5 = 0", "case when c_custkey % 2 = 0 then 'customer ' || c_mktsegment end"))
    form = form.unionByName(level("orders", "'o' || o_orderkey", "'c' || o_custkey", "false", "'order ' || o_orderstatus"))
    out = with_groups(form, relevant="relevant")
    return out.select("variable", "required", F.array_join("relevant", " and ").alias("relevant"))


@query(
    "skip_flags",
    f"""WITH {_SKIPS} SELECT id, s_segment, s_balance, s_orders, 0 AS s_nation,
        s_segment + s_balance + s_orders + s_nation AS total_skips,
        s_segment + s_balance + s_orders AS total_without_ignored FROM s""",
)
def skip_flags(spark, sf_dir):
    """The ignored question's flag is 0; it counts in the total unless left out before."""
    answers = form_answers(spark, sf_dir)
    out = formlogic.flag_skips(answers, RULES, ignore=["nation"])
    out = formlogic.flag_skips(
        out, RULES, ignore=["nation"], ignore_before_total=True, total="total_without_ignored"
    )
    return out.select(
        "id", "s_segment", "s_balance", "s_orders", "s_nation", "total_skips", "total_without_ignored"
    )


@query(
    "findings_long",
    f"""WITH {_SKIPS}, l AS (
      {' UNION ALL '.join(f"SELECT id, '{c}' AS finding, {c} AS v FROM s" for c in
        ('m_segment', 'm_balance', 'm_nation', 's_segment', 's_balance', 's_orders', 's_nation'))})
    SELECT id, finding, CASE WHEN finding LIKE 'm\\_%' ESCAPE '\\' THEN 'Missing' ELSE 'Salto' END AS kind,
           substr(finding, 3) AS variable FROM l WHERE v = 1""",
)
def findings_long(spark, sf_dir):
    out = formlogic.flag_missing(form_answers(spark, sf_dir), RULES)
    return formlogic.findings(formlogic.flag_skips(out, RULES), ["id"])


@query("missing_drilldown", f"WITH {_MISSING} SELECT id, balance FROM m WHERE m_nation = 1")
def missing_drilldown(spark, sf_dir):
    out = formlogic.flag_missing(form_answers(spark, sf_dir), RULES)
    return formlogic.with_finding(out, "nation").select("id", "balance")


# ---- duplicates --------------------------------------------------------------------

_CAPITALS = "translate(upper({x}), 'ÁÉÍÓÚÑ', 'AEIOUN')"
_IDENTITY = f"""i AS (
      SELECT c_custkey AS key, CASE
        WHEN c_mktsegment = 'BUILDING' THEN coalesce(CAST(nullif(c_nationkey, 4) AS VARCHAR), 'NA') || '_' || coalesce(CAST(nullif(c_custkey % 7, 0) AS VARCHAR), 'NA')
        WHEN c_mktsegment = 'MACHINERY' THEN c_name || '_' || CAST(c_nationkey AS VARCHAR)
        WHEN c_mktsegment <> 'HOUSEHOLD' THEN CAST(c_nationkey AS VARCHAR) || '_' || 'ñandú  ' || c_mktsegment
      END AS raw FROM customer),
    d AS (SELECT key, {squish_sql(_CAPITALS.format(x='raw'))} AS identity FROM i),
    f AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY identity) > 1 AND identity IS NULL THEN NULL
                  ELSE CAST(count(*) OVER (PARTITION BY identity) > 1 AND identity <> '' AS INT) END AS duplicate
          FROM d)"""


def _identities(spark, sf_dir):
    segment = F.col("c_mktsegment")
    identity = duplicates.identity(
        [
            (segment == "BUILDING",
             [F.nullif(F.col("c_nationkey"), F.lit(4)), F.nullif(F.col("c_custkey") % 7, F.lit(0))]),
            (segment == "MACHINERY", ["c_name", "c_nationkey"]),
            (segment != "HOUSEHOLD", ["c_nationkey", F.concat(F.lit("ñandú  "), segment)]),
        ]
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), identity.alias("identity")
    )


@query("identity_duplicates", f"WITH {_IDENTITY} SELECT key, identity, duplicate FROM f")
def identity_duplicates(spark, sf_dir):
    return duplicates.flag_duplicates(_identities(spark, sf_dir), "identity", "key")


@query("duplicate_review", f"WITH {_IDENTITY} SELECT duplicate, key, identity FROM f WHERE duplicate = 1")
def duplicate_review(spark, sf_dir):
    flagged = duplicates.flag_duplicates(_identities(spark, sf_dir), "identity", "key")
    return duplicates.duplicate_review(flagged, "duplicate", ["key", "identity"])


@query(
    "lift_duplicates",
    f"""WITH {_IDENTITY}
    SELECT key, CASE WHEN key IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) THEN 0
                     ELSE duplicate END AS duplicate FROM f""",
)
def lift_duplicates(spark, sf_dir):
    flagged = duplicates.flag_duplicates(_identities(spark, sf_dir), "identity", "key")
    keys = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select("s_suppkey")
    return duplicates.lift_duplicates(flagged, "key", keys, ["duplicate"]).select("key", "duplicate")


@query(
    "document_duplicates",
    f"""WITH d AS (SELECT doc_id, {squish_sql(_CAPITALS.format(x="replace(text, 'ß', 'ss')"))} AS t FROM documents)
    SELECT doc_id, CAST(count(*) OVER (PARTITION BY t) > 1 AND t <> '' AS INT) AS duplicate FROM d""",
)
def document_duplicates(spark, sf_dir):
    """Whole texts as identities; only their digests are grouped."""
    plain = F.replace(F.col("text"), F.lit("ß"), F.lit("ss"))
    identity = duplicates.identity([(F.lit(True), [plain])])
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(identity == "", "").otherwise(F.sha2(identity, 256)).alias("identity")
    )
    docs = cut_lineage(docs, "identities")  # texts are read and folded once, not for the counts and the join
    out = duplicates.flag_duplicates(docs, "identity", "doc_id")
    return out.select("doc_id", "duplicate")
