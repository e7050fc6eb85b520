"""Comment rules, garbage answers, labels and plain text functions, over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from canvass.catalog.registry import query, table
from canvass.functions.quality import is_garbage
from canvass.functions.text import (
    LETTER_FOLDS,
    address_text,
    blank_safe,
    block_label,
    fold_capitals,
    fold_latin,
    paste,
    squish,
    strip_html,
    strip_prefix,
    trim_all,
    truncate,
)
from canvass.operators import textquality
from canvass.sources.tables import label_dictionary

WHITE = r"[\s\x{0b}\x{85}\p{Z}]"

# A rule list written for the given texts; codes 3 and above 9 have no rule.
RULES = [
    ("licen[cs]e|copyright|all rights", 9),
    ("@|mail", 8),
    ("http|www", 7),
    (" und | ist | nicht ", 6),
    ("ção|ción| los | las ", 5),
    ("é|è|ê|ç", 4),
    ("[0-9]{3}", 2),
    (" the ", 1),
]
LABELS = {
    1: "ENGLISH", 2: "NUMBERS", 4: "FRENCH", 5: "SPANISH", 6: "GERMAN", 7: "LINK", 8: "MAIL",
    9: "LICENSE",
}


def trim_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^{WHITE}+|{WHITE}+$', '', 'g')"


def squish_sql(x: str) -> str:
    return rf"trim(regexp_replace({x}, '{WHITE}+', ' ', 'g'))"


def fold_sql(x: str) -> str:
    for letter, plain in LETTER_FOLDS.items():
        x = f"replace({x}, '{letter}', '{plain}')"
    return f"strip_accents({x})"


def garbage_sql(x: str) -> str:
    t = fold_sql(f"lower({trim_sql(x)})")
    return rf"""(SELECT CASE
        WHEN t IS NULL OR t = '' OR len(regexp_extract_all(t, '[^\s\p{{Z}}]+')) >= 3 THEN 0
        WHEN regexp_matches(t, 'qwer|asdf|sdfg|dfgh|ghjk|zxcv|cvbn|vbnm|wert|tyui|uio') THEN 1
        WHEN len(t) > 5 AND len(list_distinct(regexp_extract_all(t, '(?s).'))) / len(t) < 0.35 THEN 1
        WHEN len(t) >= 4 AND NOT regexp_matches(t, '[aeiou]') THEN 1
        WHEN len(t) > 5 AND regexp_matches(t, '[bcdfghjklmnpqrstvwxyz]{{4,}}') THEN 1
        ELSE 0 END FROM (SELECT {t} AS t))"""


_CASE = " ".join(f"WHEN regexp_matches(t, '{p}') THEN {c}" for p, c in RULES)
_LABEL = " ".join(f"WHEN {c} THEN '{v}'" for c, v in LABELS.items())
_COMMENTS = f"""WITH d AS (
      SELECT doc_id, nullif(doc_id % 10, 0) AS declared, lower({trim_sql('text')}) AS t FROM documents),
    c AS (SELECT *, CASE {_CASE} END AS comment_code FROM d),
    l AS (SELECT *, coalesce(CASE comment_code {_LABEL} END, 'NO CLEAR CATEGORY') AS comment_label FROM c)"""


def _comments(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select(
        "doc_id", F.nullif(F.col("doc_id") % 10, F.lit(0)).alias("declared"), "text"
    )
    return textquality.classify_comments(df, "text", RULES, LABELS, "NO CLEAR CATEGORY")


@query("comment_rules", f"{_COMMENTS} SELECT doc_id, comment_code, comment_label FROM l")
def comment_rules(spark, sf_dir):
    return _comments(spark, sf_dir).select("doc_id", "comment_code", "comment_label")


_DISCREPANCY = f"""{_COMMENTS}, m AS (
      SELECT *, comment_code IS NOT NULL AND declared <> comment_code AS differs FROM l)
    SELECT doc_id, CAST(differs AS INT) AS comment_mismatch,
           CASE WHEN differs IS NULL THEN NULL
                WHEN differs THEN '⚠️ DISCREPANCIA: Marcó ' || coalesce(CAST(declared AS VARCHAR), 'NA')
                     || ' pero escribió ''' || comment_label || ''''
                ELSE 'OK' END AS comment_alert
    FROM m"""


@query("comment_discrepancy", _DISCREPANCY)
def comment_discrepancy(spark, sf_dir):
    out = textquality.comment_discrepancy(_comments(spark, sf_dir), "declared")
    return out.select("doc_id", "comment_mismatch", "comment_alert")


@query("discrepancy_review", f"SELECT doc_id, comment_alert FROM ({_DISCREPANCY}) WHERE comment_mismatch = 1")
def discrepancy_review(spark, sf_dir):
    out = textquality.comment_discrepancy(_comments(spark, sf_dir), "declared")
    return textquality.discrepancy_review(out, ["doc_id", "comment_alert"])


@query(
    "garbage_text",
    f"""WITH g AS (
      SELECT p_partkey, {garbage_sql('p_name')} AS trash_p_name, {garbage_sql('p_brand')} AS trash_p_brand,
             {garbage_sql('p_type')} AS trash_p_type FROM part)
    SELECT *, trash_p_name + trash_p_brand + trash_p_type AS total_garbage_text,
           CAST(trash_p_name + trash_p_brand + trash_p_type > 0 AS INT) AS flag_garbage_text FROM g""",
)
def garbage_text(spark, sf_dir):
    out = textquality.flag_garbage(table(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type", "absent"])
    return out.select(
        "p_partkey", "trash_p_name", "trash_p_brand", "trash_p_type", "total_garbage_text",
        "flag_garbage_text",
    )


@query(
    "garbage_documents",
    f"""SELECT doc_id, {garbage_sql('text')} AS trash FROM documents""",
)
def garbage_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", is_garbage("text").alias("trash"))


@query(
    "garbage_lines",
    f"""WITH w AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    g AS (SELECT doc_id, {garbage_sql('line')} AS trash FROM w)
    SELECT doc_id, CAST(count(*) AS BIGINT) AS lines, CAST(sum(trash) AS BIGINT) AS trash
    FROM g GROUP BY doc_id""",
)
def garbage_lines(spark, sf_dir):
    """Every line of every document read as one free-text answer."""
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("line")
    )
    return lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(is_garbage("line")).alias("trash")
    )


@query("garbage_urls", f"SELECT page_id, {garbage_sql('url')} AS trash FROM pages")
def garbage_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", is_garbage("url").alias("trash"))


@query(
    "label_dictionary",
    rf"""WITH p AS (
      SELECT page_id, regexp_extract(url, '//([^/]+)/', 1) AS name,
             {trim_sql("regexp_replace(html, '<[^>]*>', '', 'g')")} AS t FROM pages),
    o AS (SELECT page_id, name, CASE WHEN name LIKE 'm.%' THEN 'Mobile page' ELSE t END AS t FROM p),
    l AS (SELECT page_id, name, CASE WHEN len(t) > 45 THEN substr(t, 1, 42) || '...' ELSE t END AS label FROM o)
    SELECT name, arg_min(label, page_id) AS label FROM l GROUP BY name""",
)
def label_dictionary_query(spark, sf_dir):
    """Pages as form questions: the host is the name, the page its label."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "html", F.regexp_extract("url", "//([^/]+)/", 1).alias("name")
    )
    mobile = F.col("name").startswith("m.")
    labelled = pages.withColumn("html", F.when(mobile, "Mobile page").otherwise(F.col("html")))
    return label_dictionary(labelled, "name", "html", ["page_id"])


@query(
    "strip_html",
    r"SELECT page_id, md5(regexp_replace(html, '<[^>]*>', '', 'g')) AS digest FROM pages",
)
def strip_html_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(strip_html("html")).alias("digest"))


_CAPITALS = "translate(upper({x}), 'ÁÉÍÓÚÑ', 'AEIOUN')"


@query(
    "text_cleaning",
    f"""SELECT doc_id, md5({squish_sql('text')}) AS squished, md5({trim_sql('text')}) AS trimmed,
               md5({fold_sql('text')}) AS folded,
               md5({_CAPITALS.format(x="replace(text, 'ß', 'ss')")}) AS capitals,
               CASE WHEN len(text) > 45 THEN substr(text, 1, 42) || '...' ELSE text END AS cut
        FROM documents""",
)
def text_cleaning(spark, sf_dir):
    plain = F.replace(F.col("text"), F.lit("ß"), F.lit("ss"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(squish("text")).alias("squished"),
        F.md5(trim_all("text")).alias("trimmed"),
        F.md5(fold_latin("text")).alias("folded"),
        F.md5(fold_capitals(plain)).alias("capitals"),
        truncate("text").alias("cut"),
    )


@query(
    "address_text",
    f"""WITH c AS (
      SELECT c_custkey, nullif(c_name, 'Customer#000000007') AS street,
             CASE WHEN c_nationkey % 4 = 0 THEN 'NA' WHEN c_nationkey % 4 = 1 THEN '' ELSE c_mktsegment END AS floor
      FROM customer)
    SELECT c_custkey, {squish_sql("coalesce(street, '') || ' Piso ' || CASE WHEN floor = 'NA' THEN '' ELSE floor END || ' Apartamento ' || CAST(c_custkey AS VARCHAR)")} AS address
    FROM c""",
)
def address_text_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumns(
        {
            "street": F.nullif(F.col("c_name"), F.lit("Customer#000000007")),
            "floor": F.when(F.col("c_nationkey") % 4 == 0, "NA")
            .when(F.col("c_nationkey") % 4 == 1, "")
            .otherwise(F.col("c_mktsegment")),
        }
    )
    line = address_text([("", "street"), ("Piso", "floor"), ("Apartamento", "c_custkey")])
    return customers.select("c_custkey", line.alias("address"))


@query(
    "text_keys",
    r"""SELECT p_partkey,
           'Manzana ' || coalesce(nullif(regexp_extract(p_brand, '\d+'), ''), 'NA') AS block,
           'Manzana ' || coalesce(nullif(regexp_extract(p_name, '\d+'), ''), 'NA') AS no_block,
           coalesce(nullif(p_type, 'ECONOMY'), 'NA') || '_' || p_brand AS pasted,
           regexp_replace('m_' || p_name, '^[ms]_', '') AS bare,
           CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END AS safe
    FROM part""",
)
def text_keys(spark, sf_dir):
    kind = F.nullif(F.col("p_type"), F.lit("ECONOMY"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        block_label("p_brand").alias("block"),
        block_label("p_name").alias("no_block"),
        paste(kind, "p_brand", sep="_").alias("pasted"),
        strip_prefix(F.concat(F.lit("m_"), "p_name"), "[ms]_").alias("bare"),
        blank_safe(kind).alias("safe"),
    )
