"""Dimension tables and form rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions.columns import as_column
from canvass.functions.relevance import relevance_sql
from canvass.functions.text import label_text
from canvass.operators.formlogic import FormRule
from canvass.operators.summaries import first_by
from canvass.operators.visits import keep_first


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column stays text, blank and ``NA`` are NULL."""
    return spark.read.csv(path, header=True, inferSchema=False, nullValue="NA", multiLine=False)


def read_dimension(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A dimension sheet landed as CSV, parquet, JSON lines or ORC."""
    if fmt == "csv":
        return read_csv_text(spark, path)
    return spark.read.format(fmt).load(path)


def with_groups(table: DataFrame, variable: str = "variable", group: str = "group", required: str = "required", relevant: str = "relevant_sql") -> DataFrame:
    """The rules with what they take over from all groups around them, however deep.

    ``required`` holds if the question or any group around it is required; ``relevant`` becomes the array of all conditions,
    the outermost first. Each round looks two, four, eight, ... groups up, so the rounds grow with the logarithm of
    the depth. A group that is not in the table ends the way up; groups that hold each other are an error.
    """
    own = table.withColumns({
        "__up": as_column(group),
        "__required": F.coalesce(as_column(required).cast("boolean"), F.lit(False)),
        "__relevant": F.array_compact(F.array(as_column(relevant))),
    })
    size = table.count()
    for _ in range(size.bit_length() + 1):
        above = own.select(
            as_column(variable).alias("__name"), F.col("__up").alias("__next"), F.col("__required").alias("__r"), F.col("__relevant").alias("__c")
        ).dropDuplicates(["__name"])
        both = own.join(above, F.col("__up") == F.col("__name"), "left")
        own = both.withColumns({
            "__required": F.col("__required") | F.coalesce("__r", F.lit(False)),
            "__relevant": F.concat(F.coalesce("__c", F.array().cast("array<string>")), "__relevant"),
            "__up": F.col("__next"),
        }).drop("__name", "__next", "__r", "__c")
        if own.filter("__up is not null").isEmpty():
            return own.withColumns({required: F.col("__required"), relevant: F.col("__relevant")}).drop("__up", "__required", "__relevant")
    raise ValueError("groups hold each other")


def form_rules(table: DataFrame, names: Sequence[str], required_value: str = "yes") -> list[FormRule]:
    """Rules of the questions present in the data.

    The table has ``variable, label, required`` and ``relevant_sql`` (a predicate) or ``relevant`` (as the form writes
    it), and optionally ``group`` and ``position``. A question in a required group, however far up, is required too,
    and is asked only if the conditions of all groups around it hold. Of several rules of one variable the first by
    ``position`` counts, then by label and condition. The filter runs before anything is
    collected, so at most one rule per data column reaches the driver.
    """
    told = "relevant_sql" if "relevant_sql" in table.columns else "relevant"
    yes = F.coalesce(
        F.lower(as_column("required").cast("string")).isin(required_value.lower(), "true"),
        F.lit(False),
    )
    ready = table.withColumn("required", yes)
    order = [as_column(c).asc_nulls_last() for c in ("position", "label", told) if c in table.columns]
    ready = keep_first(ready.filter(as_column("variable").isNotNull()), ["variable"], order)
    if "group" in table.columns:
        ready = with_groups(ready, relevant=told)
    else:
        ready = ready.withColumn(told, F.array_compact(F.array(as_column(told))))
    wanted = ready.filter(as_column("variable").isin(*names)).select("variable", "label", "required", told)
    by_name = {r["variable"]: r for r in wanted.collect()}

    def condition(texts: Sequence[str]) -> str | None:
        parts = [t if told == "relevant_sql" else relevance_sql(t) for t in texts]
        parts = [p for p in parts if p]
        return parts[0] if len(parts) == 1 else " AND ".join(f"({p})" for p in parts) or None

    return [
        FormRule(n, by_name[n]["required"], condition(by_name[n][told]), by_name[n]["label"])
        for n in names
        if n in by_name
    ]



def label_dictionary(
    table: DataFrame,
    name: str,
    label: str,
    order: Sequence[str],
    *,
    overrides: Mapping[str, str] | None = None,
    width: int = 45,
) -> DataFrame:
    """One clean label per name: the first in the given order."""
    cleaned = table.select(
        as_column(name).alias("name"),
        label_text(label, name, overrides, width).alias("label"),
        *[as_column(o).alias(f"__o{i}") for i, o in enumerate(order)],
    )
    keys = [f"__o{i}" for i in range(len(order))]
    return cleaned.groupBy("name").agg(first_by("label", *keys).alias("label"))
