"""Form submissions: landed JSON exports to one wide table of texts."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canvass.functions.columns import with_snake_names
from canvass.operators.reshape import union_by_name
from canvass.session import cut_lineage


def leaf_columns(schema: T.StructType) -> list[tuple[str, Column]]:
    """``(dotted name, column)`` of every leaf below nested objects."""
    leaves: list[tuple[str, Column]] = []

    def walk(fields: Sequence[T.StructField], path: tuple[str, ...]) -> None:
        for field in fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType.fields, here)
            else:
                column = F.col(".".join(f"`{p}`" for p in here))
                if isinstance(field.dataType, (T.ArrayType, T.MapType)):
                    column = F.to_json(column)
                leaves.append((".".join(here), column))

    walk(schema.fields, ())
    return leaves


def flatten(df: DataFrame) -> DataFrame:
    """Nested objects to dotted columns; lists become JSON text."""
    return df.select(*[c.alias(name) for name, c in leaf_columns(df.schema)])


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text, empty text as NULL."""
    return df.select(
        *[F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns]
    )


def parse_json_column(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """Replace a JSON text column by its flattened fields as text."""
    rest = [c for c in df.columns if c != column]
    parsed = df.withColumn(column, F.from_json(column, schema))
    leaves = leaf_columns(T.StructType([parsed.schema[column]]))
    return parsed.select(
        *rest, *[F.nullif(c.cast("string"), F.lit("")).alias(n) for n, c in leaves]
    )


def read_form(
    spark: SparkSession, path: str, *, multi_line: bool = True, schema: T.StructType | None = None
) -> DataFrame:
    """One landed form export as texts.

    An export that is one JSON document needs ``multi_line`` and is read by one task per
    file; land large forms as JSON lines. With a ``schema`` no pass over the data is spent
    on finding it.
    """
    reader = spark.read.option("multiLine", multi_line).option("primitivesAsString", True)
    if schema is not None:
        reader = reader.schema(schema)
    return all_text(flatten(reader.json(path)))


def read_forms(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    multi_line: bool = True,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Several forms stacked by name with clean column names.

    A form that cannot be found is skipped with a warning.
    """
    frames = []
    for path in paths:
        try:
            frames.append(read_form(spark, path, multi_line=multi_line, schema=schema))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            warnings.warn(f"form skipped, nothing at {path}", stacklevel=2)
    return with_snake_names(union_by_name(frames))


CORRUPT = "__corrupt"
REFUSED = "form string, record string, reason string"


def read_checked_forms(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    multi_line: bool = True,
    schema: T.StructType | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Several forms stacked as by :func:`read_forms`, and what could not be read of them, ``(form, record, reason)``.

    Malformed records are set aside, the others of their form stay. Each form is written once, so that one
    that fails while it is read (a file cut off, not only a missing one) is refused as a whole with a warning and does
    not hurt the rest.
    """
    frames, refused = [], [spark.createDataFrame([], REFUSED)]
    for path in paths:
        reader = spark.read.option("multiLine", multi_line).option("primitivesAsString", True)
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        try:
            form = cut_lineage(all_text(flatten(reader.json(path))), "form")
        except Exception as error:  # whatever is wrong with one form, the others are read
            reason = str(error).strip().splitlines()[0][:500]
            refused.append(spark.createDataFrame([(path, None, reason)], REFUSED))
            warnings.warn(f"form refused, {path}: {reason}", stacklevel=2)
            continue
        if CORRUPT in form.columns:
            bad = form.filter(F.col(CORRUPT).isNotNull())
            refused.append(bad.select(F.lit(path).alias("form"), F.col(CORRUPT).alias("record"), F.lit("malformed record").alias("reason")))
            form = form.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        if form.columns:
            frames.append(form)
    if not frames:
        raise ValueError("none of the forms could be read")
    return with_snake_names(union_by_name(frames)), union_by_name(refused)
