"""Wide to long, long to wide, unions and transposed summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import ColumnLike, as_column


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    names: Sequence[str],
    *,
    name: str = "name",
    value: str = "value",
    as_type: str = "string",
) -> DataFrame:
    """One row per id and column; values are cast to one type first."""
    ready = df.select(*ids, *[as_column(n).cast(as_type).alias(n) for n in names])
    return ready.unpivot(
        [as_column(i) for i in ids], [as_column(n) for n in names], name, value
    )


def listed(name: ColumnLike, values: Sequence[object], other: str | None = None) -> Column:
    """The value itself where it is listed; any other is ``other``, or an error if that is not given."""
    column = as_column(name)
    known = [v for v in values if v is not None]
    hit = column.isin(*known) if known else F.lit(False)
    if None in values:
        hit = hit | column.isNull()
    text = F.concat(F.lit(f"not among the listed columns of {name}: "), F.coalesce(column.cast("string"), F.lit("NULL")))
    rest = F.raise_error(text) if other is None else F.lit(other)
    return F.when(F.coalesce(hit, F.lit(False)), column).otherwise(rest)


def to_wide(
    df: DataFrame,
    ids: Sequence[str],
    name: str,
    value: str,
    values: Sequence[object],
    *,
    fill: object | None = None,
) -> DataFrame:
    """One column per listed value of ``name``; the columns are given, not discovered.

    A value that is not listed is an error, so that nothing is lost silently. Of several
    rows for one cell the largest value stands.
    """
    wide = df.withColumn(name, listed(name, values)).groupBy(*ids).pivot(name, list(values)).agg(F.max(value))
    if fill is None:
        return wide
    return wide.withColumns(
        {str(v): F.coalesce(as_column(str(v)), F.lit(fill)) for v in values}
    )


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; columns a table lacks are NULL."""
    if not frames:
        raise ValueError("nothing to stack")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def counts_to_columns(
    df: DataFrame,
    group: str,
    category: str,
    values: Sequence[object],
    *,
    total: str = "total",
    other: str | None = None,
) -> DataFrame:
    """Rows per group and listed category as columns, and all rows of the group as ``total``.

    Rows of other categories, NULL among them, are counted in ``total`` and, if named, in a
    column ``other``.
    """
    known = F.coalesce(as_column(category).isin(*values), F.lit(False))
    counts = [F.count_if(F.coalesce(as_column(category) == v, F.lit(False))).alias(str(v)) for v in values]
    if other is not None:
        counts.append(F.count_if(~known).alias(other))
    return df.groupBy(group).agg(*counts, F.count(F.lit(1)).alias(total))


def full_join_by(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join of two summaries; a NULL key meets a NULL key."""
    other = right.withColumnRenamed(key, "__key")
    joined = left.join(other, as_column(key).eqNullSafe(F.col("__key")), "full")
    return joined.select(
        F.coalesce(as_column(key), F.col("__key")).alias(key),
        *[as_column(c) for c in left.columns if c != key],
        *[as_column(c) for c in right.columns if c != key],
    )


def column_values(df: DataFrame, column: str) -> list:
    """Sorted distinct values that become columns; each is a part of the plan, however many there are."""
    return [r[0] for r in df.select(column).distinct().orderBy(as_column(column).asc_nulls_last()).collect()]


def transpose_summary(
    summary: DataFrame,
    column: str,
    indicators: Sequence[str],
    *,
    values: Sequence[object] | None = None,
    name: str = "indicator",
) -> DataFrame:
    """Turn a summary round: its keys become columns, its indicators rows, NULL is 0."""
    keys = list(values) if values is not None else column_values(summary, column)
    long = to_long(summary, [column], indicators, name=name, value="v", as_type="bigint")
    filled = long.withColumns(
        {
            "v": F.coalesce("v", F.lit(0)),
            column: F.coalesce(as_column(column).cast("string"), F.lit("NA")),
        }
    )
    texts = ["NA" if k is None else str(k) for k in keys]
    return to_wide(filled, [name], column, "v", texts, fill=0)
