"""Giving rows the figures of their group without funnelling a group into one task.

A window over ``partitionBy(key)`` sends a whole group to one task. When one key may hold
a third of all rows that task is the job. The operators of this package therefore
aggregate first (partial aggregation shrinks any hot key before the shuffle) and bring the
figures back in one of two ways:

* few groups: the figures are counted and, if at most ``SMALL_ROWS``, broadcast;
* many groups: an equi-join in which only the *hot* keys are salted. A key is hot when it
  holds more than ``HOT_SHARE`` of the rows, so there are at most ``1 / HOT_SHARE`` of
  them whatever the size of the data. Each is cut into as many parts as its own row count
  asks for, so that a part has about ``HOT_ROWS`` rows at any scale; keys below that share
  are left to the skew handling of the join at run time.

The list of hot keys and the figures come from one and the same aggregation, whose
exchange is reused: the table is read once for it and once for the join.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions.columns import as_column

SMALL_ROWS = 2_000
HOT_SHARE = 1 / 256
HOT_ROWS = 200_000

_N = "__rows"
_SALT = "__salt"
_HOT = "__hot_parts"


def same_keys(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe equality over several keys: NULL meets NULL."""
    condition = F.lit(True)
    for a, b in zip(left, right, strict=True):
        condition = condition & a.eqNullSafe(b)
    return condition


def small_copy(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame | None:
    """A driver-side copy of a table proven to have at most ``max_rows`` rows, else None.

    At most ``max_rows + 1`` rows ever reach the driver. The copy is exact, so the table
    is computed once and its broadcast size is known.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def literal_table(
    spark: SparkSession, rows: Sequence[tuple], schema: str, max_rows: int = SMALL_ROWS
) -> DataFrame:
    """A dictionary given in code; hinted for broadcast while it is short."""
    names = [field.split()[0] for field in schema.split(",")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    arrow = pa.table({n: pa.array(list(c)) for n, c in zip(names, columns, strict=True)})
    table = spark.createDataFrame(arrow).select(
        *[as_column(f.split()[0]).cast(f.split()[1]) for f in schema.split(",")]
    )
    return F.broadcast(table) if len(rows) <= max_rows else table


def _join_on(df: DataFrame, right: DataFrame, keys: Sequence[str], how: str, extra: Sequence[str] = ()) -> DataFrame:
    names = [*keys, *extra]
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in names})
    condition = same_keys(
        [df[f"`{k}`"] for k in names], [renamed[f"`__r_{k}`"] for k in names]
    )
    return df.join(renamed, condition, how).drop(*[f"__r_{k}" for k in names])


def group_figures(df: DataFrame, keys: Sequence[str], figures: dict[str, Column]) -> DataFrame:
    """One row per group with its figures and its row count."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(_N), *[c.alias(n) for n, c in figures.items()]
    )


def attach_small(
    df: DataFrame,
    keys: Sequence[str],
    figures: dict[str, Column],
    *,
    spread_by: Sequence[str],
    max_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Attach group figures where groups are expected to be few (status categories).

    Falls back to the salted join when there turn out to be more than ``max_rows``.
    """
    groups = group_figures(df, keys, figures)
    copy = small_copy(groups, max_rows)
    if copy is None:
        return _attach(df, groups, groups, keys, "left", spread_by, HOT_ROWS)
    return _join_on(df, F.broadcast(copy.drop(_N)), keys, "left")


def attach_groups(
    df: DataFrame,
    keys: Sequence[str],
    figures: dict[str, Column],
    *,
    spread_by: Sequence[str],
    keep: Column | None = None,
    how: str = "left",
    rows_as: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Attach group figures where groups may be many and of any size.

    ``keep`` filters the groups before the join: with ``how="inner"`` it selects whole
    groups, with ``"left"`` rows of other groups get NULL. ``spread_by`` names the columns
    (a row key) whose hash spreads the rows of a hot group. ``rows_as`` names the group's
    row count if that is wanted too; when it is all that is wanted, the same aggregation
    serves to find the hot keys.
    """
    groups = group_figures(df, keys, figures)
    kept = groups if keep is None else groups.filter(keep)
    if rows_as:
        kept = kept.withColumn(rows_as, F.col(_N))
    return _attach(df, groups, kept, keys, how, spread_by, hot_rows)


def keep_groups(
    df: DataFrame,
    keys: Sequence[str],
    condition: Column,
    *,
    spread_by: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All rows of the groups whose aggregate ``condition`` holds."""
    out = attach_groups(
        df, keys, {"__hit": condition}, spread_by=spread_by, keep=F.col("__hit"),
        how="inner", hot_rows=hot_rows,
    )
    return out.drop("__hit")


def hot_groups(
    groups: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS
) -> tuple[Column, Column]:
    """From a :func:`group_figures` table: the row count above which a group is hot, and,
    by a row's own keys, into how many parts its group is cut (NULL where it is not hot).
    """
    # Every figure is asked for, so that this is the aggregation that the join uses, too.
    figures = [as_column(c) for c in groups.columns if c not in (*keys, _N)]
    whole = groups.filter((F.col(_N) > 0) | (F.xxhash64(*figures) == 0)) if figures else groups
    total = whole.agg(F.sum(_N)).scalar()
    limit = F.greatest(F.lit(hot_rows).cast("double"), total * F.lit(HOT_SHARE))
    this_key = F.struct(*[as_column(k) for k in keys])
    # at most 1 / HOT_SHARE keys can each hold more than HOT_SHARE of the rows
    entries = F.collect_list(F.struct(this_key, parts_of(F.col(_N), hot_rows)))
    hot_keys = whole.filter(F.col(_N) > limit).agg(F.map_from_entries(entries)).scalar()
    return limit, F.try_element_at(hot_keys, this_key)


def parts_of(rows: Column, hot_rows: int = HOT_ROWS) -> Column:
    """Parts of about ``hot_rows`` rows, two at least."""
    return F.greatest(F.lit(2), F.ceil(rows / F.lit(max(hot_rows, 1)))).cast("int")


def _attach(
    df: DataFrame,
    groups: DataFrame,
    kept: DataFrame,
    keys: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    hot_rows: int,
) -> DataFrame:
    limit, parts = hot_groups(groups, keys, hot_rows)
    spread = F.pmod(F.xxhash64(*[as_column(c) for c in spread_by]), F.col(_HOT).cast("bigint")).cast("int")
    salted = df.withColumn(_HOT, parts).withColumn(_SALT, F.coalesce(spread, F.lit(0))).drop(_HOT)
    copies = F.when(
        F.col(_N) > limit, F.sequence(F.lit(0), parts_of(F.col(_N), hot_rows) - 1)
    ).otherwise(F.array(F.lit(0)))
    right = kept.withColumn(_SALT, F.explode(copies)).drop(_N)
    return _join_on(salted, right, keys, how, extra=[_SALT]).drop(_SALT)
