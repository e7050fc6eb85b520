"""Visit history of units: final visit, attempts, earlier closures, partial visits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.functions.columns import as_column
from canvass.functions.numbers import flag
from canvass.functions.rules import first_match
from canvass.operators.grouping import HOT_ROWS, attach_groups, keep_groups, small_copy
from canvass.session import cut_lineage

# Texts of the history alert.
REVISIT_AFTER_CLOSE = "⚠️ REVISITAR TRAS CIERRE"
DOUBLE_CLOSE = "⚠️ DOBLE CIERRE"
NORMAL_FOLLOW_UP = "Seguimiento normal"


def _in_time(time: str, key: str) -> Column:
    """Sort key for "earliest first", unknown times last, ties by row key."""
    at = as_column(time)
    return F.struct(at.isNull().alias("u"), at.alias("t"), as_column(key).alias("k"))


def _latest_first(time: str, key: str, rank: Column | None = None) -> Column:
    """Sort key for "latest first", unknown times last, ties by row key ascending."""
    at = as_column(time)
    micros = F.unix_micros(at.cast("timestamp"))
    parts = [] if rank is None else [(-F.coalesce(rank, F.lit(0))).alias("p")]
    return F.struct(*parts, at.isNull().alias("u"), (-micros).alias("t"), as_column(key).alias("k"))


def _rank(column: str | None, ranks: Mapping[str, int] | None) -> Column | None:
    if not ranks:
        return None
    return first_match([(as_column(column) == v, r) for v, r in ranks.items()], 0)


def mark_latest(
    df: DataFrame,
    unit: str,
    time: str,
    key: str,
    *,
    out: str = "is_final",
    priority_column: str | None = None,
    priority: Mapping[str, int] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Flag the latest row of each unit; rows without a unit form one group.

    ``key`` identifies a row and breaks ties. With ``priority`` the category decides
    before the time; the default is time alone.
    """
    order = _latest_first(time, key, _rank(priority_column, priority))
    with_first = attach_groups(
        df, [unit], {"__first": F.min(order)}, spread_by=[key], hot_rows=hot_rows
    )
    return with_first.withColumn(out, flag(order.eqNullSafe(F.col("__first")))).drop("__first")


def latest_only(
    df: DataFrame,
    unit: str,
    time: str,
    key: str,
    *,
    priority_column: str | None = None,
    priority: Mapping[str, int] | None = None,
) -> DataFrame:
    """Keep the latest row of each unit.

    The filter on ``row_number`` lets Spark keep one row per unit and task before the
    shuffle, so a hot unit arrives already reduced.
    """
    rank = _rank(priority_column, priority)
    order = [] if rank is None else [rank.desc()]
    order += [as_column(time).desc_nulls_last(), as_column(key).asc_nulls_last()]
    w = Window.partitionBy(unit).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order, all its columns kept."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


SAMPLE_ROWS = 1 << 16
PIECE_SAMPLE = 128


def _pieces(df: DataFrame, unit: str, order: Column, spread: Column, hot_rows: int, piece_sample: int) -> DataFrame | None:
    """Where to cut the units that hold a large share of all rows: ``(unit, splits)``, None if no unit does.

    ``SAMPLE_ROWS`` rows with the least hashes of their keys reach the driver, whatever the size of the table. How
    small these hashes are tells how many rows there are in all. A unit is hot that has at least ``piece_sample`` rows of the sample
    and about ``hot_rows`` in all; every ``piece_sample``-th of its sampled rows, in order, begins a new piece. The
    splits of a unit stand in rows of 16, so that a place is found by looking at a few.
    """
    sample = df.select(as_column(unit).alias("unit"), order.alias("at"), spread.alias("h")).orderBy("h").limit(SAMPLE_ROWS)
    sample = small_copy(sample, SAMPLE_ROWS)
    n, last = sample.agg(F.count(F.lit(1)), F.max("h")).first()
    times = 1.0 if n < SAMPLE_ROWS else 2.0**64 / (last + 2.0**63 + 1)
    hot = sample.groupBy("unit").agg(F.sort_array(F.collect_list("at")).alias("at"))
    hot = hot.filter(F.size("at") >= max(piece_sample, hot_rows / times))
    every = F.filter("at", lambda x, i: (i > 0) & (i % piece_sample == 0))
    rows = F.transform(F.sequence(F.lit(0), F.floor((F.size("splits") - 1) / 16).cast("int")), lambda k: F.slice("splits", k * 16 + 1, 16))
    splits = hot.select("unit", every.alias("splits")).filter(F.size("splits") > 0).select("unit", rows.alias("splits"))
    return small_copy(splits, SAMPLE_ROWS // piece_sample)


def number_attempts(
    df: DataFrame,
    unit: str,
    time: str,
    key: str,
    *,
    out: str = "attempt",
    hot_rows: int = HOT_ROWS,
    piece_sample: int = PIECE_SAMPLE,
) -> DataFrame:
    """Number the visits of each unit in time order; visits without a time come last, ties go by ``key``.

    A unit that holds a large share of all visits is cut at visits of a sample of fixed size, by time and key alike, so
    also where all its visits have no time or the same one. Its pieces are ordered by many tasks, the numbered rows
    are written once, and each piece is shifted by the rows of those before it; there are at most 512 pieces in all.
    Other units are numbered whole. The input is read for the sample and for the result.
    """
    at, row = as_column(time), as_column(key)
    order = F.struct(at.isNull().alias("u"), at.alias("t"), row.isNull().alias("n"), row.alias("k"))
    by_time = [at.asc_nulls_last(), row.asc_nulls_last()]
    splits = _pieces(df, unit, order, F.xxhash64(row), hot_rows, piece_sample)
    if splits is None or splits.isEmpty():
        return df.withColumn(out, F.row_number().over(Window.partitionBy(unit).orderBy(*by_time)))

    # One value for all rows; NULL units are a unit, too.
    every = splits.agg(F.map_from_entries(F.collect_list(F.struct(F.struct("unit"), "splits")))).scalar()
    df_columns = df.columns
    df = df.withColumn("__own", F.try_element_at(every, F.struct(as_column(unit).alias("unit"))))
    own = F.col("__own")
    upto = lambda splits: F.size(F.filter(splits, lambda s: s <= order))
    line = F.greatest(F.size(F.filter(own, lambda s: F.get(s, F.lit(0)) <= order)) - 1, F.lit(0))
    piece = F.when(own.isNotNull(), line * 16 + upto(F.get(own, line))).otherwise(0)
    inside = Window.partitionBy(unit, "__piece").orderBy(*by_time)
    hot = df.withColumns({"__piece": piece, "__hot": own.isNotNull()}).drop("__own").withColumn("__rn", F.row_number().over(inside))
    hot = cut_lineage(hot, "attempts")
    counts = hot.filter("__hot").groupBy(as_column(unit).alias("__unit"), F.col("__piece").alias("__before")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__unit").orderBy("__before").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("__unit", "__before", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__earlier"))
    same = as_column(unit).eqNullSafe(F.col("__unit")) & (F.col("__piece") == F.col("__before"))
    joined = hot.join(F.broadcast(earlier), same, "left")
    number = (F.col("__rn") + F.coalesce("__earlier", F.lit(0))).cast("bigint")
    return joined.withColumn(out, number).select(*df_columns, out)


def closure_history(
    df: DataFrame,
    unit: str,
    time: str,
    key: str,
    closed: Column,
    *,
    only_affected: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Visits after a closure: ``closed_before`` and ``history_alert`` per row.

    A row is "closed before" when a closing visit of its unit comes strictly earlier, so
    the earliest closing visit of the unit decides; no running window is needed. With
    ``only_affected`` all visits of the units having an alert are returned and others
    dropped; otherwise every visit of units with more than one visit.
    """
    order = _in_time(time, key)
    closing = F.coalesce(closed, F.lit(False))
    figures = {
        "__closed_at": F.min(F.when(closing, order)),
        "__last": F.max(order),
    }
    alerted = F.col("__closed_at").isNotNull() & (F.col("__last") > F.col("__closed_at"))
    keep = alerted if only_affected else F.col("__rows") > 1
    joined = attach_groups(
        df, [unit], figures, spread_by=[key], keep=keep, how="inner", hot_rows=hot_rows
    )
    before = F.coalesce(order > F.col("__closed_at"), F.lit(False))
    return joined.withColumns(
        {
            "closed_before": before,
            "history_alert": first_match(
                [(before & ~closing, REVISIT_AFTER_CLOSE), (before & closing, DOUBLE_CLOSE)],
                NORMAL_FOLLOW_UP,
            ),
        }
    ).drop("__closed_at", "__last")


def history_of_matching(
    df: DataFrame, unit: str, key: str, condition: Column, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All visits of the units that have at least one row meeting the condition."""
    hit = F.coalesce(F.bool_or(condition), F.lit(False))
    return keep_groups(df, [unit], hit, spread_by=[key], hot_rows=hot_rows)


def history_of_repeated(
    df: DataFrame, unit: str, key: str, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All visits of the units that have more than one."""
    return attach_groups(
        df, [unit], {}, spread_by=[key], keep=F.col("__rows") > 1, how="inner", hot_rows=hot_rows
    )


def effective_not_final(df: DataFrame, final: str, category: str, effective: str) -> DataFrame:
    """Effective visits superseded by a later one."""
    return df.filter((as_column(final) == 0) & (as_column(category) == effective))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once, with their counts; empty when the table is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
