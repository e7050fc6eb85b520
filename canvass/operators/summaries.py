"""Aggregates behind the reports.

All figures of a table come from one aggregation, so each report costs one shuffle of
partial results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import ColumnLike, as_column
from canvass.operators.reshape import listed
from canvass.session import cut_lineage


def count_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def count_where(condition: Column) -> Column:
    """Rows meeting the condition; unknown does not count."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def mean_where(value: ColumnLike, condition: Column) -> Column:
    return F.avg(F.when(condition, as_column(value)))


def distinct_count(
    value: ColumnLike, count_null: bool = True, *, approximate: bool = False
) -> Column:
    """Distinct values of a group; NULL counts as one value unless told otherwise."""
    column = as_column(value)
    known = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return known + F.max(column.isNull().cast("int")) if count_null else known


SKETCH_BITS = 14  # a relative standard error of about 0.8 %


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, *, out: str = "sketch") -> DataFrame:
    """A sketch of the distinct values for each group, to be kept and merged later: a day's rows are read once.

    NULL is no value. A group of NULLs has an empty sketch.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(as_column(column), F.lit(SKETCH_BITS)).alias(out))


def distinct_of_sketches(sketches: DataFrame, keys: Sequence[str], *, sketch: str = "sketch", out: str = "n") -> DataFrame:
    """About how many distinct values the sketches of each group have together, whatever days they are of."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(as_column(sketch))).alias(out))


def text_list(value: ColumnLike, sep: str = " | ") -> Column:
    """Distinct values of a group in sorted order as one text; NULL is written ``NA``.

    For values from a bounded set (staff, blocks): the text itself holds all of them.
    """
    texts = F.collect_set(F.coalesce(as_column(value).cast("string"), F.lit("NA")))
    return F.array_join(F.array_sort(texts), sep)


def first_by(value: ColumnLike, *order: ColumnLike) -> Column:
    """Value of the group's first row in the given order, NULL values included."""
    keys = F.struct(*[part for o in order for part in (as_column(o).isNull(), as_column(o))])
    return F.min_by(F.struct(as_column(value).alias("v")), keys)["v"]


def contingency(
    df: DataFrame,
    rows: str,
    columns: str,
    values: Sequence[object],
    *,
    keep_null_rows: bool = False,
) -> DataFrame:
    """Two-way counts with fixed columns; absent pairs are 0, NULLs left out, an unlisted value is an error."""
    data = df if keep_null_rows else df.filter(as_column(rows).isNotNull())
    data = data.withColumn(columns, listed(columns, [*values, None]))
    pivot = data.groupBy(rows).pivot(columns, list(values)).agg(F.count(F.lit(1)))
    names = [str(v) for v in values]
    return pivot.withColumns({n: F.coalesce(as_column(n), F.lit(0)) for n in names})


def one_way(df: DataFrame, column: str, *, keep_null: bool = False) -> DataFrame:
    data = df if keep_null else df.filter(as_column(column).isNotNull())
    return count_by(data, column)


FEW_VALUES = 20_000


def _value_at(data: DataFrame, ranks: Sequence[int], n: int, accuracy: int) -> dict[int, float]:
    """The values at some ranks (from 1) of all ``n`` values of ``x`` in ``data``, exactly.

    Each rank has an open interval that its value is in. One pass over the data takes approximate quantiles of all intervals;
    the next counts the rows below, at and between the two ends that these give, so that an interval shrinks to a
    small share of its rows or its value is found. Intervals of few rows are read whole. No rows are ordered, and what
    reaches the driver is bounded by ``FEW_VALUES`` for each rank.
    """
    x = F.col("x")
    found: dict[int, float] = {}
    # of each rank: rows up to the interval, rows in it, and its ends (None: open)
    state: dict[int, tuple[int, int, float | None, float | None]] = {r: (0, n, None, None) for r in set(ranks)}

    def inside(low: float | None, high: float | None) -> Column:
        above = F.lit(True) if low is None else x > F.lit(low)
        return above & (F.lit(True) if high is None else x < F.lit(high))

    while state:
        few = {r: s for r, s in state.items() if s[1] <= FEW_VALUES}
        if few:
            any_of_them = reduce(lambda a, b: a | b, [inside(*s[2:]) for s in few.values()])
            counted = sorted((v, c) for v, c in data.filter(any_of_them).groupBy("x").count().collect())
            for r, (before, _, low, high) in few.items():
                left = r - before
                for v, c in counted:
                    if (low is None or v > low) and (high is None or v < high):
                        left -= c
                        if left <= 0:
                            found[r] = v
                            break
            state = {r: s for r, s in state.items() if r not in few}
            continue
        band = 4.0 / accuracy
        asked = {r: [min(max((r - before) / size + d, 0.0), 1.0) for d in (-band, band)] for r, (before, size, *_ ) in state.items()}
        said = data.agg(*[F.percentile_approx(F.when(inside(*s[2:]), x), asked[r], accuracy).alias(f"q{r}") for r, s in state.items()]).collect()[0]
        ends = {r: said[f"q{r}"] for r in state}
        counts = data.agg(
            *[
                F.count_if(inside(*state[r][2:]) & c).alias(f"{name}{r}")
                for r, (a, b) in ends.items()
                for name, c in (("below", x < F.lit(a)), ("a", x == F.lit(a)), ("between", (x > F.lit(a)) & (x < F.lit(b))), ("b", x == F.lit(b)))
            ]
        ).collect()[0]
        after = {}
        for r, (a, b) in ends.items():
            before, size, low, high = state[r]
            below, at_a, between = (before + counts[f"below{r}"], counts[f"a{r}"], counts[f"between{r}"])
            if r <= below:
                after[r] = (before, counts[f"below{r}"], low, a)
            elif r <= below + at_a:
                found[r] = a
            elif r <= below + at_a + between:
                after[r] = (below + at_a, between, a, b)
            elif a != b and r <= below + at_a + between + counts[f"b{r}"]:
                found[r] = b
            else:
                seen = below + at_a + between + (counts[f"b{r}"] if a != b else 0)
                after[r] = (seen, before + size - seen, b, high)
        state = after
    return found


def describe_number(df: DataFrame, column: str, *, accuracy: int = 10_000) -> DataFrame:
    """Minimum, exact quartiles, mean, maximum and NULL count of one column, in one row.

    Quartiles are exact, and no task orders a share of the table: see :func:`_value_at`. The column is written once; the
    passes read that. Not a number counts as greater than all numbers.
    """
    data = df.select(as_column(column).cast("double").alias("x"))
    data = cut_lineage(data, "numbers")
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    basics = data.agg(
        F.count("x").alias("n"),
        F.min("x").alias("minimum"),
        F.avg("x").alias("mean"),
        F.max("x").alias("maximum"),
        F.count_if(F.col("x").isNull()).alias("nulls"),
    ).collect()[0]
    n = basics["n"]
    places = {name: q * (n - 1) for name, q in quartiles.items()}
    ranks = [r for p in places.values() for r in (int(p) + 1, min(int(p) + 2, n))] if n else []
    values = _value_at(data.filter("x is not null"), ranks, n, accuracy)
    figures = {c: basics[c] for c in ("minimum", "mean", "maximum", "nulls")}
    for name, p in places.items():
        low, high = (values[int(p) + 1], values[min(int(p) + 2, n)]) if n else (None, None)
        figures[name] = None if low is None else low if low == high else low + (high - low) * (p - int(p))
    kinds = {c: "bigint" if c == "nulls" else "double" for c in figures}
    return df.sparkSession.range(1).select(*[F.lit(figures[c]).cast(kinds[c]).alias(c) for c in (*quartiles, "minimum", "mean", "maximum", "nulls")])


def describe_number_approx(df: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """The same figures in one pass with approximate quartiles."""
    value = as_column(column).cast("double")
    q = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy)
    return df.agg(
        F.min(value).alias("minimum"),
        q[0].alias("q1"),
        q[1].alias("median"),
        F.avg(value).alias("mean"),
        q[2].alias("q3"),
        F.max(value).alias("maximum"),
        F.count_if(value.isNull()).alias("nulls"),
    )


def summarise(df: DataFrame, keys: Mapping[str, ColumnLike], figures: Mapping[str, Column]) -> DataFrame:
    """Group by named key expressions and compute all figures at once."""
    grouped = df.groupBy(*[as_column(v).alias(k) for k, v in keys.items()])
    return grouped.agg(*[c.alias(n) for n, c in figures.items()])
