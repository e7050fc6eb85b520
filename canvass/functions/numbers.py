"""Numeric helpers as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from canvass.functions.columns import ColumnLike, as_column
from canvass.functions.text import trim_all

# Fixed values: "does not apply", "does not know", "does not answer".
SENTINELS = (-1, 98, 99)


def number(value: ColumnLike) -> Column:
    """Double, NULL where the text is not a number."""
    return as_column(value).try_cast("double")


def without_sentinels(value: ColumnLike, sentinels: Sequence[float] = SENTINELS) -> Column:
    """The number, NULL for a sentinel code."""
    parsed = number(value)
    return F.when(~parsed.isin(*[float(s) for s in sentinels]), parsed)


def is_sentinel_text(
    value: ColumnLike, sentinels: Sequence[int] = SENTINELS, trim: bool = True
) -> Column:
    """Whether the answer, read as text, is a sentinel code; false for NULL."""
    text = as_column(value).cast("string")
    codes = [str(s) for s in sentinels]
    hit = text.isin(*codes)
    if trim:
        # only a text longer than a code can be a padded one
        padded = F.length(text) > min(len(c) for c in codes)
        hit = hit | (padded & trim_all(text).isin(*codes))
    return F.coalesce(hit, F.lit(False))


def percent(
    part: ColumnLike, whole: ColumnLike, digits: int = 1, *, half_even: bool = False
) -> Column:
    """Rounded percentage; NULL for an empty whole.

    Halves are rounded up, or to the even digit with ``half_even``.
    """
    ratio = F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double"))
    return (F.bround if half_even else F.round)(ratio * 100, digits)


def at_least(value: ColumnLike, floor: float) -> Column:
    """The larger of value and floor; NULL counts as missing, not as the result."""
    return F.greatest(as_column(value), F.lit(floor))


def minutes(seconds: ColumnLike) -> Column:
    return number(seconds) / 60


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def flag_or_null(condition: Column) -> Column:
    """1 or 0, NULL where the condition is unknown."""
    return condition.cast("int")


def number_text_value(value: ColumnLike) -> Column:
    """A value as text the way it was given; doubles without a trailing ``.0``."""
    text = F.coalesce(as_column(value).cast("string"), F.lit("NA"))
    return F.regexp_replace(text, r"\.0$", "")
