"""Duplicate identities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import ColumnLike, as_column
from canvass.functions.rules import first_match
from canvass.functions.text import fold_capitals, paste, squish
from canvass.operators.corrections import Keys, override_for_keys
from canvass.operators.grouping import HOT_ROWS, attach_groups


def identity(rules: Sequence[tuple[Column, Sequence[ColumnLike]]], sep: str = "_") -> Column:
    """Composite identity: the first rule that holds says which columns are pasted.

    The text is upper-cased, folded and squished, so that spelling variants meet. A missing
    part is written ``NA`` and identities made of missing parts do meet.
    """
    raw = first_match([(condition, paste(*parts, sep=sep)) for condition, parts in rules])
    return squish(fold_capitals(raw))


def flag_duplicates(
    df: DataFrame, identity_column: str, key: str, *, out: str = "duplicate", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """1 where another row has the same non-empty identity.

    Rows without an identity count as one group: NULL if there are several, 0 if one.
    Only identities seen more than once take part in the join.
    """
    joined = attach_groups(
        df, [identity_column], {}, spread_by=[key], keep=F.col("__rows") > 1, rows_as="__n",
        hot_rows=hot_rows,
    )
    repeated = F.col("__n").isNotNull()
    unknown = repeated & as_column(identity_column).isNull()
    found = repeated & (as_column(identity_column) != "")
    return joined.withColumn(
        out, F.when(unknown, None).when(found, 1).otherwise(0).cast("int")
    ).drop("__n")


def duplicate_review(df: DataFrame, flag_column: str, columns: Sequence[str]) -> DataFrame:
    """Flagged rows with the columns a reviewer needs."""
    return df.filter(as_column(flag_column) == 1).select(flag_column, *columns)


def lift_duplicates(df: DataFrame, key: str, keys: Keys, flags: Sequence[str]) -> DataFrame:
    """Set the flags of manually accepted rows to 0."""
    return override_for_keys(df, key, keys, {f: 0 for f in flags})
