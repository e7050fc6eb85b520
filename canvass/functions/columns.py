"""Choosing, renaming and combining columns.

Everything here resolves names against ``df.columns`` while the plan is built, so the
result is a single projection that Catalyst can prune and push down.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(f"`{value}`") if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def compute_once(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Add costly columns so that later filters and projections read their results.

    A plain projection is merged with what follows, and a filter on its column is pushed
    below it: both repeat the expression. A generated row is left alone.
    """
    row = F.struct(*[c.alias(n) for n, c in new.items()])
    return df.select("*", F.inline(F.array(row)))


# ---- names -------------------------------------------------------------------------


def snake_name(name: str) -> str:
    """Lower snake case: accents dropped, camel case split, symbols to underscores."""
    text = unicodedata.normalize("NFKD", name)
    text = "".join(ch for ch in text if not unicodedata.combining(ch))
    text = text.replace("%", "_percent_").replace("#", "_number_")
    text = re.sub(r"['\"]", "", text)
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower()
    if not text:
        return "x"
    return f"x{text}" if text[0].isdigit() else text


def snake_names(names: Sequence[str]) -> list[str]:
    """Snake-case every name; a repeated result gets ``_2``, ``_3`` and so on."""
    used: set[str] = set()
    out = []
    for name in names:
        base = candidate = snake_name(name)
        n = 1
        while candidate in used:
            n += 1
            candidate = f"{base}_{n}"
        used.add(candidate)
        out.append(candidate)
    return out


def with_snake_names(df: DataFrame) -> DataFrame:
    return df.toDF(*snake_names(df.columns))


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that exist in ``df``, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def by_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    """Columns starting with any prefix; case does not matter."""
    wanted = tuple(p.lower() for p in prefixes)
    return [c for c in df.columns if c.lower().startswith(wanted)]


def by_regex(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


# ---- projections -------------------------------------------------------------------


def select_mapping(df: DataFrame, mapping: Sequence[tuple[str, str]] | Mapping[str, str]) -> DataFrame:
    """Project ``(output name, source column)`` pairs; a missing source is an error."""
    pairs = list(mapping.items()) if isinstance(mapping, Mapping) else list(mapping)
    missing = [src for _, src in pairs if src not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    return df.select(*[as_column(src).alias(out) for out, src in pairs])


def select_by_prefix(df: DataFrame, *prefixes: str, keep: Sequence[str] = ()) -> DataFrame:
    kept = present(df, keep)
    return df.select(*kept, *[c for c in by_prefix(df, *prefixes) if c not in kept])


def drop_by_prefix(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.drop(*by_prefix(df, *prefixes))


def select_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*present(df, names))


def move_before(df: DataFrame, name: str, before: str) -> DataFrame:
    rest = [c for c in df.columns if c != name]
    at = rest.index(before)
    return df.select(*rest[:at], name, *rest[at:])


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns, for example empty annotation columns of a review sheet."""
    return df.withColumns({n: F.lit(v) for n, v in values.items()})


def across(
    df: DataFrame,
    names: Iterable[str],
    functions: Mapping[str, Callable[[Column], Column]],
    pattern: str = "{fn}_{col}",
) -> DataFrame:
    """Apply named functions to many columns in one projection."""
    new = {
        pattern.format(fn=fn, col=name): build(as_column(name))
        for name in present(df, names)
        for fn, build in functions.items()
    }
    return df.withColumns(new) if new else df


def cast_by_prefix(df: DataFrame, prefixes: Sequence[str], to: str = "double") -> DataFrame:
    """Cast every column with one of the prefixes; what does not parse becomes NULL."""
    names = by_prefix(df, *prefixes)
    return df.withColumns({n: as_column(n).try_cast(to) for n in names}) if names else df


def fill_numeric_nulls(df: DataFrame, names: Iterable[str] | None = None, nan: bool = True) -> DataFrame:
    """NULL (and NaN) to 0 in numeric columns."""
    chosen = set(df.columns if names is None else names)
    new = {}
    for field in df.schema.fields:
        if field.name not in chosen or not isinstance(field.dataType, T.NumericType):
            continue
        value = as_column(field.name)
        if nan and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.nanvl(value, F.lit(0.0).cast(field.dataType))
        new[field.name] = F.coalesce(value, F.lit(0).cast(field.dataType))
    return df.withColumns(new) if new else df


def drop_nested(df: DataFrame) -> DataFrame:
    """Drop array, map and struct columns (geometry) before publishing a flat table."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, nested)])


# ---- row-wise combinations ---------------------------------------------------------


def row_sum(values: Sequence[ColumnLike]) -> Column:
    """Sum across columns with NULL as 0."""
    parts = [F.coalesce(as_column(v), F.lit(0)) for v in values]
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0)


def row_count(conditions: Sequence[Column]) -> Column:
    """Number of conditions that hold; an unknown condition does not count."""
    return row_sum([F.when(c, 1).otherwise(0) for c in conditions])


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def merge_text(values: Sequence[ColumnLike], sep: str = " | ") -> Column:
    """Join texts and skip NULLs."""
    return F.concat_ws(sep, *[as_column(v) for v in values])
