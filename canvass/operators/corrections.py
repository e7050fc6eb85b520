"""Manual corrections: key lists, keyed overrides and correction dictionaries.

A correction source is a list of rows or a DataFrame. A list lives in the driver, so its
size is known and it is broadcast while short; for a DataFrame the choice is left to Spark,
which knows the size of the files or, at run time, of the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.columns import ColumnLike, as_column
from canvass.operators.grouping import literal_table
from canvass.operators.visits import keep_first

Keys = Sequence[str | int] | DataFrame


def _nothing(rows: Sequence | DataFrame) -> bool:
    return not isinstance(rows, DataFrame) and len(rows) == 0


def _key_table(df: DataFrame, key: str, keys: Keys) -> DataFrame:
    if isinstance(keys, DataFrame):
        return keys.select(F.col(keys.columns[0]).alias("__key")).distinct()
    kind = df.schema[key].dataType.simpleString()
    return literal_table(df.sparkSession, [(k,) for k in dict.fromkeys(keys)], f"__key {kind}")


def _dictionary(df: DataFrame, rows: Sequence[tuple] | DataFrame, names: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    if isinstance(rows, DataFrame):
        return rows.toDF(*names)
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    return literal_table(df.sparkSession, rows, schema)


def drop_keys(df: DataFrame, key: str, keys: Keys) -> DataFrame:
    """Blacklist: rows whose key is listed go; rows without a key stay."""
    if _nothing(keys):
        return df
    table = _key_table(df, key, keys)
    return df.join(table, as_column(key) == F.col("__key"), "left_anti")


def only_keys(df: DataFrame, key: str, keys: Keys) -> DataFrame:
    """Whitelist: rows whose key is listed."""
    table = _key_table(df, key, keys)
    return df.join(table, as_column(key) == F.col("__key"), "left_semi")


def override_for_keys(df: DataFrame, key: str, keys: Keys, values: Mapping[str, ColumnLike | object]) -> DataFrame:
    """Give listed rows fixed values in some columns; other rows keep theirs."""
    if _nothing(keys):
        return df
    table = _key_table(df, key, keys).withColumn("__hit", F.lit(True))
    joined = df.join(table, as_column(key) == F.col("__key"), "left")
    new = {
        name: F.when(
            F.col("__hit"), value if isinstance(value, Column) else F.lit(value)
        ).otherwise(as_column(name))
        for name, value in values.items()
    }
    return joined.withColumns(new).drop("__key", "__hit")


def correct_by_key(
    df: DataFrame,
    key: str,
    corrections: Sequence[tuple] | DataFrame,
    targets: Sequence[str],
    *,
    dedupe: bool = False,
) -> DataFrame:
    """Replace the target columns by the dictionary's value where it has one.

    ``corrections`` holds ``(key, new value)``. A repeated key repeats the row, as in any
    join; ``dedupe`` keeps the smallest value per key instead.
    """
    if _nothing(corrections):
        return df.withColumns({t: as_column(t).cast("string") for t in targets})
    kinds = [df.schema[key].dataType.simpleString(), "string"]
    table = _dictionary(df, corrections, ["__key", "__new"], kinds)
    if dedupe:
        table = table.groupBy("__key").agg(F.min("__new").alias("__new"))
    joined = df.join(table, as_column(key) == F.col("__key"), "left")
    new = {t: F.coalesce(F.col("__new"), as_column(t).cast("string")) for t in targets}
    return joined.withColumns(new).drop("__key", "__new")


def correct_status(
    df: DataFrame,
    key: str,
    corrections: Sequence[tuple] | DataFrame,
    labels: Mapping[int, str],
    *,
    code: str,
    label_columns: Sequence[str],
) -> DataFrame:
    """Two-step correction: key to new code, code to label.

    The code column gets the new code, the label columns its label; rows whose key is not
    listed, and labels of codes without one, stay as they are.
    """
    if _nothing(corrections):
        return df.withColumns({c: as_column(c).cast("string") for c in (code, *label_columns)})
    kinds = [df.schema[key].dataType.simpleString(), "int"]
    table = _dictionary(df, corrections, ["__key", "__code"], kinds)
    names = literal_table(df.sparkSession, list(labels.items()), "__id int, __label string")
    joined = df.join(table, as_column(key) == F.col("__key"), "left").join(
        names, F.col("__code") == F.col("__id"), "left"
    )
    new = {code: F.coalesce(F.col("__code").cast("string"), as_column(code).cast("string"))}
    for name in label_columns:
        new[name] = F.coalesce(F.col("__label"), as_column(name).cast("string"))
    return joined.withColumns(new).drop("__key", "__code", "__id", "__label")


def left_lookup(
    df: DataFrame,
    table: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    *,
    null_safe: bool = False,
    dedupe: bool = False,
) -> DataFrame:
    """Left join with a dimension; ``on`` maps our key columns to the dimension's.

    The dimension's keys are dropped. ``null_safe`` lets NULL keys meet. A repeated key
    repeats our row; ``dedupe`` keeps the dimension's first row per key, in the order of its
    other columns.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    theirs = list(pairs.values())
    rest = [as_column(c).asc_nulls_last() for c in table.columns if c not in theirs]
    right = keep_first(table, theirs, rest or [F.lit(1)]) if dedupe else table
    right = right.withColumnsRenamed({r: f"__k_{r}" for r in pairs.values()})
    condition = F.lit(True)
    for mine, other in pairs.items():
        a, b = df[f"`{mine}`"], right[f"`__k_{other}`"]
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return df.join(right, condition, "left").drop(*[f"__k_{r}" for r in pairs.values()])


def upsert(
    base: DataFrame,
    updates: DataFrame,
    on: str,
    mapping: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Refresh base columns from updates where these have a value.

    ``mapping`` is ``{base column: (update column, type)}``. The key is compared as text.
    The result has exactly the columns of ``base``, in their order.
    """
    new = updates.select(
        as_column(on).cast("string").alias("__on"),
        *[as_column(src).alias(f"__u_{src}") for src, _ in mapping.values()],
    )
    joined = base.join(new, as_column(on).cast("string") == F.col("__on"), "left")
    columns = []
    for name in base.columns:
        if name in mapping:
            src, kind = mapping[name]
            fresh = F.col(f"`__u_{src}`").try_cast(kind)
            columns.append(F.coalesce(fresh, as_column(name).try_cast(kind)).alias(name))
        elif name == on:
            columns.append(as_column(name).cast("string").alias(name))
        else:
            columns.append(as_column(name))
    return joined.select(*columns)
