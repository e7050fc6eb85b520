"""Publishing result tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from canvass.functions.columns import as_column, drop_nested

log = logging.getLogger(__name__)


class PublishError(RuntimeError):
    """A table could not be written; the message names it."""


def publish(
    df: DataFrame,
    target: str | Sequence[str],
    *,
    label: str,
    fmt: str = "parquet",
    as_table: bool = False,
    flat: bool = True,
    order_by: Sequence = (),
) -> None:
    """Overwrite a report at one or several targets.

    Nested columns are dropped first. Further targets are copied from the first one, so the
    plan runs once. A target must not be one of the plan's own inputs.
    """
    targets = [target] if isinstance(target, str) else list(target)
    table = drop_nested(df) if flat else df
    if order_by:
        table = table.orderBy(*order_by)
    try:
        for i, place in enumerate(targets):
            if i == 1:
                spark = df.sparkSession
                first = spark.table(targets[0]) if as_table else spark.read.format(fmt).load(targets[0])
                table = first
            writer = table.write.mode("overwrite").format(fmt)
            writer.saveAsTable(place) if as_table else writer.save(place)
            log.info("%s published to %s", label, place)
    except Exception as error:
        raise PublishError(f"{label}: {error}") from error


def ordering(names: Sequence[str]) -> list[Column]:
    """Sort columns from names, "-" for descending; NULL comes last either way."""
    return [
        as_column(n[1:]).desc_nulls_last() if n.startswith("-") else as_column(n).asc_nulls_last() for n in names
    ]


def publish_all(
    tables: Mapping[str, DataFrame],
    root: str,
    *,
    fmt: str = "parquet",
    also: Mapping[str, str] | None = None,
    orders: Mapping[str, Sequence[str]] | None = None,
) -> list[str]:
    """Publish a set of named tables below ``root``; ``also`` adds a second place for some.

    ``orders`` names the columns a table is sorted by, "-" before a descending one.
    """
    for name, df in tables.items():
        places = [f"{root}/{name}"] + ([also[name]] if also and name in also else [])
        publish(df, places, label=name, fmt=fmt, order_by=ordering((orders or {}).get(name, ())))
    return list(tables)


MANIFEST = "run int, name string, path string, format string, rows long"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """What has been published below ``root`` as a set: a row for each table of each run."""
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def publish_set(
    tables: Mapping[str, DataFrame],
    root: str,
    *,
    fmt: str = "parquet",
    orders: Mapping[str, Sequence[str]] | None = None,
) -> list[str]:
    """Publish a set of named tables that become visible together, or not at all.

    Every table is first written below ``runs``, read again and counted against what was written. Only when
    all of them stand, one file of the manifest names them, and :func:`read_set` goes by the last run of the manifest. So a
    table that fails leaves the set before it in place; what the failed run has written is never read. Of two
    runs that publish at the same time, one fails.
    """
    if not tables:
        return []
    spark = next(iter(tables.values())).sparkSession
    run = (manifest(spark, root).agg(F.max("run")).first()[0] or 0) + 1
    folder = f"runs/{run:06d}-{uuid.uuid4().hex[:8]}"
    rows = []
    for name, df in tables.items():
        place, written = f"{folder}/{name}", Observation()
        flat = drop_nested(df)
        order = ordering((orders or {}).get(name, ()))
        # Counted after the sort: finding its ranges reads what is below twice.
        table = (flat.orderBy(*order) if order else flat).observe(written, F.count(F.lit(1)).alias("rows"))
        publish(table, f"{root}/{place}", label=name, fmt=fmt)
        try:
            staged = spark.read.format(fmt).load(f"{root}/{place}") if fmt != "parquet" else spark.read.schema(flat.schema).parquet(f"{root}/{place}")
            found = staged.count()
        except Exception as error:
            raise PublishError(f"{name}: {error}") from error
        if found != written.get["rows"]:
            raise PublishError(f"{name}: {written.get['rows']} rows written, {found} found")
        rows.append((run, name, place, fmt, found))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{root}/manifest/{run:06d}")
    log.info("run %d published to %s", run, root)
    return list(tables)


def read_set(spark: SparkSession, root: str, name: str, run: int | None = None) -> DataFrame:
    """A table of the last set published below ``root``, or of another run."""
    rows = manifest(spark, root).filter(F.col("name") == name)
    row = (rows if run is None else rows.filter(F.col("run") == run)).orderBy(F.desc("run")).first()
    last = manifest(spark, root).agg(F.max("run")).first()[0]
    if row is None or (run is None and row["run"] != last):
        raise PublishError(f"{name}: not in the published set")
    return spark.read.format(row["format"]).load(f"{root}/{row['path']}")


def write_dated_csv(df: DataFrame, root: str, run_date: date, *, label: str = "clean table") -> str:
    """CSV files under ``run_date=…`` with NULL written as nothing."""
    path = f"{root}/run_date={run_date.isoformat()}"
    writer = (
        drop_nested(df)
        .write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
    )
    try:
        writer.csv(path)
    except Exception as error:
        raise PublishError(f"{label}: {error}") from error
    return path
