"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.session import cut_lineage


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared folder and go on from the written copy."""
    return cut_lineage(df, name)


def stored_lean(df: DataFrame, name: str) -> DataFrame:
    """``stored``, and the shuffle files of its making are removed as soon as the table stands.

    Spark keeps them until the driver happens to collect its garbage. The session's setting is as it was afterwards.
    """
    name_, conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", df.sparkSession.conf
    before = conf.get(name_, "false")
    conf.set(name_, "true")
    try:
        return cut_lineage(df, name)
    finally:
        conf.set(name_, before)


def drop_stored(df: DataFrame) -> None:
    """Remove the files of a table made by ``stored``; call it when nothing reads it any more. For classic sessions."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent() if df.inputFiles() else None
    if folder is not None:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small_batches(docs: DataFrame, rows: int = 1000) -> DataFrame:
    """The documents as they are; batches to and from Python get no more than ``rows`` of them.

    Spark's default of 10,000 rows is meant for numbers; of texts it makes tens of megabytes
    for every task and copy. The session keeps the lower number, since plans are run later than they are made.
    """
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", docs.sparkSession.conf
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, str(rows))
    return docs


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, row, text)`` of the documents and no other column.

    ``row`` tells apart rows that share an id: it is a hash of the text, so that it comes
    out the same however often and wherever the plan is run.
    """
    return small_batches(docs).select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("row"), F.col(text_col).alias("text")
    )


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
