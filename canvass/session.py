"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on; sizes stay with the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cpus: int = 8, partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("canvass")
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions or cpus))
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", memory)
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _folder_of_this_machine() -> str:
    return tempfile.mkdtemp(prefix="canvass-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _folder_of_this_machine()


def cut_lineage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a table once and go on from the written copy.

    Reports read few of its many columns, which a written parquet table supports, and a
    lost executor costs a re-read instead of a re-computation.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
