"""Suffix-array dedup: most-significant-digit passes over suffixes, no deeper than the threshold."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.arrays import byte_values
from canvass.llm.repeats import occurrences, removed, shared_windows, single_windows, slices
from canvass.llm.store import documents, keyed, stored


def _bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return byte_values()[data], offsets


def _values(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, offsets


def _cut(text: bytes, runs: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    kept, at = [], 0
    for start, end in runs:
        kept.append(text[at:start])
        at = end
    kept.append(text[at:])
    left = b"".join(kept)
    return len(text), len(text) - len(left), left


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, digit: int = 80, bucket: int = 4096) -> DataFrame:
    """Cut every byte covered by a string of ``length`` bytes that starts anywhere else too.

    Suffixes are dealt out by most-significant-digit passes and only ``length`` bytes deep;
    a bucket of one suffix is left at once, and the buckets of equal strings at the end are
    the repeats. The order of digits is free as long as it is the same for equal strings,
    so the first digit is the least-hashed run of ``digit`` bytes in the string and its
    place: neighbouring suffixes have it in common and travel as one row. The second
    digit is all they cover together; rows with equal second digits are repeats as they
    are. What is left, one row for each second digit of a bucket, is sorted by the whole
    strings: inside a task for buckets of up to ``bucket`` rows, dealt out string by string
    over all tasks for larger ones.

    Returns ``(id_col, n_bytes, n_removed, spans, kept)``: ``spans`` are maximal runs of
    bytes, ``kept`` the rest as binary, since a cut may fall inside a character. A null text
    is empty. Every occurrence goes, the first too, and strings may overlap themselves.
    Rows with equal id and text are told apart by nothing and both count. Strings are
    compared by two 64-bit hashes.
    """
    docs = keyed(docs, id_col, text_col)
    first = occurrences(docs, _bytes, length, digit)
    # Written by itself, so that the join may split a bucket that many documents have.
    full = stored(first.groupBy("anchor").count().where("count > 1").select("anchor"), "digit-1")
    second = stored(first.join(full, "anchor", "left_semi"), "digit-2")

    buckets = stored(second.groupBy("anchor", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("id", "row", "lo", "hi")).alias("one")), "buckets")
    equal = second.join(buckets.where("n > 1").select("anchor", "ctx"), ["anchor", "ctx"], "left_semi")
    equal = equal.select("id", "row", F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))

    several = stored(buckets.groupBy("anchor").agg(F.count("*").alias("digits")).where("digits > 1"), "several")
    left = buckets.join(several, "anchor").select("anchor", "digits", "one.*")
    small = slices(docs, left.where(F.col("digits") <= bucket), _values, length)
    parts = shared_windows(small, byte_values().take, 1, length, earlier=False)

    strings = single_windows(docs, left.where(F.col("digits") > bucket), _bytes, length)
    repeats = strings.groupBy("anchor", "window").count().where("count > 1").select("anchor", "window")
    large = strings.join(repeats, ["anchor", "window"], "left_semi")
    large = large.select("id", "row", "start", (F.col("start") + length).alias("end"))

    out = removed(docs, equal.unionByName(parts).unionByName(large), _cut, "binary")
    return out.withColumnsRenamed({"id": id_col, "n_units": "n_bytes"})


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(documents(spark, sf_dir))
    return out.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
