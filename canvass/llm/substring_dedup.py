"""Substring dedup by seed and extend over winnowed anchors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.arrays import word_hashes, words
from canvass.llm.repeats import occurrences, removed, single_windows
from canvass.llm.store import documents, drop_stored, keyed, stored


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(data, offsets)
    return word_hashes(data, starts, ends), first


def _cut(text: bytes, runs: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    all_words = text.split()
    kept, at = [], 0
    for start, end in runs:
        kept += all_words[at:start]
        at = end
    kept += all_words[at:]
    return len(all_words), len(all_words) - len(kept), b" ".join(kept)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, seed: int = 10) -> DataFrame:
    """Cut every passage of ``length`` words or more that a document with a smaller id has too.

    Seeds are the winnowed anchors (``seed`` words) of all windows of ``length`` words; any
    two equal windows share one. A seed is extended to both sides as far as windows reach
    that it anchors (``ctx``). Occurrences with an equal extension form a class, in which
    all but the smallest id are covered at once; only one occurrence a class is compared
    with the other classes of its seed, window by window. So a passage of a million copies
    costs a row for each copy and never a pair of copies.

    Words are separated by ASCII white space. Returns ``(id_col, n_words, n_removed, spans,
    kept)``: ``spans`` are the maximal covered runs in words, ``kept`` the words left, joined
    by one space. A null text has no words. A null id is neither smaller nor larger than
    another: such a document loses nothing and takes nothing. Rows with the same id don't
    remove one another. Words and windows are compared by 64-bit hashes, windows by two.
    """
    docs = keyed(docs, id_col, text_col)
    seeds = stored(occurrences(docs, _words, length, seed), "seeds")
    shared = seeds.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("anchor")
    shared = stored(shared, "shared")  # by itself, so that the join may split an anchor that many documents have
    seeds_shared = stored(seeds.join(shared, "anchor", "left_semi"), "seeds-shared")
    drop_stored(seeds)

    classes = seeds_shared.groupBy("anchor", "ctx").agg(F.min("id").alias("smallest"))
    placed = seeds_shared.join(classes, ["anchor", "ctx"])
    whole = placed.where("id > smallest").select("id", "row", F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))

    several = stored(classes.groupBy("anchor").count().where("count > 1").select("anchor"), "several")
    leaders = placed.where("id = smallest").join(several, "anchor", "left_semi")
    windows = stored(single_windows(docs, leaders, _words, length), "windows")
    earliest = windows.groupBy("anchor", "window").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").drop("b")
    parts = windows.join(earliest, ["anchor", "window"]).where("id > a")
    parts = parts.select("id", "row", "start", (F.col("start") + length).alias("end"))

    out = removed(docs, whole.unionByName(parts), _cut, "string")
    return out.withColumnsRenamed({"id": id_col, "n_units": "n_words"})


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("spans").alias("n_spans"))
