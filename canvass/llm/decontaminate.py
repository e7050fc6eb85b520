"""Benchmark decontamination with a generalised suffix automaton."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.arrays import ALNUM, BASE_A, LOWER, Rolling, merge, mix, pieces, ranges, word_hashes, words
from canvass.llm.automaton import SuffixAutomaton
from canvass.llm.store import documents, keyed

_BLANKED = np.where(ALNUM, LOWER, 32).astype(np.uint8)
_TABLE = _BLANKED.tobytes()


def normalised(text: bytes) -> list[bytes]:
    """Lower-cased words of letters and digits; everything beyond ASCII belongs to words."""
    return text.translate(_TABLE).split()


class _Matcher:
    """The automaton of one share of the items, with a filter before it.

    A word can only be hit inside a run of words that follow one another in some item too;
    shorter runs than the shortest window are passed over.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        split = [(k, w) for k, text in items if (w := normalised(text))]
        self.ids, self.window = [k for k, _ in split], window
        self.automaton = SuffixAutomaton([w for _, w in split], window)
        self.least = min((min(len(w), window) for _, w in split), default=0)
        pairs, singles = [], []
        for _, item in split:
            joined = np.frombuffer(b" ".join(item), np.uint8)
            h = word_hashes(joined, *words(joined, np.array([0, len(joined)]), ALNUM)[:2])
            pairs.append(self._pairs(h))
            singles.append(h)
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.uint64), *(pairs if self.least > 1 else singles)]))
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.pairs >> np.uint64(44)] = True

    @staticmethod
    def _pairs(h: np.ndarray) -> np.ndarray:
        return mix(h[:-1] * np.uint64(3) + h[1:])

    def stretches(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Half-open runs of words that may hold a window."""
        width = 2 if self.least > 1 else 1
        if len(h) < width or not len(self.pairs):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key = self._pairs(h) if width == 2 else h
        known = np.zeros(len(h) + 1, bool)
        maybe = np.flatnonzero(self.bits[key >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.pairs, key[maybe]), len(self.pairs) - 1)
        known[maybe[self.pairs[at] == key[maybe]]] = True
        if width == 2:
            known[first[1:][first[1:] > 0] - 1] = False  # a pair does not go on in the next document
            edge = np.diff(known.astype(np.int8), prepend=0)
            start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        else:
            inner = np.zeros(len(h) + 1, bool)
            inner[first[:-1]] = True
            start = np.flatnonzero(known & ~(np.append(False, known[:-1]) & ~inner))
            end = np.flatnonzero(known[:-1] & ~(known[1:] & ~inner[1:])) + 1
        long = end - start >= self.least
        return start[long], end[long]

    def hits(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        spans, items, ends = [], set(), self.automaton.ends
        for i, state, size in self.automaton.matches(found):
            # The longest match may be shorter than the state's longest run, so look at lengths.
            for length, own in ends[state]:
                if length <= size:
                    spans.append((i + 1 - length, i + 1))
                    items.update(own)
        return spans, items


def benchmark_hits(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int, share_words: int) -> DataFrame:
    """``(id, row, text, n_words, spans, items)``: the words of each document inside windows of the items."""
    spark = docs.sparkSession
    items = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    n_words = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = max(1, math.ceil(n_words / 4 / share_words))
    out = keyed(docs, id_col, text_col)
    kind = out.schema["id"].dataType.simpleString()
    out = out.select("*", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    for share in range(shares):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(shares)) == share).collect()
        sent = spark.sparkContext.broadcast([(r["item"], r["text"].encode()) for r in own])

        def rows(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = None
            for batch, data, offsets in pieces(batches):
                matcher = matcher or _Matcher(sent.value, window)
                low = LOWER[data]
                starts, ends, first = words(low, offsets, ALNUM)
                spans, found = batch.column("spans").to_pylist(), [set(x) for x in batch.column("items").to_pylist()]
                raw = _BLANKED[data].tobytes()
                for a, b in zip(*matcher.stretches(word_hashes(low, starts, ends), first)):
                    doc = int(np.searchsorted(first, a, "right")) - 1
                    hit, own = matcher.hits(raw[starts[a] : ends[b - 1]].split())
                    at = int(a - first[doc])
                    spans[doc] += [{"start": x + at, "end": y + at} for x, y in merge(hit)]
                    found[doc].update(matcher.ids[k] for k in own if matcher.ids[k] is not None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("row"),
                        batch.column("text"),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array([[{"start": x, "end": y} for x, y in merge([(s["start"], s["end"]) for s in own])] for own in spans], pa.list_(span)),
                        pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                    ],
                    names=["id", "row", "text", "n_words", "spans", "items"],
                )

        text = out.schema["text"].dataType.simpleString()
        out = out.mapInArrow(rows, f"id {kind}, row long, text {text}, n_words long, spans array<struct<start:int,end:int>>, items array<string>")
    return out


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    share_words: int = 1_000_000,
) -> DataFrame:
    """What of each document stands in the items of a benchmark.

    A window is ``window`` words of an item that follow one another, or the whole of a
    shorter item. Words are runs of ASCII letters, digits and everything beyond ASCII, with
    A-Z in lower case. Documents are streamed through an automaton of all items; after each
    word it knows the longest run of words up to there that an item has.

    Returns ``(id_col, text, n_words, n_hit, spans, items)``, one row for each input row:
    ``spans`` are the maximal hit runs in words, ``items`` the ids of items with a window
    here, as sorted strings. A null or empty text has no words; an item without words is
    passed over; items of one id count as one, an item without id hits but is not listed.
    The items are sent to the executors in shares of about ``share_words`` words, each
    followed in the same task by the next, so that no broadcast grows with the benchmark.
    """
    out = benchmark_hits(docs, items, id_col, text_col, item_col, item_text_col, window, share_words)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(F.col("id").alias(id_col), "row", "text", "n_words", n_hit.alias("n_hit"), "spans", "items")


def _cut_words(text: str, spans: list) -> str:
    """The text without the words of ``spans``: from the start of a run's first word to the end of its last."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]), ALNUM)
    out, at = [], 0
    for span in spans:
        out.append(raw[at : starts[span["start"]]].rstrip(b" "))
        at = ends[span["end"] - 1]
    return b"".join([*out, raw[at:]]).decode().strip()


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_coverage: float = 0.5, **options) -> DataFrame:
    """Cut benchmark passages out of the documents, and leave out documents that are mostly such.

    A document goes if more than ``max_coverage`` of its words are hit, or nothing is left of it. All other
    columns come back as they were; ``n_chars``, where there is one, counts the new text.
    """
    extra = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*[F.col(c) for c in extra]).alias("id"), F.col(text_col).alias("text"))
    found = contamination(packed, items, "id", "text", **options)
    cut = F.pandas_udf(lambda t, s: t.combine(s, lambda a, b: a if a is None or not len(b) else _cut_words(a, b)), "string")
    kept = found.where((F.col("n_hit") == 0) | (F.col("n_hit") <= max_coverage * F.col("n_words")))
    kept = kept.withColumn("text", F.when(F.size("spans") > 0, cut("text", "spans")).otherwise(F.col("text")))
    kept = kept.where("n_hit = 0 or length(text) > 0")
    columns = [F.col("text").alias(c) if c == text_col else F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"id.{c}") for c in docs.columns]
    return kept.select(*columns)


def op6_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
