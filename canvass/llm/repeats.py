"""Anchored windows: what the two searches for repeated passages share.

Tokens are values in one array, ``first`` the index of each document's first token.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm.arrays import BASE_A, BASE_B, Rolling, merge, pieces, ranges, signed, winnow

Tokens = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def occurrences(docs: DataFrame, tokens: Tokens, length: int, gram: int) -> DataFrame:
    """The anchors of all windows of ``length`` tokens: one row for windows side by side with one anchor.

    ``anchor`` is the hash of the anchor's ``gram`` tokens, ``lo`` and ``hi`` the first and
    last window start, ``ctx`` the hash of all tokens that these windows cover. Equal
    windows have equal anchors at the same place.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            values, first = tokens(data, offsets)
            grams = Rolling(values, BASE_A).grams(gram)
            room = first[1:] - first[:-1] >= length
            steps = np.zeros(len(values) + 1, np.int8)
            steps[first[:-1][room]] = 1
            steps[first[1:][room] - length + 1] -= 1
            pos, lo, hi = winnow(grams, length - gram + 1, np.cumsum(steps[:-1], dtype=np.int8) > 0)
            doc = np.searchsorted(first, lo, "right") - 1
            ctx = Rolling(values, BASE_B).spans(lo, hi + length)
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(at),
                    batch.column("row").take(at),
                    pa.array(signed(grams[pos])),
                    pa.array(signed(ctx)),
                    pa.array((lo - first[doc]).astype(np.int32)),
                    pa.array((hi - first[doc]).astype(np.int32)),
                ],
                names=["id", "row", "anchor", "ctx", "lo", "hi"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(rows, f"id {kind}, row long, anchor long, ctx long, lo int, hi int")


def _gathered(runs: DataFrame) -> DataFrame:
    return runs.groupBy("id", "row").agg(F.collect_list(F.struct("anchor", "lo", "hi")).alias("runs"))


def _runs_of(batch: pa.RecordBatch, first: np.ndarray) -> tuple[pa.StructArray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of all documents of a part: themselves, their document, its first token, and where they begin and end."""
    each = batch.column("runs").flatten()
    doc = np.repeat(np.arange(batch.num_rows), batch.column("runs").value_lengths().to_numpy(zero_copy_only=False))
    base = first[doc]
    return each, doc, base, base + each.field("lo").to_numpy(), base + each.field("hi").to_numpy()


def single_windows(docs: DataFrame, runs: DataFrame, tokens: Tokens, length: int) -> DataFrame:
    """Each window of the given ``runs`` by itself: ``(id, row, anchor, window, start)``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            values, first = tokens(data, offsets)
            each, doc, base, lo, hi = _runs_of(batch, first)
            start, owner = ranges(lo, hi)
            at = pa.array(doc[owner])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(at),
                    batch.column("row").take(at),
                    each.field("anchor").take(pa.array(owner)),
                    pa.array(signed(Rolling(values, BASE_B).spans(start, start + length))),
                    pa.array((start - base[owner]).astype(np.int32)),
                ],
                names=["id", "row", "anchor", "window", "start"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return with_lists(docs, _gathered(runs), "inner").mapInArrow(rows, f"id {kind}, row long, anchor long, window long, start int")


def slices(docs: DataFrame, runs: DataFrame, tokens: Tokens, length: int) -> DataFrame:
    """The tokens that each of the given ``runs`` covers, as values: ``(id, row, anchor, lo, slice)``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            values, first = tokens(data, offsets)
            each, doc, base, lo, hi = _runs_of(batch, first)
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(at),
                    batch.column("row").take(at),
                    each.field("anchor"),
                    each.field("lo"),
                    pa.array([values[a : b + length].tobytes() for a, b in zip(lo.tolist(), hi.tolist())], pa.binary()),
                ],
                names=["id", "row", "anchor", "lo", "slice"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return with_lists(docs, _gathered(runs), "inner").mapInArrow(rows, f"id {kind}, row long, anchor long, lo int, slice binary")


def shared_windows(cut: DataFrame, values_of: Callable[[np.ndarray], np.ndarray], width: int, length: int, earlier: bool) -> DataFrame:
    """The spans of ``slices`` made of windows that another slice of the same anchor has too.

    A value takes ``width`` bytes of a slice. With ``earlier`` the other slice must have a
    smaller id. All windows of an anchor are sorted, not paired.
    """

    def spans(batch: pa.RecordBatch, anchor: np.ndarray) -> pa.RecordBatch:
        col = batch.column("slice").cast(pa.large_binary())
        raw = np.frombuffer(col.buffers()[2], np.uint8)
        ends = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        values = values_of(raw[ends[0] : ends[-1]])
        first = (ends - ends[0]) // width
        start, owner = ranges(first[:-1], first[1:] - length)
        window = Rolling(values, BASE_B).spans(start, start + length)
        order = np.lexsort((window, anchor[owner]))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(anchor[owner][order]) != 0) | (window[order][1:] != window[order][:-1])
        group, begin = np.cumsum(new) - 1, np.flatnonzero(new)
        if earlier:
            ids = batch.column("id")
            rank = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="min").to_numpy().astype(np.int64)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            rank[~known] = np.iinfo(np.int64).max
            least = np.minimum.reduceat(rank[owner][order], begin) if len(begin) else begin
            hit = (rank[owner][order] > least[group]) & known[owner][order]
        else:
            hit = np.diff(np.append(begin, len(order)))[group] > 1
        at = np.sort(order[hit])  # in the order of slices and of places in them
        cut_ = np.ones(len(at), bool)
        cut_[1:] = (np.diff(owner[at]) != 0) | (start[at][1:] > start[at][:-1] + length)
        a = np.flatnonzero(cut_)
        b = np.append(a[1:], len(at))[: len(a)] - 1
        which = owner[at[a]]
        lo = batch.column("lo").to_numpy()[which] - first[which]
        take = pa.array(which)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(take),
                batch.column("row").take(take),
                pa.array((lo + start[at[a]]).astype(np.int32)),
                pa.array((lo + start[at[b]] + length).astype(np.int32)),
            ],
            names=["id", "row", "start", "end"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column("anchor").to_numpy()
            done = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on in the next batch
            if held and anchor[0] != held[0].column("anchor")[0].as_py():
                yield from whole(held)
                held = []
            if done:
                yield from whole([*held, batch.slice(0, done)])
                held = []
            held.append(batch.slice(done))
        if held:
            yield from whole(held)

    def whole(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        anchor = batch.column("anchor").to_numpy()
        at = 0
        while at < len(anchor):  # anchors of about so many slices at once
            to = int(np.searchsorted(anchor, anchor[min(at + 2048, len(anchor) - 1)], "right"))
            yield spans(batch.slice(at, to - at), anchor[at:to])
            at = to

    kind = cut.schema["id"].dataType.simpleString()
    dealt = cut.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(rows, f"id {kind}, row long, start int, end int")


def with_lists(docs: DataFrame, lists: DataFrame, how: str, few: bool = False) -> DataFrame:
    """Documents with the list gathered for each; the texts are streamed past the lists, not sorted.

    Where lists are expected to be few, Spark may find that they can be sent to all tasks instead.
    """
    right = lists.withColumnRenamed("id", "list_id").withColumnRenamed("row", "list_row")
    right = right if few else right.hint("shuffle_hash")
    same = docs["id"].eqNullSafe(right["list_id"]) & (docs["row"] == right["list_row"])
    return docs.join(right, same, how).drop("list_id", "list_row")


def removed(docs: DataFrame, spans: DataFrame, cut: Callable[[bytes, list[tuple[int, int]]], tuple[int, int, bytes]], kept: str) -> DataFrame:
    """Cut the half-open ``spans`` out of each document.

    Returns ``(id, n_units, n_removed, spans, kept)``, ``spans`` joined to maximal runs and
    ``kept`` of the type given.
    """
    lists = spans.groupBy("id", "row").agg(F.collect_list(F.struct("start", "end")).alias("cuts"))
    kind = docs.schema["id"].dataType.simpleString()
    out = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            raw, cuts = data.tobytes(), batch.column("cuts")
            each, where = cuts.flatten(), np.concatenate([[0], np.cumsum(cuts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            start, end = each.field("start").to_numpy(), each.field("end").to_numpy()
            made = []
            for i in range(batch.num_rows):
                here = slice(where[i], where[i + 1])
                runs = merge(list(zip(start[here].tolist(), end[here].tolist()))) if where[i] < where[i + 1] else []
                made.append((*cut(raw[offsets[i] : offsets[i + 1]], runs), runs))
            units, gone, left, runs = zip(*made)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(units, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], pa.list_(out)),
                    pa.array(left, pa.binary()).cast(pa.string() if kept == "string" else pa.binary()),
                ],
                names=["id", "n_units", "n_removed", "spans", "kept"],
            )

    schema = f"id {kind}, n_units long, n_removed long, spans array<struct<start:int,end:int>>, kept {kept}"
    return with_lists(docs, lists, "left").mapInArrow(rows, schema)
