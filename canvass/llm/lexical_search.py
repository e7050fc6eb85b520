"""Ranked lexical search: posting lists in blocks of similar documents, skipped by exact bounds."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from canvass.llm.arrays import ALNUM, LOWER, pieces, word_hashes, words
from canvass.llm.store import documents, keyed, stored

SEGMENT_DOCS = 1024  # documents of one segment of the index
SEGMENT_CELLS = 1 << 23  # and documents times different terms of one
BLOCK_DOCS = 32  # documents of a block, on average

UPPER_CASE, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass
class Queries:
    """A number of items with the weights of their terms; terms are numbered from the heaviest, so mostly rarest, on."""

    terms: list[np.ndarray]  # of each item, ascending
    weights: list[np.ndarray]  # of these terms, times their occurrences in the item

    @cached_property
    def size(self) -> int:
        return 1 + max((int(t[-1]) for t in self.terms if len(t)), default=-1)

    @cached_property
    def matrix(self) -> np.ndarray:
        """Weight of each term in each item."""
        found = np.zeros((self.size, len(self.terms)))
        for q, (term, weight) in enumerate(zip(self.terms, self.weights)):
            found[term, q] = weight
        return found

    @cached_property
    def asking(self) -> list[np.ndarray]:
        """The items that have each term."""
        return [np.flatnonzero(row) for row in self.matrix]

    @cached_property
    def beside(self) -> list[np.ndarray]:
        """For each term: itself and the lighter terms of the items that have it.

        A document is found in the posting list of the heaviest term that it shares with an item. It has none of the
        item's heavier terms, so that the summaries of that list need not tell about them.
        """
        return [t + np.flatnonzero(self.matrix[t:, q].any(1)) for t, q in enumerate(self.asking)]


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(item, row, terms)``, rows equal in both once."""
    terms = F.array_remove(F.split(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER_CASE, LOWER_CASE), BREAK), "")
    return items.select(F.col(item_col).alias("item"), F.xxhash64(text_col).alias("row"), terms.alias("terms")).dropDuplicates(["item", "row"])


def term_vectors(texts: DataFrame, hashes: np.ndarray) -> DataFrame:
    """``(id, row, n, terms, tf)`` of every document with a term: how many it has, and which of the asked-for ones how often."""
    order = np.argsort(hashes)
    sent = texts.sparkSession.sparkContext.broadcast((hashes[order], order.astype(np.int32)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = sent.value
        for batch, data, offsets in pieces(batches):
            low = LOWER[data]
            starts, ends, first = words(low, offsets, ALNUM)
            n = np.diff(first)
            h = word_hashes(low, starts, ends)
            at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
            hit = np.flatnonzero(known[at] == h) if len(known) else np.zeros(0, np.int64)
            doc = np.searchsorted(first, hit, "right") - 1
            both, tf = np.unique(doc << 32 | number[at[hit]], return_counts=True)
            some = np.flatnonzero(n > 0)
            to = np.append(0, np.cumsum(np.bincount(both >> 32, minlength=len(n))[some])).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(to), pa.array(x.astype(np.int32))) for x in (both & 0xFFFFFFFF, tf)]
            take = pa.array(some)
            columns = [batch.column("id").take(take), batch.column("row").take(take), pa.array(n[some].astype(np.int64)), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "n", "terms", "tf"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"id {kind}, row long, n long, terms array<int>, tf array<int>")


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's weight is multiplied by in a document."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Segment:
    """Up to ``SEGMENT_DOCS`` documents with a posting list for each term, cut into blocks of similar documents."""

    def __init__(self, begin: np.ndarray, terms: np.ndarray, impact: np.ndarray) -> None:
        self.columns, at = np.unique(terms, return_inverse=True)
        self.n_docs = len(begin) - 1
        self.cells = np.zeros((self.n_docs, len(self.columns)), np.float32)  # whole numbers below 2^20: exact
        self.cells[np.repeat(np.arange(self.n_docs), np.diff(begin)), at] = impact

    def coordinates(self, queries: Queries, column: int) -> np.ndarray:
        """The columns that the summaries of a posting list tell about."""
        beside = queries.beside[self.columns[column]]
        at = np.minimum(np.searchsorted(self.columns, beside), len(self.columns) - 1)
        return at[self.columns[at] == beside]

    def blocks(self, queries: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """How many blocks each posting list has and each block's size; the members of all, and their summaries."""
        counts, sizes, members, summaries = [], [], [], []
        for column in range(len(self.columns)):
            docs = np.flatnonzero(self.cells[:, column])
            here = self.cells[np.ix_(docs, self.coordinates(queries, column))]
            k = -(-len(docs) // BLOCK_DOCS)
            begin = np.zeros(1, np.int64)
            if k > 1:  # documents go to the nearest of k of them by angle
                centre = here[np.arange(k) * len(docs) // k]
                centre = centre / np.linalg.norm(centre, axis=1)[:, None]
                near = (here @ centre.T).argmax(1)
                order = np.argsort(near, kind="stable")
                docs, here = docs[order], here[order]
                begin = np.flatnonzero(np.append(True, np.diff(near[order]) > 0))
            counts.append(len(begin))
            sizes.append(np.diff(np.append(begin, len(docs))))
            members.append(docs)
            summaries.append(np.maximum.reduceat(here, begin, axis=0).ravel())
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        return np.array(counts, np.int32), join(sizes, np.int32), join(members, np.int16), join(summaries, np.int32)

    def bounds(self, queries: Queries, stored_blocks: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each posting list: its items, its members, the block of each, and every block's bound for every item.

        A bound is the item's score of the summary. It holds for all documents that have no heavier term of the item.
        """
        counts, sizes, members, summaries = stored_blocks
        block, member, cell = 0, 0, 0
        for column, k in enumerate(counts.tolist()):
            own = sizes[block : block + k]
            n = int(own.sum())
            at = self.coordinates(queries, column)
            summary = summaries[cell : cell + k * len(at)].reshape(k, len(at))
            asking = queries.asking[self.columns[column]]
            bound = summary.astype(np.float64) @ queries.matrix[np.ix_(self.columns[at], asking)]
            yield asking, members[member : member + n].astype(np.int64), np.repeat(np.arange(k), own), bound
            block, member, cell = block + k, member + n, cell + k * len(at)

    def scores(self, queries: Queries, q: int, docs: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.columns, queries.terms[q]), max(len(self.columns) - 1, 0))
        here = self.columns[at] == queries.terms[q]
        return self.cells[np.ix_(docs, at[here])].astype(np.int64) @ queries.weights[q][here]


SLACK = 1 + 1e-9  # bounds are rounded once they pass 2^53; whole numbers below are exact


def best_blocks(segment: Segment, queries: Queries, blocks: tuple[np.ndarray, ...]) -> Iterator[tuple[int, np.ndarray]]:
    """For each item the exact scores of the block with the highest bound."""
    top = np.zeros(len(queries.terms))
    found: dict[int, np.ndarray] = {}
    for asking, members, block, bound in segment.bounds(queries, blocks):
        high = bound.max(0)
        for i in np.flatnonzero(high > top[asking]):
            found[int(asking[i])] = members[block == bound[:, i].argmax()]
        top[asking] = np.maximum(top[asking], high)
    for q, docs in found.items():
        yield q, segment.scores(queries, q, docs)


def candidates(segment: Segment, queries: Queries, blocks: tuple[np.ndarray, ...], least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(item, documents, scores)`` of all blocks whose bound reaches the ``least`` score of an item."""
    wanted = np.zeros((len(queries.terms), segment.n_docs), bool)
    for asking, members, block, bound in segment.bounds(queries, blocks):
        pass_ = (bound > 0) & (bound * SLACK >= least[asking])
        some = np.flatnonzero(pass_.any(0))
        if len(some):
            wanted[np.ix_(asking[some], members)] |= pass_[:, some].T[:, block]
    for q in np.flatnonzero(wanted.any(1)).tolist():
        docs = np.flatnonzero(wanted[q])
        yield q, docs, segment.scores(queries, q, docs)


INDEX = "ids array<{kind}>, rows array<long>, begin binary, terms binary, impact binary, counts binary, sizes binary, members binary, summaries binary"


def build_index(vectors: DataFrame, queries: object, order: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """Segments of the index, one row each. Documents stay where they are; a segment is made inside a task.

    ``order`` gives the number of each term of ``vectors`` by weight, or -1 for a term that weighs nothing.
    """
    kind = vectors.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        keys: list[np.ndarray] = []
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        names = [x.split()[0] for x in INDEX.split(", ")]

        def segment() -> pa.RecordBatch:
            sizes, terms, impact = (np.concatenate(x) for x in zip(*held))
            begin = np.append(0, np.cumsum(sizes)).astype(np.int32)
            blocks = Segment(begin, terms, impact).blocks(queries.value)
            all_ids = pa.concat_arrays(ids)
            one = lambda x: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
            lists = [pa.ListArray.from_arrays(pa.array([0, len(all_ids)], pa.int32()), x) for x in (all_ids, pa.array(np.concatenate(keys)))]
            out = pa.RecordBatch.from_arrays([*lists, one(begin), one(terms), one(impact), *map(one, blocks)], names=names)
            ids.clear(), keys.clear(), held.clear()
            return out

        docs, seen = 0, np.zeros(0, np.int64)
        for batch in batches:
            sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            terms = order[batch.column("terms").flatten().to_numpy()]
            tf = batch.column("tf").flatten().to_numpy().astype(np.int64)
            n = batch.column("n").to_numpy()
            impact = impacts(tf, np.repeat(75 + 25 * n * n_docs // n_terms, sizes)).astype(np.int32)
            counted = terms >= 0
            sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[counted], minlength=len(sizes))
            terms, impact = terms[counted].astype(np.int32), impact[counted]
            full = np.flatnonzero(sizes > 0)
            to = np.append(0, np.cumsum(sizes))
            at = 0
            while at < len(full):
                # As many documents as the segment still takes; one always fits an empty segment.
                upto = min(len(full), at + SEGMENT_DOCS - docs)
                while True:
                    part = terms[to[full[at]] : to[full[upto - 1] + 1]]
                    columns = np.union1d(seen, part)
                    if (docs + upto - at) * len(columns) <= SEGMENT_CELLS or upto - at <= 1:
                        break
                    upto = at + (upto - at) // 2
                if docs and (docs + upto - at) * len(columns) > SEGMENT_CELLS:
                    yield segment()
                    docs, seen = 0, np.zeros(0, np.int64)
                    continue
                take = full[at:upto]
                ids.append(batch.column("id").take(pa.array(take)))
                keys.append(batch.column("row").to_numpy()[take])
                held.append((sizes[take], part, impact[to[take[0]] : to[take[-1] + 1]]))
                docs, seen, at = docs + len(take), columns, upto
                if docs >= SEGMENT_DOCS:
                    yield segment()
                    docs, seen = 0, np.zeros(0, np.int64)
        if docs:
            yield segment()

    return vectors.mapInArrow(rows, INDEX.format(kind=kind))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, Segment, tuple[np.ndarray, ...]]]:
    kinds = {"begin": np.int32, "terms": np.int32, "impact": np.int32, "counts": np.int32, "sizes": np.int32, "members": np.int16, "summaries": np.int32}
    for batch in batches:
        for i in range(batch.num_rows):
            x = {c: np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in kinds.items()}
            yield batch.column("ids")[i].values, batch.column("rows")[i].values.to_numpy(), Segment(x["begin"], x["terms"], x["impact"]), tuple(x[c] for c in ("counts", "sizes", "members", "summaries"))


def least_scores(index: DataFrame, queries: object, top: int) -> np.ndarray:
    """For each item a score that its ``top`` best documents reach, from each segment's most promising block."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for _, _, segment, blocks in _segments(batches):
            for q, scores in best_blocks(segment, queries.value, blocks):
                best[q] = -np.sort(-np.append(best.get(q, np.zeros(0, np.int64)), scores))[:top]
        q = np.repeat(np.array(list(best), np.int64), [len(x) for x in best.values()])
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(np.concatenate([np.zeros(0, np.int64), *best.values()]))], names=["q", "score"])

    scores = index.mapInArrow(rows, "q long, score long").withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"))))
    least = np.zeros(len(queries.value.terms))
    for r in scores.where(F.col("rank") == top).collect():
        least[r["q"]] = r["score"]
    return least


def best_documents(index: DataFrame, queries: object, least: np.ndarray, top: int) -> DataFrame:
    """``(q, id, row, score)``: each task's ``top`` documents of every item, of blocks that can reach them."""
    kind = index.schema["ids"].dataType.elementType.simpleString()
    sent = index.sparkSession.sparkContext.broadcast(least)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = sent.value.copy()
        best: dict[int, list[tuple]] = {}
        ids_kind = None
        for ids, keys, segment, blocks in _segments(batches):
            ids_kind = ids.type
            for q, docs, scores in candidates(segment, queries.value, blocks, least):
                own = np.flatnonzero((scores > 0) & (scores >= least[q]))
                names = ids.take(pa.array(docs[own])).to_pylist()
                found = [(-s, i is not None, i, k) for s, i, k in zip(scores[own].tolist(), names, keys[docs[own]].tolist())]
                best[q] = heapq.nsmallest(top, best.get(q, []) + found, key=lambda x: (x[0], x[1], x[2] if x[1] else 0, x[3]))
                if len(best[q]) == top:
                    least[q] = max(least[q], -best[q][-1][0])
        if ids_kind is not None:
            q = np.repeat(np.array(list(best), np.int64), [len(x) for x in best.values()])
            score, _, names, keys = zip(*[x for own in best.values() for x in own]) if len(q) else ((),) * 4
            columns = [pa.array(q), pa.array(names, ids_kind), pa.array(keys, pa.int64()), pa.array([-s for s in score], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["q", "id", "row", "score"])

    return index.mapInArrow(rows, f"q long, id {kind}, row long, score long")


def _batches(items: DataFrame, items_at_once: int, terms_at_once: int) -> Iterator[list]:
    """The items, about so many at a time."""
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    parts = max(1, -(-n // items_at_once), -(-size // terms_at_once))
    for part in range(parts):
        yield items.where(F.pmod(F.xxhash64("item", "row"), F.lit(parts)) == part).orderBy("item", "row").collect()


def _hashed(terms: list[str]) -> np.ndarray:
    data = "\n".join(terms).encode()
    raw = np.frombuffer(data, np.uint8)
    starts, ends, _ = words(raw, np.array([0, len(raw)]), ALNUM)
    return word_hashes(raw, starts, ends)


def search(
    docs: DataFrame, items: DataFrame, top: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", items_at_once: int = 256, terms_at_once: int = 1 << 14,
) -> DataFrame:
    """The ``top`` documents of every item, ranked by the terms that they share.

    Terms are runs of ASCII letters (A-Z in lower case), digits and characters beyond ASCII. A term weighs
    ``floor(1000 ln((2N + 2) / (2 df + 1)))``, and counts ``(10^9 tf) div (1000 tf + 12 m)`` times in a document,
    ``m = 75 + (25 n N) div L``; whole numbers throughout, so scores are exact. Equal scores go by ascending id.

    About ``items_at_once`` items with ``terms_at_once`` terms are searched for together. One pass over all whole texts
    keeps what each document has of their terms. An index is written from that, in segments of documents: each term's
    posting list is cut into blocks of similar documents, with the largest impact of every coordinate as summary. The
    most promising block of each segment gives every item a least score; then a block is read only if the item's score
    of its summary reaches that. No document above it is missed, and equal ones are found too.

    A null or empty text has no term and is never found, nor does an item without terms find any; fewer than ``top``
    documents with a score above 0 are all returned. A null id comes first among equal scores. Rows of ``docs`` that are
    equal are different documents; of equal rows of ``items`` there is one. Empty tables give no rows. Other
    columns are not read. Returns ``(item_col, rank, id_col, score)``.
    """
    spark = docs.sparkSession
    texts = keyed(docs, id_col, text_col)
    asked = stored(item_terms(items, item_col, item_text_col), "search-items")
    item_kind, id_kind = (df.schema[c].dataType.simpleString() for df, c in ((items, item_col), (docs, id_col)))
    found = []
    for batch in _batches(asked, items_at_once, terms_at_once):
        names = sorted({t for r in batch for t in r["terms"]})
        vectors = stored(term_vectors(texts, _hashed(names)), "search-vectors")
        n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
        if not n_docs or not names:
            continue
        frequency = np.zeros(len(names), np.int64)
        for term, df in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            frequency[term] = df
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)
        by_weight = np.lexsort((np.arange(len(names)), -weight))
        order = np.empty(len(names), np.int32)
        order[by_weight] = np.arange(len(names))
        order[weight <= 0] = -1

        number = {t: i for i, t in enumerate(names)}
        terms, weights = [], []
        for r in batch:
            own, times = np.unique(np.array([number[t] for t in r["terms"]], np.int64), return_counts=True)
            own, times = own[weight[own] > 0], times[weight[own] > 0]
            at = np.argsort(order[own])
            terms.append(order[own][at].astype(np.int64))
            weights.append((weight[own] * times)[at])
        queries = spark.sparkContext.broadcast(Queries(terms, weights))
        index = stored(build_index(vectors, queries, order, n_docs, n_terms), "search-index")
        best = best_documents(index, queries, least_scores(index, queries, top), top)
        by_number = spark.createDataFrame([(q, r["item"], r["row"]) for q, r in enumerate(batch)], f"q long, item {item_kind}, item_row long")
        found.append(best.join(F.broadcast(by_number), "q"))
    if not found:
        return spark.createDataFrame([], f"`{item_col}` {item_kind}, rank int, `{id_col}` {id_kind}, score long")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    rank = F.row_number().over(W.partitionBy("item", "item_row").orderBy(F.desc("score"), "id", "row"))
    every = every.withColumn("rank", rank).where(F.col("rank") <= top)
    return every.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
