"""SimHash near-dedup by anchor-point covering."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.arrays import pieces, signed
from canvass.llm.components import components
from canvass.llm.store import documents, keyed, stored

# Blocks of the 64 bits and the perfect code on each: (first bit, bits, generator polynomial, covering
# radius). Twice the binary Golay code, once the Hamming code of length 15; 35 of 61 bits are free, the
# last three bits take no part in the choice of an anchor.
BLOCKS = ((0, 23, 0xAE3, 3), (23, 23, 0xAE3, 3), (46, 15, 0x13, 1))
PAIRWISE = 1 << 16


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(id, row, fingerprint)``: a bit is set if it is set in over half the shingles' hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            raw = data.tobytes().lower()
            hashes, counts = [], []
            for i in range(batch.num_rows):
                found = raw[offsets[i] : offsets[i + 1]].split()
                grams = zip(*(found[k:] for k in range(shingle))) if len(found) > shingle else [found] * bool(found)
                own = list(map(xxhash.xxh64_intdigest, map(b" ".join, grams), repeat(42)))
                hashes += own
                counts.append(len(own))
            n = np.array(counts)
            prints = np.zeros(batch.num_rows, np.uint64)
            if hashes:
                bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                full = n > 0
                ones = np.add.reduceat(bits, (np.cumsum(n) - n)[full], axis=0, dtype=np.int32)
                prints[full] = np.packbits(2 * ones > n[full, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.array(signed(prints))], names=["id", "row", "fingerprint"]
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(rows, f"id {kind}, row long, fingerprint long")


def _syndromes(values: np.ndarray, bits: int, poly: int) -> np.ndarray:
    """The remainder of each value, read as a polynomial over two elements."""
    degree = poly.bit_length() - 1
    rest = values.copy()
    for i in range(bits - 1, degree - 1, -1):
        rest ^= np.where(rest >> i & 1, poly << (i - degree), 0)
    return rest


@cache
def _reach(bits: int, poly: int, radius: int, flips: int) -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome, how to change a value with it into the code words nearest to any value within ``flips``.

    Returns the changes of all syndromes in one array, and where each syndrome's begin.
    """

    def patterns(most: int) -> np.ndarray:
        return np.array([sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)])

    errors = patterns(radius)
    leader = np.zeros(len(errors), np.int64)
    leader[_syndromes(errors, bits, poly)] = errors
    moves = patterns(flips)
    shift = _syndromes(moves, bits, poly)
    lists = [np.unique(moves ^ leader[s ^ shift]) for s in range(len(leader))]
    return np.concatenate(lists), np.cumsum([0, *map(len, lists)])


def anchors_of(prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchors that each fingerprint is sent to: index of the fingerprint, anchor.

    Two fingerprints within ``threshold`` bits have a point between them no more than half
    of it, rounded up, from either. That point has an anchor within the covering radius, so
    it is enough to send a fingerprint to the anchors of all points within that half.
    """
    half = (threshold + 1) // 2
    wide = prints.astype(np.uint64)
    found = []
    for flips in product(range(half + 1), repeat=len(BLOCKS)):
        if sum(flips) != half:
            continue
        which, anchor = np.arange(len(prints)), np.zeros(len(prints), np.int64)
        for (at, bits, poly, radius), f in zip(BLOCKS, flips):
            value = (wide >> np.uint64(at)).astype(np.int64) & ((1 << bits) - 1)
            changes, begin = _reach(bits, poly, radius, f)
            syndrome = _syndromes(value, bits, poly)[which]
            n = begin[syndrome + 1] - begin[syndrome]
            each = np.repeat(np.arange(len(which)), n)
            nth = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            change = changes[begin[syndrome][each] + nth]
            which = which[each]
            anchor = anchor[each] | ((value[which] ^ change) << at)
        found.append((which, anchor))
    which, anchor = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((anchor, which))
    which, anchor = which[order], anchor[order]
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (anchor[1:] != anchor[:-1])
    return which[new], anchor[new]


def _links(prints: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All linked pairs among sorted different fingerprints of one anchor, in blocks."""
    n = len(prints)
    if n <= PAIRWISE:
        for at in range(0, n, 256):
            near = np.bitwise_count(prints[at : at + 256, None] ^ prints[None, at:]) <= threshold
            i, j = np.nonzero(near)
            yield i[i < j] + at, j[i < j] + at
        return
    for k in range(1, threshold + 1):  # beyond: look up every neighbour, which is linear in n
        for bits in combinations(range(64), k):
            other = prints ^ np.uint64(sum(1 << b for b in bits))
            at = np.minimum(np.searchsorted(prints, other), n - 1)
            hit = np.flatnonzero((prints[at] == other) & (prints < other))
            yield hit, at[hit]


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least label of everything joined by the pairs."""
    while True:
        least = np.minimum(labels[a], labels[b])
        after = labels.copy()
        np.minimum.at(after, labels[a], least)
        np.minimum.at(after, labels[b], least)
        after = after[after]
        if (after == labels).all():
            return labels
        labels = after


def _spanning(anchor: np.ndarray, prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links enough to join what is linked inside each anchor; rows are sorted by anchor and fingerprint."""
    new = np.append(np.flatnonzero(np.diff(anchor, prepend=~anchor[:1])), len(anchor))
    size = np.diff(new)
    labels = np.arange(len(anchor))
    small = np.repeat(size <= 64, size)
    left, pairs = np.flatnonzero(small), []
    for lag in range(1, 64):
        left = left[left + lag < len(anchor)]
        left = left[anchor[left] == anchor[left + lag]]
        if not len(left):
            break
        near = left[np.bitwise_count(prints[left] ^ prints[left + lag]) <= threshold]
        pairs.append((near, near + lag))
    if pairs:
        labels = _joined(labels, *(np.concatenate(x) for x in zip(*pairs)))
    for k in np.flatnonzero(size > 64):
        own = np.arange(size[k])
        for a, b in _links(prints[new[k] : new[k + 1]], threshold):
            own = _joined(own, a, b)
        labels[new[k] : new[k + 1]] = own + new[k]
    moved = np.flatnonzero(labels != np.arange(len(labels)))
    return prints[moved], prints[labels[moved]]


def links(prints: DataFrame, threshold: int = 2) -> DataFrame:
    """``(u, v)``: links among different fingerprints that join all that are within ``threshold`` bits."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("fingerprint").to_numpy()
            for at in range(0, len(own), 1 << 15):
                part = own[at : at + (1 << 15)]
                which, anchor = anchors_of(part.view(np.uint64), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[which])], names=["anchor", "fingerprint"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, own = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            anchor = np.concatenate([anchor, batch.column("anchor").to_numpy()])
            own = np.concatenate([own, batch.column("fingerprint").to_numpy()])
            done = int(np.searchsorted(anchor, anchor[-1])) if len(anchor) else 0  # the last anchor may go on
            if done:
                u, v = _spanning(anchor[:done], own[:done].view(np.uint64), threshold)
                anchor, own = anchor[done:], own[done:]
                yield pa.RecordBatch.from_arrays([pa.array(signed(u)), pa.array(signed(v))], names=["u", "v"])
        if len(anchor):
            u, v = _spanning(anchor, own.view(np.uint64), threshold)
            yield pa.RecordBatch.from_arrays([pa.array(signed(u)), pa.array(signed(v))], names=["u", "v"])

    sent = prints.select("fingerprint").mapInArrow(spread, "anchor long, fingerprint long")
    # The order is that of unsigned numbers inside an anchor: two sorts by sign, then by value.
    order = ["anchor", F.col("fingerprint") < 0, "fingerprint"]
    return sent.repartition("anchor").sortWithinPartitions(*order).mapInArrow(compare, "u long, v long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, threshold: int = 2) -> DataFrame:
    """Groups of documents whose SimHash fingerprints are linked, directly or over others.

    Equal fingerprints are one from the start. Anchors are the words of a product of
    perfect codes (``BLOCKS``); a fingerprint goes to about sixteen of 2^35 anchors, and is
    compared there only. Inside an anchor links are reduced to a spanning forest before
    they leave the task.

    Returns ``(id_col, row, fingerprint, component_id, root)``, one row for each input row:
    ``fingerprint`` as 16 hexadecimal digits, ``component_id`` the smallest id of the group,
    ``root`` its least fingerprint, which tells groups apart where ids repeat.
    A text without words, or null, has fingerprint zero. Fewer words than a shingle make
    one shingle. A null id is never the smallest unless a group has no other.
    """
    own = stored(fingerprints(keyed(docs, id_col, text_col), shingle), "fingerprints")
    distinct = own.groupBy("fingerprint").agg(F.min("id").alias("first"))
    roots = components(links(distinct, threshold))
    rooted = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left")
    rooted = rooted.select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = rooted.join(smallest, "root").select("fingerprint", "root", "component_id")
    out = own.join(of_print, "fingerprint")
    return out.select(
        F.col("id").alias(id_col), "row", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id", "root"
    )


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 2) -> DataFrame:
    """Keep one row of each group: the smallest id, and of equal ids the smallest text hash."""
    groups = simhash_groups(docs, id_col, text_col, threshold=threshold)
    kept = groups.groupBy("root").agg(F.min(F.struct(id_col, "row")).alias("keep")).select("keep.*")
    kept = kept.select(F.col(id_col).alias("keep_id"), F.col("row").alias("keep_row"))
    same = docs[id_col].eqNullSafe(kept["keep_id"]) & (F.xxhash64(docs[text_col]) == kept["keep_row"])
    found = docs.join(kept, same, "left_semi")
    return found.dropDuplicates([id_col, text_col])


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir)).drop("row", "root")
