"""LM scoring by context-tree weighting over bytes, each byte eight binary decisions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from canvass.llm.arrays import LOWER, pieces, signed, word_hashes, words
from canvass.llm.store import documents, small_batches, stored_lean

U64 = np.uint64
BYTE, WORD = 1, 0
END = 0xFF  # no byte of UTF-8: it ends every text and stands before its start
END_WORD = 1
MARK = 0xFF  # as a byte in place of the last: the end sign gets 0xFE


def _wide(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts with an end sign before, ``depth`` times, and after each; the places of their bytes and end signs, and where each text begins."""
    n = len(offsets) - 1
    shift = np.repeat(np.arange(n) * (depth + 1) + depth, np.diff(offsets))
    wide = np.full(len(data) + n * (depth + 1), END, np.uint8)
    wide[np.arange(len(data)) + shift] = LOWER[data]
    coded = np.ones(len(wide), bool)
    start = offsets[:-1] + np.arange(n) * (depth + 1)
    coded[(start[:, None] + np.arange(depth)).ravel()] = False
    return wide, np.flatnonzero(coded), offsets[:-1] + np.arange(n)


def _keys(wide: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The bytes at these places, each with the ``depth`` bytes before it: the byte itself is lowest, then the one before it, and so on upwards."""
    key = wide[at].astype(U64)
    key[key == END] ^= U64(1)
    for d in range(1, depth + 1):
        key |= wide[at - d].astype(U64) << U64(8 * d)
    return key


def _grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with the ``depth`` bytes before it, the end of each text included; and where each text begins."""
    wide, at, begin = _wide(data, offsets, depth)
    return _keys(wide, at, depth), begin


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[new], np.add.reduceat(n, new) if len(new) else n


def corpus_counts(docs: DataFrame, depth: int) -> DataFrame:
    """``(kind, key, n)``: how often each word and each byte with its context occurs in ``docs``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {WORD: ([], []), BYTE: ([], [])}

        def out() -> Iterator[pa.RecordBatch]:
            for kind, (keys, counts) in held.items():
                if keys:
                    key, n = _summed(keys, counts)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(signed(key)), pa.array(n)], names=["kind", "key", "n"])
                    keys.clear(), counts.clear()

        for k, (_, data, offsets) in enumerate(pieces(batches), 1):
            low = LOWER[data]
            starts, ends, _ = words(low, offsets)
            found = [(WORD, word_hashes(low, starts, ends)), (BYTE, _grams(data, offsets, depth)[0])]
            for kind, values in found:
                key, n = np.unique(values, return_counts=True)
                held[kind][0].append(key)
                held[kind][1].append(n.astype(np.int64))
            held[WORD][0].append(np.array([END_WORD], U64))
            held[WORD][1].append(np.array([len(offsets) - 1]))
            if k % 128 == 0:
                yield from out()
            elif k % 16 == 0:
                for keys, counts in held.values():
                    keys[:], counts[:] = ([x] for x in _summed(keys, counts))
        yield from out()

    counts = docs.select("text").mapInArrow(rows, "kind int, key long, n long")
    return counts.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after six steps up."""
    y = x + 6
    series = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3)
    return series - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of a sequence with so many zeros and ones by Krichevsky and Trofimov's estimate."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - 1.1447298858494002


def _decisions(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zeros and ones at every binary decision: context, then the bits of the byte so far with a one before them."""
    byte = key & U64(255)
    context = key & ~U64(255)
    nodes, zeros, ones = [], [], []
    for b in range(8):
        bit = (byte >> U64(7 - b) & U64(1)).astype(bool)
        nodes.append(context | U64(1 << b) | byte >> U64(8 - b))
        zeros.append(np.where(bit, 0, n))
        ones.append(np.where(bit, n, 0))
    node = np.concatenate(nodes)
    name, at = np.unique(node, return_inverse=True)
    count = lambda x: np.bincount(at, np.concatenate(x), len(name))
    return name, count(zeros), count(ones)


class Tree:
    """The decisions in contexts of ``first`` bytes and more, weighted from the leaves.

    ``counts`` has bytes with their contexts for each depth. ``below`` are sums over the children of the deepest level that are
    not here: ``(name of the parent, zeros, ones, log probability)``. ``top`` is the same of the first level itself.
    """

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]], first: int = 0, below: tuple[np.ndarray, ...] | None = None) -> None:
        self.first, self.counts = first, counts
        self.levels = [_decisions(key, n) for key, n in counts]
        last = len(counts) - 1
        # How well a node's own estimate and its children's code what it has seen.
        self.stop: list[np.ndarray] = [np.zeros(0)] * len(counts)
        self.rest: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0))] * len(counts)
        self.up: list[np.ndarray] = [np.zeros(0, np.int64)] * len(counts)
        for i in range(last, -1, -1):
            name, zeros, ones = self.levels[i]
            own = _log_kt(zeros, ones)
            if i < last:
                child, *sums = below  # type: ignore[misc]
                mask = U64((1 << 8 * (first + i)) - 1) << U64(8) | U64(255)
                parent = np.searchsorted(name, child & mask)
                self.up[i + 1] = parent
                told = [np.bincount(parent, x, len(name)) for x in sums]
            elif below is not None:
                parent = np.searchsorted(name, below[0])
                told = [np.bincount(parent, x, len(name)) for x in below[1:]]
            if below is None:
                weighted, self.stop[i], self.rest[i] = own, np.ones(len(name)), (zeros, ones)
            else:
                # What was seen in contexts too rare for the tree is a child of its own.
                self.rest[i] = (np.maximum(zeros - told[0], 0), np.maximum(ones - told[1], 0))
                under = told[2] + _log_kt(*self.rest[i])
                weighted = np.logaddexp(own, under) - np.log(2)
                self.stop[i] = np.exp(-np.logaddexp(0, under - own))  # never above one, however long the code
            below = (name, zeros, ones, weighted)
        self.top = below

    def mixed(self, said: np.ndarray, left: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
        """For each depth the decisions, and for a text whose longer context is not in the tree, the log odds of a one.

        A decision seen a hundred million times is so sure that 32 bits hold no such probability below one, but its odds.

        ``said`` and ``left`` are what all shorter contexts say of the decisions of the first level, and the
        weight they leave. The same of the last level is returned, too.
        """
        tables = []
        for i, (name, zeros, ones) in enumerate(self.levels):
            if i:
                said, left = said[self.up[i]], left[self.up[i]]
            said = said + left * self.stop[i] * (ones + 0.5) / (zeros + ones + 1)
            left = left * (1 - self.stop[i])
            ends = said + left * (self.rest[i][1] + 0.5) / (self.rest[i][0] + self.rest[i][1] + 1)
            tables.append((name, (np.log(ends) - np.log1p(-ends)).astype(np.float32)))
        return tables, said, left


def _tag(depth: int) -> np.uint64:
    return U64(depth + 1 << 56)


def _bits(tables: list[tuple[np.ndarray, np.ndarray]], key: np.ndarray, deepest: int) -> np.ndarray:
    """Log10 probability of each byte, decision by decision, each in its longest known context."""
    byte, total = key & U64(255), np.zeros(len(key))
    for b in range(8):
        prefix = U64(1 << b) | byte >> U64(8 - b)
        odds = np.zeros(len(key))
        open_ = np.arange(len(key))
        for d in range(deepest, -1, -1):
            name, chance = tables[d]
            node = key[open_] & U64((1 << 8 * d) - 1) << U64(8) | prefix[open_]
            at = np.minimum(np.searchsorted(name, node), max(len(name) - 1, 0))
            hit = name[at] == node if len(name) else np.zeros(len(node), bool)
            odds[open_[hit]] = chance[at[hit]]
            open_ = open_[~hit]
        bit = (byte >> U64(7 - b) & U64(1)).astype(bool)
        total -= np.log1p(np.exp(np.where(bit, -odds, odds)))
    return total / np.log(10)


def _entries(tables: list[tuple[np.ndarray, np.ndarray]], counts: list[tuple[np.ndarray, np.ndarray]], first: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes seen in a context that is in the tree, with their log10 probabilities, and a mark for the context itself."""
    keys = [key | _tag(first + i) for i, (key, _) in enumerate(counts)]
    marks = [np.unique(key | U64(MARK)) for key in keys]
    value = [_bits(tables, key, first + i) for i, (key, _) in enumerate(counts)] + [np.zeros(len(m)) for m in marks]
    return np.concatenate(keys + marks), np.concatenate(value).astype(np.float32)


class Model:
    """What a part of the tree says: ``tables`` for each depth, and the known bytes in a hash table."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]], keys: np.ndarray, values: np.ndarray) -> None:
        self.tables, self.slots = tables, _Slots(keys, values)

    def score(self, key: np.ndarray) -> np.ndarray:
        value, open_ = np.zeros(len(key)), np.arange(len(key))
        for d in range(len(self.tables) - 1, -1, -1):
            own = key[open_] & U64((1 << 8 * (d + 1)) - 1) | _tag(d)
            said, known = self.slots.find(own)
            value[open_[known]] = said[known]
            open_, own = open_[~known], own[~known]
            here = self.slots.find(own | U64(MARK))[1]
            if d == 0:
                here[:] = True
            if here.any():  # a known context with a byte it never had
                rare, at = np.unique(own[here] & ~_tag(d), return_inverse=True)
                value[open_[here]] = _bits(self.tables, rare, d)[at]
            open_ = open_[~here]
        return value


class _Slots:
    """A hash table of numbers for whole arrays of keys."""

    def __init__(self, key: np.ndarray, value: np.ndarray) -> None:
        self.bits = max(4, int(1.5 * len(key) + 1).bit_length())
        self.key, self.used = np.zeros(1 << self.bits, U64), np.zeros(1 << self.bits, bool)
        self.value = np.zeros(1 << self.bits, value.dtype)
        at, left = self._place(key), np.arange(len(key))
        while len(left):
            free = left[~self.used[at[left]]]
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.key[at[put]], self.value[at[put]], self.used[at[put]] = key[put], value[put], True
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _place(self, key: np.ndarray) -> np.ndarray:
        return (key * U64(0x9E3779B97F4A7C15) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each key, and which keys there are."""
        at = self._place(key)
        used = self.used[at]
        known = used & (self.key[at] == key)
        value = self.value[at].astype(np.float64)
        left = np.flatnonzero(used & ~known)
        at = at[left]
        while len(left):
            at = (at + 1) & ((1 << self.bits) - 1)
            used = self.used[at]
            hit = used & (self.key[at] == key[left])
            value[left[hit]], known[left[hit]] = self.value[at[hit]], True
            on = used & ~hit
            left, at = left[on], at[on]
        return value, known


def _collected(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = df.toArrow()
    key = table.column("key").to_numpy().astype(np.int64).view(U64)
    order = np.argsort(key)
    return key[order], table.column("n").to_numpy()[order].astype(np.float64)


SPLIT = 2  # bytes of context by which the tree is cut into groups
SHORT = 1 << 8 * SPLIT


def _levels(key: np.ndarray, n: np.ndarray, first: int, depth: int, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bytes in contexts of ``first`` to ``depth`` bytes that come before at least ``least``."""
    out = []
    for d in range(first, depth + 1):
        own, at = np.unique(key & U64((1 << 8 * (d + 1)) - 1), return_inverse=True)
        count = np.bincount(at, n, len(own)) if len(own) else np.zeros(0)
        context, at = np.unique(own >> U64(8), return_inverse=True)
        enough = (np.bincount(at, count, len(context)) >= least)[at] if len(own) else np.zeros(0, bool)
        out.append((own[enough], count[enough]))
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows ``(short, key, n)`` in the order of ``short``, one group after the other."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    now = None
    for batch in batches:
        short, key, n = (batch.column(c).to_numpy() for c in ("short", "key", "n"))
        cuts = np.flatnonzero(np.append(True, short[1:] != short[:-1])) if len(short) else np.zeros(0, np.int64)
        for a, b in zip(cuts, np.append(cuts[1:], len(short))):
            if held and short[a] != now:
                yield now, *(np.concatenate(x) for x in zip(*held))
                held = []
            now = int(short[a])
            held.append((key[a:b].view(U64), n[a:b].astype(np.float64)))
    if held:
        yield now, *(np.concatenate(x) for x in zip(*held))


def _frame(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))


def train(counts: DataFrame, depth: int, least: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray, DataFrame]:
    """The tree over all byte counts, its nodes being the contexts that come before at least ``least`` bytes.

    How many these are grows with the corpus. Contexts that end in the same two bytes are one group, built by one
    task; only their sums, at most 65,536, reach the driver, which weighs the contexts of none and one byte. With what those
    say, each group's probabilities are worked out and written: ``(short, size, depth, names, chances, keys, values)``.
    Returned are the tables and entries of the short contexts, and that written table.
    """
    spark = counts.sparkSession
    grams = counts.where(F.col("kind") == BYTE).select(F.shiftright("key", 8).bitwiseAND(SHORT - 1).cast("int").alias("short"), "key", "n")
    groups = grams.repartition("short").sortWithinPartitions("short")

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, key, n in _groups(batches):
            levels = _levels(key, n, SPLIT, depth, least)
            if len(levels[0][0]):
                name, zeros, ones, log = Tree(levels, SPLIT).top
                yield _frame(name=(name & U64(0xFFFF)).astype(np.int64), zeros=zeros, ones=ones, log=log)

    below = groups.mapInArrow(weighed, "name long, zeros double, ones double, log double")
    below = below.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "log")]).orderBy("name").toArrow()
    few = grams.groupBy(F.col("key").bitwiseAND(0xFFFF).alias("key")).agg(F.sum("n").alias("n")).orderBy("key").toArrow()
    own = _levels(few.column("key").to_numpy().view(U64), few.column("n").to_numpy().astype(np.float64), 0, SPLIT - 1, least)
    own[0] = _levels(few.column("key").to_numpy().view(U64), few.column("n").to_numpy().astype(np.float64), 0, 0, 0)[0]
    short = Tree(own, 0, (below.column("name").to_numpy().view(U64), *(below.column(c).to_numpy() for c in ("zeros", "ones", "log"))))
    n = len(short.levels[0][0])
    tables, said, left = short.mixed(np.zeros(n), np.ones(n))
    at = short.levels[-1][0].astype(np.int64)
    dense = np.zeros((2, SHORT))
    dense[0, at], dense[1, at] = said, left
    sent = spark.sparkContext.broadcast(dense)

    def worked_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, key, n in _groups(batches):
            levels = _levels(key, n, SPLIT, depth, least)
            if not len(levels[0][0]):
                continue
            tree = Tree(levels, SPLIT)
            parent = (tree.levels[0][0] & U64(0xFFFF)).astype(np.int64)
            found, _, _ = tree.mixed(sent.value[0][parent], sent.value[1][parent])
            keys, values = _entries([(np.zeros(0, U64), np.zeros(0, np.float32))] * SPLIT + found, levels, SPLIT)
            name, chance = (np.concatenate(x) for x in zip(*found))
            depths = np.repeat(np.arange(SPLIT, depth + 1, dtype=np.int8), [len(x) for x, _ in found])
            packed = [pa.array([x.tobytes()], pa.binary()) for x in (depths, name, chance, keys, values)]
            size = 13 * len(name) + 40 * len(keys)
            yield pa.RecordBatch.from_arrays([pa.array([group], pa.int32()), pa.array([size], pa.int64()), *packed], names=["short", "size", "depths", "names", "chances", "keys", "values"])

    model = groups.mapInArrow(worked_out, "short int, size long, depths binary, names binary, chances binary, keys binary, values binary")
    return tables, *_entries(tables, own, 0), stored_lean(model, "lm-model")


def blocks_of(model: DataFrame, block_bytes: int) -> Iterator[tuple[np.ndarray, list[int]]]:
    """For each block which groups it has, and those of them that are in the model: groups are dealt out so that a block takes about ``block_bytes`` of memory.

    The first has all groups that are not in the model as well.
    """
    sizes = np.zeros(SHORT, np.int64)
    for group, size in model.select("short", "size").collect():
        sizes[group] = size
    block = np.zeros(SHORT, np.int64)
    known = np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes)]
    n = max(1, -(-int(sizes.sum()) // block_bytes))
    filled = np.zeros(n, np.int64)
    for group in known:
        block[group] = filled.argmin()
        filled[block[group]] += sizes[group]
    for k in range(n):
        yield block == k, np.flatnonzero((block == k) & (sizes > 0)).tolist()


def block_model(model: DataFrame, groups: list[int], depth: int, tables: list[tuple[np.ndarray, np.ndarray]], keys: np.ndarray, values: np.ndarray) -> Model:
    """The part of the model for the groups of a block, and all short contexts."""
    held = [[x] for x in tables] + [[] for _ in range(SPLIT, depth + 1)]
    keys, values = [keys], [values]
    wanted = model.where(f"short in ({', '.join(map(str, groups))})") if groups else model.limit(0)
    for batch in wanted.select("depths", "names", "chances", "keys", "values").toArrow().to_batches():
        for depths, name, chance, key, value in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
            of, name, chance = np.frombuffer(depths, np.int8), np.frombuffer(name, U64), np.frombuffer(chance, np.float32)
            for d in range(SPLIT, depth + 1):
                held[d].append((name[of == d], chance[of == d]))
            keys.append(np.frombuffer(key, U64))
            values.append(np.frombuffer(value, np.float32))
    found = []
    for parts in held:
        name, chance = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, U64), np.zeros(0, np.float32))
        order = np.argsort(name)
        found.append((name[order], chance[order]))
    return Model(found, np.concatenate(keys), np.concatenate(values))


def _held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def block_scores(texts: DataFrame, depth: int, has: np.ndarray, model: Model) -> DataFrame:
    """``(id, row, part)``: the log10 probability of those bytes of each text whose context belongs to the block.

    The table is written at once, and the block removed from all tasks.
    """
    sent = texts.sparkSession.sparkContext.broadcast((has, model))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has, model = sent.value
        for batch, data, offsets in pieces(batches):
            wide, at, begin = _wide(data, offsets, depth)
            short = wide[at - 1].astype(np.uint16) | wide[at - 2].astype(np.uint16) << np.uint16(8)
            own = np.flatnonzero(has[short])
            doc = np.searchsorted(begin, own, "right") - 1
            score = np.bincount(doc, model.score(_keys(wide, at[own], depth)), batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), pa.array(score)], names=["id", "row", "part"])

    kind = texts.schema["id"].dataType.simpleString()
    out = stored_lean(texts.mapInArrow(rows, f"id {kind}, row long, part double"), "lm-scores")
    sent.destroy()
    return out


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None, depth: int = 6, least: int = 64, block_bytes: int = 1 << 26, words_at_once: int = 1 << 18
) -> DataFrame:
    """Log10 probability of every text, by a weighted context tree and by single words.

    The tree learns from all documents that are not ``held_out`` (default: CRC-32 of the id
    as text leaves 2 when divided by 7; a null id is not held out). Each byte, A-Z in lower
    case, is eight decisions; each decision's chance is mixed from Krichevsky-Trofimov
    estimates in contexts of 0 to ``depth`` bytes, weighted by how well they code the
    training texts. The tree has every context that comes before at least ``least`` bytes, however many there are;
    what is seen in rarer ones is a child of its own. A text is followed by an end sign, which is scored too.

    The tree is scored in blocks of about ``block_bytes``, sent to all tasks one after the other, each for the bytes whose last
    two bytes of context are its own; so the texts are read once more for each block.

    ``base_score`` is the sum over words and one end of log10((c + 1) / (N + V + 1)), with c
    the count of the word in training, N the sum of all and V their number. Words are
    counted exactly; the commonest are looked up where the text is read, all others are
    joined. They are told apart by a 64-bit hash.

    Returns ``(id_col, row, held_out, n_tokens, n_known, train_tokens, base_score, score)``,
    and ``code_bits``, the code length in bits per byte, the end sign counted as one. A null text is empty. One row
    for each input row.
    """
    spark = docs.sparkSession
    held = _held_out(F.col(id_col)) if held_out is None else F.coalesce(held_out, F.lit(False))
    texts = small_batches(docs).select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("row"), F.col(text_col).alias("text"), held.alias("held"))
    counts = stored_lean(corpus_counts(texts.where("not held"), depth), "lm-counts")
    tables, keys, values, model = train(counts, depth, least)
    tokens = counts.where(F.col("kind") == WORD)
    n_train, kinds = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    common = F.col("n") * words_at_once >= n_train
    sent = spark.sparkContext.broadcast(_collected(tokens.where(common)))
    scale = np.log10(float(n_train + kinds + 1))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Slots(*sent.value)
        end_n, _ = table.find(np.array([END_WORD], U64))
        for batch, data, offsets in pieces(batches):
            low = LOWER[data]
            starts, ends, first = words(low, offsets)
            h = word_hashes(low, starts, ends)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
            c, known = table.find(h)
            each = lambda x: np.bincount(doc, x, batch.num_rows)  # noqa: B023, E731
            base = each(np.where(known, np.log10(c + 1) - scale, 0.0)) + np.log10(end_n[0] + 1) - scale
            n_known = each(known).astype(np.int64) + int(end_n[0] > 0)
            rare = np.flatnonzero(~known)
            at = pa.array(np.concatenate([np.arange(batch.num_rows), doc[rare]]))
            fill = lambda x, kind: pa.array(np.concatenate([np.asarray(x, kind), np.zeros(len(rare), kind)]))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(at),
                    batch.column("row").take(at),
                    batch.column("held").take(at),
                    pa.array(np.concatenate([batch.column("row").to_numpy(), signed(h[rare])])),
                    fill(np.ones(batch.num_rows), np.int64),
                    fill(np.diff(first) + 1, np.int64),
                    fill(n_known, np.int64),
                    fill(base, np.float64),
                    fill(np.diff(offsets) + 1, np.int64),
                ],
                names=["id", "row", "held", "key", "copies", "n_tokens", "n_known", "base", "n_bytes"],
            )

    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, row long, held boolean, key long, copies long, n_tokens long, n_known long, base double, n_bytes long"
    said = texts.mapInArrow(rows, schema)
    others = tokens.where(~common).select("key", "n")
    both = said.join(others, "key", "left")
    word = F.col("copies") == 0
    both = both.withColumn("n_known", F.when(word, F.col("n").isNotNull().cast("long")).otherwise(F.col("n_known")))
    both = both.withColumn("base", F.when(word, F.log10(F.coalesce("n", F.lit(0)) + 1.0) - float(scale)).otherwise(F.col("base")))
    out = both.groupBy("id", "row", "held").agg(*[F.sum(c).alias(c) for c in ("copies", "n_tokens", "n_known", "base", "n_bytes")])
    for k, (has, groups) in enumerate(blocks_of(model, block_bytes)):
        part = block_scores(texts, depth, has, block_model(model, groups, depth, tables, keys, values))
        part = part.groupBy("id", "row").agg(F.first("part").alias("part"))
        said = part if k == 0 else said.unionByName(part)
    told = said.groupBy(F.col("id").alias("of"), F.col("row").alias("of_row")).agg(F.sum("part").alias("score"))
    out = out.join(told, F.col("id").eqNullSafe(F.col("of")) & F.col("row").eqNullSafe(F.col("of_row")))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    share = lambda c: (F.col(c) / F.col("copies"))
    return out.select(
        F.col("id").alias(id_col),
        "row",
        F.col("held").alias("held_out"),
        share("n_tokens").cast("long").alias("n_tokens"),
        share("n_known").cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        share("base").alias("base_score"),
        "score",
        (-F.col("score") / share("n_bytes") * float(np.log2(10))).alias("code_bits"),
    )


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir)).drop("row")
