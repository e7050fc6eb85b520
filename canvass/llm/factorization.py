"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.arrays import LOWER, U64, pieces, word_hashes, words
from canvass.llm.quality import COUNTS, counts
from canvass.llm.store import documents, small_batches, stored

WORD_BITS = 16
STEPS = 16  # buckets of a share; one more for a share of nothing
SIZES = 32  # buckets of a size, by its binary logarithm; one more for none

# Structure statistics: shares of one count in another, and sizes.
SHARES = (("n_symbols", "n_words"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_ended_lines", "n_lines"), ("n_letters", "n_chars"), ("n_upper", "n_letters"), ("n_distinct", "n_words"))
MEANS = (("word_chars", "n_words", 16), ("n_words", "n_lines", 64))
LOGS = ("n_words", "n_lines", "n_chars")


def _share(part: np.ndarray, whole: np.ndarray, most: float = 1.0) -> np.ndarray:
    step = np.minimum(part * STEPS / (np.maximum(whole, 1) * most), STEPS - 1).astype(np.int64)
    return np.where(whole > 0, step, STEPS)


def _logs(n: np.ndarray) -> np.ndarray:
    """The bucket of a number; a missing one, and one below 0, has the last."""
    known = n >= 0
    return np.where(known, np.minimum(np.log2(1 + np.where(known, n, 0)), SIZES - 1).astype(np.int64), SIZES)


@dataclass
class Features:
    """Of a number of documents: different words as hash slots, and one slot for each statistic and metadata column."""

    first: np.ndarray  # of each document's words, one more at the end
    word: np.ndarray
    weight: np.ndarray  # so that the squares of a document's words sum up to one
    other: np.ndarray  # a row for each document

    @staticmethod
    def slots(n_meta: int) -> int:
        return (1 << WORD_BITS) + (len(SHARES) + len(MEANS)) * (STEPS + 1) + (len(LOGS) + n_meta) * (SIZES + 1)

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray, meta: list[np.ndarray]) -> Features:
        low = LOWER[data]
        starts, ends, first = words(low, offsets)
        slot = (word_hashes(low, starts, ends) >> U64(64 - WORD_BITS)).astype(np.int64)
        n_docs = len(offsets) - 1
        doc = np.repeat(np.arange(n_docs), np.diff(first))
        key = np.unique(doc << WORD_BITS | slot)
        n = np.bincount(key >> WORD_BITS, minlength=n_docs)
        found = dict(zip(COUNTS, (c.astype(np.float64) for c in counts(data, offsets))))
        columns = [(_share(found[a], found[b]), STEPS) for a, b in SHARES]
        columns += [(_share(found[a], found[b], most), STEPS) for a, b, most in MEANS]
        columns += [(_logs(found[c]), SIZES) for c in LOGS] + [(_logs(m), SIZES) for m in meta]
        base = (1 << WORD_BITS) + np.append(0, np.cumsum([steps + 1 for _, steps in columns])[:-1])
        other = np.stack([c for c, _ in columns], 1) + base
        return cls(np.append(0, np.cumsum(n)), key & ((1 << WORD_BITS) - 1), np.repeat(1 / np.sqrt(np.maximum(n, 1)), n), other)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.other)), np.diff(self.first))

    def take(self, docs: np.ndarray) -> Features:
        n = np.diff(self.first)[docs]
        first = np.append(0, np.cumsum(n))
        at = np.repeat(self.first[docs] - first[:-1], n) + np.arange(first[-1])
        return Features(first, self.word[at], self.weight[at], self.other[docs])


def _summed(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of each document."""
    out = np.zeros((len(first) - 1, *values.shape[1:]))
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(values, first[full], axis=0)
    return out


@dataclass
class Machine:
    """``bias + sum w x + sum over pairs <v_i, v_j> x_i x_j``, as a probability."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def parts(self, x: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The value of every document, the sums of its factors, and those of each of its words.

        All pairs together are half the square of the sum less the sum of squares, for each
        factor, so that the time is linear in the words.
        """
        own = self.factors[x.word] * x.weight[:, None]
        beside = self.factors[x.other]
        total = _summed(own, x.first) + beside.sum(1)
        squares = _summed(own**2, x.first) + (beside**2).sum(1)
        value = self.bias + _summed(self.linear[x.word] * x.weight, x.first) + self.linear[x.other].sum(1)
        return value + 0.5 * (total**2 - squares).sum(1), total, own

    def chance(self, x: Features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.parts(x)[0], -30, 30)))


def fit(x: Features, good: np.ndarray, n_slots: int, rank: int = 8, rounds: int = 12, batch: int = 128, rate: float = 0.05, decay: float = 1e-4, seed: int = 11) -> Machine:
    """A machine for the labels, by adaptive gradient steps; the same rows in the same order give the same machine."""
    chance = np.random.default_rng(seed)
    share = (good.sum() + 1) / (len(good) + 2)
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(n_slots), chance.normal(0, 0.02, (n_slots, rank)))
    seen = [0.0, np.full(n_slots, 1e-8), np.full((n_slots, rank), 1e-8)]
    for _ in range(rounds if len(good) else 0):
        order = chance.permutation(len(good))
        for k in range(0, len(order), batch):
            docs = order[k : k + batch]
            part = x.take(docs)
            value, total, own = machine.parts(part)
            error = (1 / (1 + np.exp(-np.clip(value, -30, 30))) - good[docs]) / len(docs)
            of_word = error[part.doc]
            slot = np.concatenate([part.word, part.other.ravel()])
            down = np.concatenate([of_word * part.weight, np.repeat(error, part.other.shape[1])])
            beside = (total[:, None, :] - machine.factors[part.other]) * error[:, None, None]
            down_v = np.concatenate([of_word[:, None] * part.weight[:, None] * (total[part.doc] - own), beside.reshape(-1, rank)])
            touched, at = np.unique(slot, return_inverse=True)
            g = np.bincount(at, down, len(touched)) + decay / len(order) * machine.linear[touched]
            g_v = np.stack([np.bincount(at, down_v[:, f], len(touched)) for f in range(rank)], 1) + decay / len(order) * machine.factors[touched]
            seen[0] += error.sum() ** 2
            seen[1][touched] += g**2
            seen[2][touched] += g_v**2
            machine.bias -= rate * error.sum() / np.sqrt(seen[0] + 1e-8)
            machine.linear[touched] -= rate * g / np.sqrt(seen[1][touched])
            machine.factors[touched] -= rate * g_v / np.sqrt(seen[2][touched])
    return machine


def _read(batches: Iterator[pa.RecordBatch], metadata: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, Features]]:
    for batch, data, offsets in pieces(batches):
        meta = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in metadata]
        yield batch, Features.of(data, offsets, [np.where(np.isnan(m), -1, m) for m in meta])


def _held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(labelled: DataFrame, metadata: Sequence[str]) -> Machine:
    """A machine from the different texts of a bounded sample ``(text, good, metadata)``."""
    part = stored(labelled.select("text", "good", *metadata, F.xxhash64("text").alias("h")).dropDuplicates(["h", "good"]), "quality-sample")
    read: list[tuple[Features, np.ndarray]] = []
    table = small_batches(part.orderBy("h", "good")).select("text", "good", *metadata).toArrow()
    for batch, x in _read(iter(table.to_batches(max_chunksize=1000)), metadata):
        read.append((x, batch.column("good").to_numpy(zero_copy_only=False).astype(np.float64)))
    n_slots = Features.slots(len(metadata))
    if not read:
        return fit(Features(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 1), np.int64)), np.zeros(0), n_slots)
    sizes = np.concatenate([np.diff(x.first) for x, _ in read])
    every = Features(np.append(0, np.cumsum(sizes)), *(np.concatenate([getattr(x, c) for x, _ in read]) for c in ("word", "weight", "other")))
    return fit(every, np.concatenate([y for _, y in read]), n_slots)


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    metadata: Sequence[str] = ("n_chars",), held_out: Column | None = None, sample: int = 8000, least: float = 0.7,
) -> DataFrame:
    """The probability that each text is of good quality, learnt from ``labels``.

    Inputs of a score are the different words of a text (A-Z in lower case, hashed to 65,536 slots, scaled to one), structure
    statistics in buckets (lines, repeats, symbols, letters, case) and the numbers of the ``metadata`` columns that ``docs`` has.
    Every pair of inputs interacts through eight factors. Labels of ``held_out`` rows (default: CRC-32 of the id as text
    leaves 2 when divided by 4) are never read. The machine is fitted on the different texts of at most ``sample``
    labels, those with the least hashes of their ids, whatever the size of the tables; these few are sent to where the texts
    are. It is then the same for all tasks, and every whole text is scored.

    A null text is empty; empty texts, null ids and null metadata are scored like any other. Labelled rows with a null
    label, or an id that is not in ``docs``, are not used; without any the score is 0.5. Rows that are equal are scored alike. Returns
    ``(id_col, held_out, score, predicted)``, one row for each input row; ``predicted`` is 1 from ``least`` on.
    """
    meta = [c for c in metadata if c in docs.columns]
    held = _held_out(F.col(id_col)) if held_out is None else F.coalesce(held_out, F.lit(False))
    numbers = [F.col(c).cast("double").alias(f"meta_{k}") for k, c in enumerate(meta)]
    names = [f"meta_{k}" for k in range(len(meta))]
    texts = small_batches(docs).select(F.col(id_col).alias("id"), held.alias("held"), F.col(text_col).alias("text"), *numbers)
    told = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("good")).where(F.col("good").isin(0, 1) & F.col("id").isNotNull())
    told = told.where(~_held_out(F.col("id"))) if held_out is None else told
    told = told.distinct().orderBy(F.xxhash64("id"), "id", "good").limit(sample)
    machine = train(texts.where("not held").join(F.broadcast(told), "id"), names)
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _read(batches, names):
            score = sent.value.chance(x)
            columns = [batch.column("id"), batch.column("held"), pa.array(score), pa.array((score >= least).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "held_out", "score", "predicted"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
