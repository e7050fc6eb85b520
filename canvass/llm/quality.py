"""Quality by weak supervision: rules vote, expectation-maximisation weighs them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canvass.llm.arrays import BASE_A, BASE_B, NOT_SPACE, Rolling, byte_values, mix, pieces, word_hashes, words
from canvass.llm.store import documents, keyed, small_batches, stored

COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_ended_lines n_letters n_upper n_chars n_distinct".split()

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[192:] = True  # beyond ASCII, the first byte of a character
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LEADING = np.ones(256, bool)
LEADING[128:192] = False
ENDING = np.zeros(256, bool)
ENDING[list(b".!?:;\"')")] = True

# Votes: a rule says good, says bad, or abstains where neither condition holds.
RULES: dict[str, tuple[str, str]] = {
    "long_enough": ("n_words >= 50", "n_words < 10"),
    "no_repeats": ("n_repeat_words <= 0.05 * n_words", "n_repeat_words > 0.2 * n_words"),
    "lines_differ": ("n_dup_lines = 0 and n_lines >= 3", "n_dup_lines > 0.3 * n_lines"),
    "few_symbols": ("n_symbols <= 0.02 * n_words", "n_symbols > 0.1 * n_words"),
    "word_length": ("word_chars between 4 * n_words and 7 * n_words", "word_chars < 3 * n_words or word_chars > 10 * n_words"),
    "lines_end": ("n_ended_lines >= 0.9 * n_lines", "n_ended_lines < 0.5 * n_lines"),
    "letters": ("n_letters >= 0.75 * n_chars", "n_letters < 0.6 * n_chars"),
    "lower_case": ("n_upper <= 0.15 * n_letters", "n_upper > 0.5 * n_letters"),
    "varied_words": ("n_distinct >= 0.4 * n_words or n_distinct >= 300", "n_distinct < 0.25 * n_words and n_distinct < 100"),
}
BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def _per_document(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(mask, dtype=np.int64))
    return total[offsets[1:]] - total[offsets[:-1]]


def _again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys had an equal one before, and which have an equal one at all."""
    order = np.argsort(keys, kind="stable")
    equal = keys[order][1:] == keys[order][:-1]
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = equal
    any_[order[1:]] |= equal
    any_[order[:-1]] |= equal
    return later, any_


def counts(data: np.ndarray, offsets: np.ndarray, window: int = 5) -> list[np.ndarray]:
    """``COUNTS`` of every document of a part."""
    n_docs = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    h = word_hashes(data, starts, ends)
    salt = mix(np.arange(1, n_docs + 1, dtype=np.uint64))  # equal only within a document
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    distinct = np.bincount(doc, minlength=n_docs) - np.bincount(doc[_again(h ^ salt[doc])[0]], minlength=n_docs)

    grams = Rolling(h, BASE_B).grams(window)
    inside = np.flatnonzero(doc[: len(grams)] == doc[window - 1 :]) if len(grams) else np.zeros(0, np.int64)
    twice = inside[_again(grams[inside] ^ salt[doc[inside]])[1]]
    cover = np.zeros(len(h) + 1, np.int32)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + window, -1)
    repeated = np.cumsum(cover[:-1]) > 0

    # Lines with a word: from the first byte after a line feed or a document's start.
    is_feed = data == 10
    line_of = np.append(0, np.cumsum(is_feed))[starts] if len(starts) else np.zeros(0, np.int64)
    new_line = np.ones(len(starts), bool)
    new_line[1:] = (line_of[1:] != line_of[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new_line)
    feeds = np.flatnonzero(is_feed)
    k = np.searchsorted(feeds, starts[at])
    begin = np.maximum(np.append(-1, feeds)[k] + 1, offsets[doc[at]])
    end = np.minimum(np.append(feeds, len(data))[k], offsets[doc[at] + 1])
    line_doc = doc[at]
    lines = Rolling(byte_values()[data], BASE_A).spans(begin, end)
    dup = _again(lines ^ salt[line_doc])[0]
    last_word = np.append(at[1:], len(starts))[: len(at)] - 1
    ended = ENDING[data[ends[last_word] - 1]] if len(at) else np.zeros(0, bool)
    in_words = NOT_SPACE[data] & LEADING[data]
    return [
        np.diff(first),
        _per_document(in_words, offsets),
        _per_document(SYMBOL[data], offsets),
        np.bincount(line_doc[dup], minlength=n_docs),
        np.bincount(doc[repeated], minlength=n_docs),
        np.bincount(line_doc, minlength=n_docs),
        np.bincount(line_doc[ended], minlength=n_docs),
        _per_document(LETTER[data], offsets),
        _per_document(UPPER[data], offsets),
        _per_document(LEADING[data], offsets),
        distinct,
    ]


def _text_counts(text: pa.Array) -> pa.Array:
    parts = [counts(data, offsets) for _, data, offsets in pieces(iter([pa.RecordBatch.from_arrays([text], names=["text"])]))]
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts)] or [np.zeros(0, np.int64)] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], names=COUNTS)


# Said not to repeat its results, so that a filter on them does not compute them a second time.
text_counts = F.arrow_udf(_text_counts, T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])).asNondeterministic()


def votes() -> F.Column:
    """All votes of a row as one number in base 3: 0 abstains, 1 is good, 2 is bad."""
    code = F.lit(0)
    for k, (good, bad) in enumerate(RULES.values()):
        vote = F.when(F.expr(f"n_words > 0 and ({good})"), 1).when(F.expr(bad), 2).otherwise(0)
        code = code + vote * (3**k)
    return code.cast("int")


def posteriors(patterns: dict[int, int], rounds: int = 200) -> dict[int, float]:
    """Probability of good quality for every pattern of votes.

    Each rule has, for good and for bad documents, its chances to say good, to say bad and
    to abstain. They and the share of good documents are estimated in turn with the
    probability of each pattern, starting from the majority of votes.
    """
    if not patterns:
        return {}
    codes = np.array(sorted(patterns))
    weight = np.array([patterns[c] for c in codes], float)
    cast = codes[:, None] // 3 ** np.arange(len(RULES)) % 3
    good = np.clip(((cast == 1).sum(1) + 0.5) / ((cast > 0).sum(1) + 1), 0.05, 0.95)
    for _ in range(rounds):
        logs = []
        for of in (good, 1 - good):
            mass = weight * of
            chance = np.stack([(mass[:, None] * (cast == v)).sum(0) + 0.5 for v in range(3)])
            chance /= chance.sum(0)
            logs.append(np.log(chance)[cast, np.arange(len(RULES))].sum(1) + np.log(mass.sum() + 1))
        after = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -500, 500)))
        if np.abs(after - good).max() < 1e-9:
            break
        good = after
    return dict(zip(codes.tolist(), good.tolist()))


def _fitted(measured: DataFrame) -> DataFrame:
    """Posterior of each pattern of votes; there are at most ``3 ** len(RULES)``, however many documents."""
    found = {r["votes"]: r["count"] for r in measured.groupBy("votes").count().collect()}
    return measured.sparkSession.createDataFrame(list(posteriors(found).items()), "votes int, quality double")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Counts, votes, probability of good quality and verdict of every document.

    ``kept`` is false where ``BASE_FAILED`` holds, and else tells whether the probability
    is ``least`` or more. A null or empty text has no words and is not kept. Rows with equal
    texts get equal verdicts. Returns ``(id_col, row, COUNTS, votes, base_failed, quality, kept)``.
    """
    measured = keyed(docs, id_col, text_col).select("id", "row", text_counts("text").alias("c")).select("id", "row", "c.*")
    measured = stored(measured.withColumn("votes", votes()), "votes")
    out = measured.join(F.broadcast(_fitted(measured)), "votes").withColumn("base_failed", F.expr(BASE_FAILED))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    return out.withColumnRenamed("id", id_col)


def quality_filter(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents that ``quality`` keeps, all columns as they were; texts are read twice and never shuffled."""
    packed = small_batches(docs).select(F.struct("*").alias("doc"), text_counts(F.col(text_col)).alias("c")).select("doc", "c.*").withColumn("votes", votes())
    good = packed.join(F.broadcast(_fitted(packed)), "votes").where((F.col("quality") >= least) & ~F.expr(BASE_FAILED))
    return good.select("doc.*")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )
