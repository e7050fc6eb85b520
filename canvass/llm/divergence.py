"""Source divergence audit: texts that are equal are collapsed, read once and weighed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from canvass.llm.arrays import LOWER, U64, mix, pieces, ranges, word_hashes, words
from canvass.llm.store import documents, small_batches, stored

# Bytes of terms: ASCII letters, and everything beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
SCALE = 1_000_000_000
PRIOR = 5


def collapsed(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row for each different text of a language, ``(lang, text, gs, ns)``, and all groups ``(lang, source, g)``.

    ``ns`` says how many rows of each source, by its number ``g`` in the language, have the text; the two are no longer
    than the language has sources. Copies are counted before any text is moved, then each task sends a text once.
    """
    named = named.withColumn("digest", F.md5("text"))
    copies = stored(named.groupBy("lang", "digest", "source").agg(F.count("*").alias("n")), "audit-copies")
    number = F.row_number().over(W.partitionBy("lang").orderBy("source"))
    groups = stored(copies.select("lang", "source").distinct().withColumn("g", number), "audit-sources")
    sources = copies.join(groups, ["lang", "source"]).groupBy("lang", "digest").agg(F.collect_list(F.struct("g", "n")).alias("s"))
    texts = named.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(sources, ["lang", "digest"]).select("lang", "text", F.col("s.g").alias("gs"), F.col("s.n").alias("ns")), groups


class _Held:
    """The terms of some megabytes of texts, summed up by language and term."""

    def __init__(self) -> None:
        self.langs: dict[str, int] = {}
        self.hashes: list[np.ndarray] = []
        self.text_of: list[np.ndarray] = []
        self.strings: list[pa.Array] = []
        self.lang_of: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.texts = self.bytes = 0

    def add(self, batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        low = LOWER[data]
        starts, ends, first = words(low, offsets, LETTERS)
        n = np.diff(first)
        lang = np.array([self.langs.setdefault(x, len(self.langs)) for x in batch.column("lang").to_pylist()], np.int64)
        # The same word of two languages is two terms.
        salt = mix(lang.astype(U64) + U64(1))
        self.hashes.append(mix(word_hashes(low, starts, ends) + np.repeat(salt, n)))
        self.text_of.append(np.repeat(np.arange(self.texts, self.texts + len(n), dtype=np.int32), n))
        # Words are every other one of the spans between all starts and ends.
        cuts = np.empty(2 * len(starts), np.int32)
        cuts[::2], cuts[1::2] = starts, ends
        spans = pa.Array.from_buffers(pa.binary(), max(0, len(cuts) - 1), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(low))])
        self.strings.append(spans)
        self.lang_of.append(lang)
        sizes = batch.column("gs").value_lengths().to_numpy(zero_copy_only=False)
        self.parts.append((sizes, batch.column("gs").flatten().to_numpy(), batch.column("ns").flatten().to_numpy()))
        self.texts += len(n)
        self.bytes += len(data)

    def summed(self) -> pa.RecordBatch:
        h, text = np.concatenate(self.hashes), np.concatenate(self.text_of)
        sizes, g, n = (np.concatenate(x).astype(np.int64) for x in zip(*self.parts))
        to = np.append(0, np.cumsum(sizes))
        copies = np.add.reduceat(n, to[:-1]) if len(n) else n
        order = np.lexsort((text, h))
        h, text = h[order], text[order]
        new_term = np.append(True, h[1:] != h[:-1])[: len(h)]
        new_pair = np.append(True, new_term[1:] | (text[1:] != text[:-1]))[: len(h)]
        at = np.flatnonzero(new_pair)
        tf = np.diff(np.append(at, len(h)))
        term, text = (np.cumsum(new_term) - 1)[at], text[at]
        n_terms = int(new_term.sum())
        docs = np.zeros(n_terms, np.int64)
        np.add.at(docs, term, copies[text])
        # A text counts for every source that has it.
        each, owner = ranges(to[text], to[text + 1] - 1)
        key = term[owner] << 32 | g[each]
        count = tf[owner] * n[each]
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        count = np.add.reduceat(count, begin) if len(begin) else count
        key = key[begin]
        lists = np.append(0, np.cumsum(np.bincount(key >> 32, minlength=n_terms))).astype(np.int32)
        gs = pa.ListArray.from_arrays(pa.array(lists), pa.array((key & 0xFFFFFFFF).astype(np.int32)))
        ns = pa.ListArray.from_arrays(pa.array(lists), pa.array(count))
        return pa.RecordBatch.from_arrays([*self._names(h, new_term), pa.array(docs), gs, ns], names=["lang", "term", "docs", "gs", "ns"])

    def _names(self, h: np.ndarray, new_term: np.ndarray) -> list[pa.Array]:
        """Language and spelling of every different term, from one place where it stands."""
        known = h[new_term]
        place = np.zeros(len(known), np.int64)
        place[np.searchsorted(known, np.concatenate(self.hashes))] = np.arange(len(h))
        first = np.append(0, np.cumsum([len(x) for x in self.hashes]))
        part = np.searchsorted(first, place, "right") - 1
        order = np.argsort(part, kind="stable")
        to = np.searchsorted(part[order], np.arange(len(self.hashes) + 1))
        found = [self.strings[k].take(pa.array(2 * (place[order[to[k] : to[k + 1]]] - first[k]))) for k in range(len(self.hashes)) if to[k + 1] > to[k]]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        spelled = pa.concat_arrays(found).take(pa.array(back)) if found else pa.array([], pa.binary())
        lang = np.concatenate(self.lang_of)[np.concatenate(self.text_of)[place]]
        return [pa.array(list(self.langs), pa.string()).take(pa.array(lang)), spelled.cast(pa.string())]


def term_counts(texts: DataFrame, at_once: int = 1 << 24) -> DataFrame:
    """``(lang, term, docs, gs, ns)``: documents with the term and its occurrences by source.

    Each different text is cut into terms once, and every term weighed by the copies of the text. One row for a term
    and about ``at_once`` bytes of texts of a task: rows of one term must still be added.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for batch, data, offsets in pieces(batches):
            held.add(batch, data, offsets)
            if held.bytes >= at_once:
                yield held.summed()
                held = _Held()
        if held.texts:
            yield held.summed()

    return texts.mapInArrow(rows, "lang string, term string, docs long, gs array<int>, ns array<long>")


def _share(n: str, total: str = "total", terms: str = "v") -> Column:
    """A smoothed share in whole billionths, rounded down; exact for any count, null where there are no terms."""
    under = f"nullif(cast({total} as decimal(20,0)) + {PRIOR} * {terms}, cast(0 as decimal(1,0)))"
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({n} + {PRIOR} as decimal(20,0))) div cast({under} as decimal(20,0))")


def _named(df: DataFrame, side: str) -> DataFrame:
    """The columns with a suffix, but for the language and the term."""
    return df.select(*[F.col(c) if c in ("lang", "term") else F.col(c).alias(f"{c}_{side}") for c in df.columns])


def _distances(own: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: the sum over all kept terms of the distance of two sources' shares.

    Only terms that occur are touched. All terms of a language are first taken as missing in both
    sources. A term of one source corrects that once, by its share alone (terms with an equal share
    count as one row); a term of both corrects it again by what the two have together.
    """
    other = _named(groups, "b").where("source_b is not null")
    base = _named(groups, "a").join(other, "lang").where("source_a <> source_b")
    base = base.select("lang", "source_a", "source_b", (F.col("v_a") * F.abs(F.col("p0_a") - F.col("p0_b"))).alias("value"))

    shares = own.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("k"))
    alone = _named(shares, "a").join(other, "lang").where("source_a <> source_b")
    alone = alone.select("lang", "source_a", "source_b", F.expr("k_a * (abs(p_a - p0_b) - abs(p0_a - p0_b))").alias("value"))
    alone = alone.groupBy("lang", "source_a", "source_b").agg(F.sum("value").alias("value"))

    both = _named(own, "a").join(_named(own, "b"), ["lang", "term"]).where("source_a < source_b")
    extra = F.expr("abs(p_a - p_b) - abs(p_a - p0_b) - abs(p0_a - p_b) + abs(p0_a - p0_b)")
    both = both.groupBy("lang", "source_a", "source_b").agg(F.sum(extra).alias("value"))

    mirrored = ["lang", F.col("source_b").alias("source_a"), F.col("source_a").alias("source_b"), "value"]
    parts = base.unionByName(alone).unionByName(alone.select(*mirrored)).unionByName(both).unionByName(both.select(*mirrored))
    return parts.groupBy("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item")).agg(F.coalesce(F.sum("value"), F.lit(0).cast("long")).alias("value"))


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 30, ranks: int = 50) -> DataFrame:
    """How far the sources of each language differ in their words, and by which.

    Terms are runs of letters (ASCII letters, A-Z in lower case, and all characters beyond ASCII). A language
    keeps the terms of at least ``least_docs`` of its documents. A share is ``1 + floor(10^9 (count + 5) / (N + 5 V))``,
    ``N`` a group's occurrences of kept terms and ``V`` their number.

    Part ``pair``: the summed distance of a source's shares to every other source's, all ranks. Part ``term``: the
    kept terms that a source has more of than its language has, with the difference, up to rank ``ranks``.
    Equal values are ordered by the bytes of the item. A null text, language or source is the empty string; rows that
    are equal count as often as they occur; a group without terms has pairs, but no terms; an empty table gives no
    row. Other columns are not read. Returns ``(lang, source, part, item, value, rank)``.
    """
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    texts, occurring = collapsed(small_batches(named))
    every = F.sum("docs").over(W.partitionBy("lang", "term"))
    counts = term_counts(texts).withColumn("every", every).where(F.col("every") >= least_docs)
    counts = counts.select("lang", "term", F.explode(F.arrays_zip("gs", "ns")).alias("x")).groupBy("lang", "term", F.col("x.gs").alias("g")).agg(F.sum("x.ns").alias("n"))
    own = stored(counts.join(occurring, ["lang", "g"]).select("lang", "source", "term", "n"), "audit-kept")

    kept = own.select("lang", "term").distinct()
    v = kept.groupBy("lang").agg(F.count("*").alias("v"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = occurring.drop("g").join(totals, ["lang", "source"], "left").join(v, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("v", zero).alias("v"))
    groups = stored(groups.withColumn("p0", _share("0")), "audit-groups")

    own = own.join(groups, ["lang", "source"]).withColumn("p", _share("n"))
    of_lang = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    usual = own.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.first("v").alias("lang_v")).join(of_lang, "lang")
    usual = usual.select("lang", "term", _share("lang_n", "lang_total", "lang_v").alias("q"))
    terms = own.join(usual, ["lang", "term"]).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    pairs = _distances(own.select("lang", "term", "source", "p", "p0"), groups.select("lang", "source", "v", "p0"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).where(F.col("rank") <= ranks))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))
