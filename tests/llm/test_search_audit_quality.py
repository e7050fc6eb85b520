"""Ranked search, divergence audit and quality classifier on rows with gaps, against brute force."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from canvass.llm.divergence import divergence
from canvass.llm.factorization import Features, Machine, quality_scores
from canvass.llm.lexical_search import Queries, Segment, best_blocks, candidates, search

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


DOCS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \n\t ", None, None),
    (4, "one two three", "en", None),
    (5, "One two, two! Ünï 7 ʃʃ", "en", "b"),
    (6, "one two three", "en", "c"),
    (6, "one two three", "en", "c"),
    (None, "one two three four", "fr", "a"),
    (8, "two " * 400, "fr", "b"),
    (9, LONG, "en", "a"),
    (10, LONG + " one", "de", "only"),
    (11, "...\x00-- ## 12 _", "de", "other"),
    *[(100 + i, f"one word{i % 7} two{i % 3} three\nmore w{i}", "en", "abc"[i % 3]) for i in range(120)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, g, s, None if t is None else len(t), k, "x", [k]) for k, (i, t, g, s) in enumerate(DOCS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id int, term string, rows array<int>").repartition(5)


def ranked(docs, items, top=20):
    bags = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = set()
    for item, text in set(items):
        asked = Counter(TERM.findall(lower(text)))
        scores = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // n_words
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t, k in asked.items() if t in b)
            if s > 0:
                scores.append((-s, i is not None, i or 0))
        out |= {(item, r, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(scores)[:top], 1)}
    return out


ITEMS = [("a", "One two THREE four"), ("b", None), ("c", "nothing here"), ("d", "word1 word2 w17 w17 w17 two1"), ("e", "w3x3 w4x4 ünï"), (None, "more w5"), ("a2", "one " * 50), ("a2", "one " * 50)]


def test_search_with_gaps(spark, docs):
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id string, text string, doc_id string, score int")
    want = ranked([(i, t) for i, t, _, _ in DOCS], ITEMS)
    got = search(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == want
    # A few items at a time, and fewer ranks.
    got = search(docs, items, top=3, items_at_once=2)
    assert {tuple(r) for r in got.collect()} == ranked([(i, t) for i, t, _, _ in DOCS], ITEMS, 3)


def test_search_of_empty_tables(spark, docs):
    items = spark.createDataFrame([("a", "one")], "item_id string, text string")
    assert search(docs.limit(0), items).collect() == []
    assert search(docs, items.limit(0)).collect() == []
    assert search(docs.where("doc_id < 4"), items).collect() == []


def test_blocks_are_skipped_but_nothing_is_lost():
    chance = np.random.default_rng(5)
    groups = chance.integers(0, 40, 1024)  # documents of forty subjects
    own = [np.unique(chance.integers(10 * k, 10 * k + 10, 5)) for k in range(1, 9)] + [np.unique(chance.integers(0, 440, 12))]
    terms = [np.unique(np.concatenate([chance.integers(400 - 10 * g, 410 - 10 * g, 6), chance.integers(400, 440, 6)])) for g in groups]
    terms = [t[np.isin(t, np.concatenate(own))] for t in terms]
    begin = np.append(0, np.cumsum([len(t) for t in terms])).astype(np.int32)
    impact = chance.integers(1, 1_000_000, begin[-1]).astype(np.int32)
    segment = Segment(begin, np.concatenate(terms).astype(np.int32), impact)
    queries = Queries(own, [np.sort(chance.integers(1, 9000, len(t)))[::-1] for t in own])
    blocks = segment.blocks(queries)
    every = {q: segment.scores(queries, q, np.arange(1024)) for q in range(len(own))}
    best = dict(best_blocks(segment, queries, blocks))
    assert all(set(best[q]) <= set(every[q]) for q in best)
    least = np.array([np.sort(every[q])[-3] for q in every], float)
    read = 0
    for q, found, scores in candidates(segment, queries, blocks, least):
        read += len(found)
        assert (scores == every[q][found]).all()
        assert set(np.flatnonzero(every[q] >= max(least[q], 1))) <= set(found)
    assert 0 < read < 0.5 * sum((v > 0).sum() for v in every.values())
    # Every bound holds for each document of its block whose heaviest shared term is the list's.
    heaviest = {q: [next((t for t in own[q] if t in set(terms[d])), None) for d in range(1024)] for q in every}
    for (asking, members, block, bound), t in zip(segment.bounds(queries, blocks), segment.columns):
        for i, q in enumerate(asking):
            for d, k in zip(members, block):
                if heaviest[q][d] == t:
                    assert every[q][d] <= bound[k, i]


def audited(docs, least=30, ranks=50):
    docs = [(g or "", s or "", LETTERS.findall(lower(t))) for _, t, g, s in docs]
    df = Counter((g, t) for g, _, ts in docs for t in set(ts))
    kept = defaultdict(set)
    for (g, t), n in df.items():
        if n >= least:
            kept[g].add(t)
    count, of_lang = defaultdict(Counter), defaultdict(Counter)
    for g, s, ts in docs:
        own = [t for t in ts if t in kept[g]]
        count[g, s].update(own)
        of_lang[g].update(own)

    def share(c, g):
        n, v = sum(c.values()), len(kept[g])
        return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * v) for t in kept[g]}

    p = {k: share(c, k[0]) for k, c in count.items()}
    out = set()
    for g, s in count:
        q = share(of_lang[g], g)
        pairs = [(-sum(abs(p[g, s][t] - p[g, o][t]) for t in kept[g]), o) for h, o in count if h == g and o != s]
        terms = [(q[t] - p[g, s][t], t) for t in kept[g] if count[g, s][t] and p[g, s][t] > q[t]]
        for part, rows in (("pair", pairs), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:ranks])):
            out |= {(g, s, part, i, -v, r) for r, (v, i) in enumerate(sorted(rows, key=lambda x: (x[0], x[1].encode())), 1)}
    return out


def test_divergence_with_gaps(docs):
    got = divergence(docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in got.collect()} == audited(DOCS)
    assert {tuple(r) for r in divergence(docs, least_docs=2, ranks=3).collect()} == audited(DOCS, 2, 3)


def test_divergence_of_copies_in_many_sources(spark):
    texts = [f"shared words of text {'abcdefghij'[k % 5]} again again" for k in range(200)]
    rows = [(k, t, "en", f"s{k % 9}") for k, t in enumerate(texts)] + [(1000 + k, "one hot text that all have", "en", f"s{k % 11}") for k in range(300)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6)
    assert {tuple(r) for r in divergence(given).collect()} == audited(rows)


def test_divergence_of_nothing(docs):
    assert divergence(docs.limit(0)).collect() == []
    assert {tuple(r) for r in divergence(docs.where("doc_id < 4")).collect()} == audited(DOCS[:3])


def test_machine_sums_all_pairs():
    chance = np.random.default_rng(3)
    text = "alpha beta beta gamma\nDELTA ## one two".encode()
    x = Features.of(np.frombuffer(text + b"", np.uint8), np.array([0, len(text), len(text)]), [np.array([7.0, -1.0])])
    n = Features.slots(1)
    machine = Machine(0.3, chance.normal(size=n), chance.normal(size=(n, 4)))
    for d in range(2):
        word = range(x.first[d], x.first[d + 1])
        own = [(x.word[i], x.weight[i]) for i in word] + [(s, 1.0) for s in x.other[d]]
        want = 0.3 + sum(machine.linear[s] * w for s, w in own)
        want += sum(machine.factors[a] @ machine.factors[b] * v * w for (a, v), (b, w) in itertools.combinations(own, 2))
        assert machine.parts(x)[0][d] == pytest.approx(want)


def test_quality_learns_and_never_reads_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in quality_scores(docs, labels).collect()}
    told = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = {i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {i for i, r in rows.items() if r["held_out"]} == held
    right = [rows[i]["predicted"] == q for i, q in told.items() if i in held and i in rows]
    assert len(right) > 50 and np.mean(right) > 0.95
    # Other labels of held-out rows, other languages and sources change nothing.
    turned = labels.selectExpr("doc_id", "case when pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2 then 1 - quality else quality end as quality")
    again = quality_scores(docs.selectExpr("doc_id", "text", "'x' as lang", "'y' as source", "n_chars"), turned)
    assert {r["doc_id"]: r["score"] for r in again.collect()} == {i: r["score"] for i, r in rows.items()}


def test_quality_with_gaps(spark, docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (6, None, 0), (None, 1, 0), (999, 0, 0), (8, 0, 1)], "doc_id long, quality int, toxic int")
    got = quality_scores(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, *_ in DOCS)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert quality_scores(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in quality_scores(docs.drop("n_chars"), labels.limit(0)).collect()} and len(rows) == len(DOCS)
