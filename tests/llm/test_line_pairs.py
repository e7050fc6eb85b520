"""The line join pairs by size and makes no second pass over all tokens for what seems similar in a small group only."""

import random
from fractions import Fraction

from canvass.llm.line_dedup import MANY, kept_lines, later_similar
from canvass.llm.store import keyed
from pyspark.sql import functions as F

T = Fraction(4, 5)


def similar_to_earlier(rows: list[tuple[int, str]], t: Fraction = T) -> set[int]:
    sets = [(i, set(text.split())) for i, text in sorted(rows)]
    return {i for k, (i, a) in enumerate(sets) for _, b in sets[:k] if len(a & b) * t.denominator >= len(a | b) * t.numerator}


def test_small_groups_are_verified_in_one_pass(spark):
    """Sets with equal sketches that are not similar, of one token."""
    rows = [(c, (c, 0, 0), 10, 0, [7, 100 + c], 5 if c == 0 else 1) for c in range(6)]
    kind = "c long, place struct<id: long, row: long, line: int>, n int, bits long, prefix array<int>, rows long"
    asked = []

    def verified(pairs, places):
        asked.append((sorted((r.later, r.earlier) for r in pairs.collect()), sorted(r.c for r in places.select("c", "place").collect())))
        return pairs.select("later", "earlier", "star", F.lit(False).alias("ok"))

    assert later_similar(spark.createDataFrame(rows, kind), T, verified).collect() == []
    assert asked == [([(c, e) for c in range(6) for e in range(c)], list(range(6)))]


def test_near_copies_of_many_sizes(spark):
    """More lines of a token than one class answers for, shorter and longer ones in any order, some at the very limit."""
    chance = random.Random(5)
    base = [f"word{k}" for k in range(40)]
    lines = []
    for k in range(4 * MANY):
        left = chance.sample(base, chance.choice([40, 39, 36, 32, 31, 26]))
        lines.append(" ".join(["rare", *left, *[f"odd{k}x{j}" for j in range(chance.choice([0, 0, 1, 4, 9]))]]))
    lines += [" ".join(f"w{j}" for j in range(n)) for n in (4, 5, 8, 10, 12, 15, 16, 20, 25, 31, 39, 40, 50)]
    lines += chance.sample(lines, MANY)
    chance.shuffle(lines)
    rows = list(enumerate(lines))
    for t in (0.8, 0.6, 1.0):
        found = kept_lines(keyed(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)), t)
        assert {r.id for r in found.collect()} == set(range(len(rows))) - similar_to_earlier(rows, Fraction(t).limit_denominator(1000))


def test_a_hot_token_with_copies_of_a_null_id(spark):
    words = [f"w{k}" for k in range(30)]
    rows = [(None, " ".join(words)), (None, " ".join(words))] + [(i, " ".join(["hot", *words[i % 7 :], f"x{i}"])) for i in range(2 * MANY)]
    found = kept_lines(keyed(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    later = {i + 1 for i in similar_to_earlier([(-1, rows[0][1])] + [(i, text) for i, text in rows[2:]])}
    assert sorted(-1 if r.id is None else r.id for r in found) == [i for i in range(-1, 2 * MANY) if i + 1 not in later]
