"""The pipeline's near-dedup stage comes through SimHash links, and the line operators keep the plan's table of words short."""

import random

from canvass.llm.line_dedup import _rarity
from canvass.llm.near_dedup import linked_pairs, near_dedup
from canvass.llm.simhash import simhash_groups
from canvass.llm.store import keyed
from pyspark.sql import functions as F


def test_links_are_those_of_the_fingerprints(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(900)}" for _ in range(400)]
    texts = [" ".join(base)] + [" ".join([*base[:k], f"new{k}", *base[k + 1 :]]) for k in rng.sample(range(400), 30)]
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(80)) for _ in range(20)] + ["", "one word"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    classes = keyed(table).select(F.col("id").alias("c"), F.struct("id", "row").alias("place"))
    groups = {r.doc_id: r.component_id for r in simhash_groups(table, shingle=5, threshold=2).collect()}
    want = sorted((i, first) for i, first in groups.items() if i != first)
    assert len(want) > 10
    found = linked_pairs(keyed(table), classes, 5, 2)
    assert sorted((r.later, r.earlier) for r in found.collect()) == want
    # A link alone removes nothing: it is verified, and a lower threshold changes no result.
    kept = [sorted(r.doc_id for r in near_dedup(table, threshold=bits).collect()) for bits in (0, 2)]
    assert kept[0] == kept[1]


def test_white_space_and_table_of_words(spark):
    from canvass.llm.line_dedup import kept_lines

    docs = spark.createDataFrame([(1, "a b c\r\n\t b\x0ba \x0c c\r\nd"), (2, "c\tb a\n \t\x0c\nd e")], "doc_id long, text string")
    rows = kept_lines(keyed(docs)).collect()
    assert sorted((r.id, r.line) for r in rows) == [(1, 0), (1, 2), (2, 2)]
    plan = keyed(docs).select(_rarity(keyed(docs)).alias("r"))._jdf.queryExecution().toString()
    assert len(plan) < 1_500_000
