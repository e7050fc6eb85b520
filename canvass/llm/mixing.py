"""Mixing sources to target weights by min-cost flow over membership patterns."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from canvass.llm.store import documents, keyed, stored

LEVELS, LEVEL_BITS = 3, 12


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], total: float, most: float) -> dict[str | None, float]:
    """Share ``total`` out by weight; no target above ``most`` times its source's size, the excess shared again."""
    given: dict[str | None, float] = {}
    open_ = dict(weights)
    while open_:
        rest, weight = total - sum(given.values()), sum(open_.values())
        share = {s: rest * w / weight for s, w in open_.items()}
        full = [s for s in open_ if share[s] > most * sizes[s]]
        if not full:
            return given | share
        for s in full:
            given[s] = float(most * sizes[s])
            del open_[s]
    return given


class _Network:
    """Maximum flow by shortest augmenting levels; capacities may be raised between calls."""

    def __init__(self, nodes: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def arc(self, a: int, b: int, room: int) -> int:
        for x, y, r in ((a, b, room), (b, a, 0)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
        return len(self.to) - 2

    def augment(self, source: int, sink: int) -> None:
        while True:
            depth = {source: 0}
            queue = deque([source])
            while queue:
                a = queue.popleft()
                for arc in self.out[a]:
                    if self.room[arc] and self.to[arc] not in depth:
                        depth[self.to[arc]] = depth[a] + 1
                        queue.append(self.to[arc])
            if sink not in depth:
                return
            tried = [0] * len(self.out)
            while self._push(source, sink, depth, tried):
                pass

    def _push(self, source: int, sink: int, depth: dict[int, int], tried: list[int]) -> int:
        path, at = [], source
        while at != sink:
            while tried[at] < len(self.out[at]):
                arc = self.out[at][tried[at]]
                if self.room[arc] and depth.get(self.to[arc]) == depth[at] + 1:
                    path.append(arc)
                    at = self.to[arc]
                    break
                tried[at] += 1
            else:
                if not path:
                    return 0
                at = self.to[path.pop() ^ 1]
                tried[at] += 1
        flow = min(self.room[arc] for arc in path)
        for arc in path:
            self.room[arc] -= flow
            self.room[arc ^ 1] += flow
        return flow


def routed(patterns: dict[tuple, int], goals: dict[str | None, float], copies: int) -> dict[tuple, int]:
    """How many words to take of the documents of each membership pattern.

    A flow of least cost from patterns to sources: the first copy of a word costs nothing,
    each further one more than the one before. Costs sit on the patterns alone, so filling
    the network copy by copy, each time up to the largest flow, is the cheapest of the
    largest flows.
    """
    names, sources = list(patterns), list(goals)
    net = _Network(len(names) + len(sources) + 2)
    source, sink = len(names) + len(sources), len(names) + len(sources) + 1
    place = {s: len(names) + k for k, s in enumerate(sources)}
    entry = []
    for k, name in enumerate(names):
        entry.append(net.arc(source, k, 0))
        for s in name:
            net.arc(k, place[s], copies * patterns[name])
    for s in sources:
        net.arc(place[s], sink, round(goals[s]))
    for _ in range(copies):
        for k, name in enumerate(names):
            net.room[entry[k]] += patterns[name]
        net.augment(source, sink)
    return {name: net.room[entry[k] ^ 1] for k, name in enumerate(names)}


def _selected(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents with ``part``: the share of an extra copy each gives, in words.

    Within a pattern documents are ordered by a seeded hash and taken until ``rest`` words
    are reached. The place where that happens is found by sums over ever finer hash ranges,
    so no pattern is ever ordered as a whole. Rows that even the last range does not tell
    apart give equal shares; a single one is taken or left, whichever is nearer.
    """
    # One row for each pattern, which the driver has had already.
    at = sized.join(F.broadcast(plan), "pattern").withColumn("part", F.when(F.col("rest") <= 0, F.lit(0).cast("long")))
    for level in range(LEVELS):
        slot = F.shiftrightunsigned("hash", 64 - LEVEL_BITS * (level + 1)).bitwiseAND((1 << LEVEL_BITS) - 1)
        at = at.withColumn("slot", slot)
        sums = at.where("part is null").groupBy("pattern", "slot")
        sums = sums.agg(F.sum("size").alias("words"), F.count("*").alias("rows"), F.first("rest").alias("goal"))
        sums = sums.withColumn("upto", F.sum("words").over(W.partitionBy("pattern").orderBy("slot")))
        edge = sums.withColumn("left", F.col("goal") - (F.col("upto") - F.col("words"))).where("left >= 0 and goal < upto")
        edge = edge.select(F.col("pattern").alias("p"), F.col("slot").alias("s"), "left", "words", "rows")
        found = at.join(F.broadcast(edge), F.col("pattern") == F.col("p"), "left")
        part = F.when(F.col("part").isNotNull(), F.col("part")).when(F.col("slot") < F.col("s"), F.col("size"))
        part = part.when(F.col("slot") > F.col("s"), F.lit(0).cast("long"))
        if level == LEVELS - 1:
            nearer = F.when(2 * F.col("left") >= F.col("size"), F.col("size")).otherwise(0)
            part = part.otherwise(F.when(F.col("rows") > 1, F.floor(F.col("size") * (F.col("left") / F.col("words")))).otherwise(nearer).cast("long"))
        at = found.withColumn("part", part).withColumn("rest", F.when(F.col("part").isNull(), F.col("left")).otherwise(F.col("rest")))
        at = at.drop("p", "s", "words", "rows", "left")
    return at


def mix_sources(
    docs: DataFrame,
    sources: Column,
    weights: Callable[[list[str | None]], dict[str | None, float]],
    total: float = 1.5,
    copies: int = 2,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """How many words a mix takes of every document.

    ``sources`` is an array column: a document may belong to several sources, or to the
    source null. ``weights`` gives each source its weight, in the order of code points with
    null last. Together the sources get ``total`` times the words of all documents, none
    more than ``copies`` times its own.

    Documents are summed up by the set of sources they belong to, and the words of each set
    are routed to the sources' targets so that repeats are fewest. The number of such sets
    is a matter of how sources are defined, not of the amount of data; only their sums come
    to the driver. Documents are then chosen by a seeded hash of id and text: reruns agree.

    Returns ``(id_col, row, size, sources, taken)``, one row for each input row, and
    ``(source, source_size, target)``. ``size`` is the number of words between ASCII white
    space (null: 0). Rows alike in id, text and sources get equal numbers of words. Without
    rows there is no target.
    """
    text_words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    pattern = F.to_json(F.array_sort(F.array_distinct(sources)))
    kept = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("row"),
        pattern.alias("pattern"),
        text_words.alias("size"),
    )
    sized = stored(kept.withColumn("hash", F.xxhash64(F.col("id").cast("string"), "row", F.lit(seed))), "sizes")
    sums = {tuple(json.loads(r["pattern"])): (r["pattern"], r["words"]) for r in sized.groupBy("pattern").agg(F.sum("size").alias("words")).collect()}
    own: dict[str | None, int] = {}
    for names, (_, n) in sums.items():
        for s in names:
            own[s] = own.get(s, 0) + n
    order = sorted(own, key=lambda s: (s is None, s or ""))
    goals = targets(own, weights(order), total * sum(n for _, n in sums.values()), copies)
    flow = routed({names: n for names, (_, n) in sums.items()}, goals, copies)
    rows = [(key, *(divmod(flow[names], n) if n else (0, 0))) for names, (key, n) in sums.items()]
    spark = docs.sparkSession
    plan = spark.createDataFrame(rows, "pattern string, full long, rest long")
    goal = spark.createDataFrame([(s, own[s], goals[s]) for s in order], "source string, source_size long, target double")
    out = _selected(sized, plan).withColumn("taken", F.col("full") * F.col("size") + F.col("part"))
    named = F.transform(F.from_json("pattern", "array<string>"), lambda s: s)
    out = out.withColumn("sources", named).select("id", "row", "size", "sources", "taken")
    return out.withColumnRenamed("id", id_col), goal


def _repeating(order: list[str | None]) -> dict[str | None, float]:
    return {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(order)}


def mixed(docs: DataFrame) -> DataFrame:
    """Every document with its size, its source's size and target, and the words taken; weights 3, 1, 2."""
    out, goal = mix_sources(docs, F.array(F.col("source").cast("string")), _repeating)
    out = out.withColumn("source", F.col("sources")[0])
    goal = goal.withColumnRenamed("source", "goal_source")
    return out.join(F.broadcast(goal), out["source"].eqNullSafe(goal["goal_source"])).drop("goal_source")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents the mix takes words of, all columns, with ``taken`` beside them.

    The columns ``doc_id``, ``text`` and ``source`` are read by these names; a column of the input that is itself named
    ``taken`` is replaced. Rows equal in id and text are one document and take the same.
    """
    taken = mixed(docs).where("taken > 0").groupBy("doc_id", "row").agg(F.max("taken").alias("taken"))
    taken = taken.withColumnsRenamed({"doc_id": "mix_id", "row": "mix_row"}).hint("shuffle_hash")
    same = docs["doc_id"].eqNullSafe(taken["mix_id"]) & (F.xxhash64(docs["text"]) == taken["mix_row"])
    return docs.join(taken, same).select(*[docs[c] for c in docs.columns if c != "taken"], taken["taken"])


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
