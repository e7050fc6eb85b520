"""Line dedup by an exact set-similarity join, in DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from canvass.llm.repeats import with_lists
from canvass.llm.store import documents, drop_stored, keyed, stored_lean

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
RARITY_SLOTS = 1 << 16
FEW = 1 << 16  # rows of numbers that are sent to all tasks; more are shuffled
FEW_PLACES = 1 << 13  # the same for places with their numbers in lists
MANY = 32  # from so many classes of a token and band on, one of them answers for those that seem similar to it
LONG_LINE = 96  # words; from here on a sketch of 64 bits says little, and a line has one of 128


def _tokens(line: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(line, SPACE), ""))


def _lines(text: Column) -> Column:
    """The lines of a text, with blanks for its other white space, so that words are split at one character, not by an expression."""
    return F.split(F.when(text.rlike(r"[\x09\x0B-\x0D]"), F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text), "\n")


def _rarity(docs: DataFrame) -> Column:
    """How common words are, as an array over ``RARITY_SLOTS`` hash slots; counted over all words.

    The order of words only has to be the same everywhere. So a slot may hold several words,
    and the table has one size for any corpus.
    """
    word = docs.select(F.explode(_lines(F.col("text"))).alias("body")).select(F.explode(F.split("body", " ")).alias("w")).where("w <> ''")
    slots = word.groupBy(F.xxhash64("w").bitwiseAND(RARITY_SLOTS - 1).alias("slot")).count()
    steps = [0] * RARITY_SLOTS
    for slot, n in slots.select("slot", F.floor(2 * F.log2("count")).cast("int")).collect():
        steps[slot] = n
    # Every description of a plan on the driver repeats this table, so its numbers are short.
    return F.from_json(F.lit(f"[{','.join(map(str, steps))}]"), "array<tinyint>")


def _ranked(line: Column, rarity: Column) -> Column:
    """The different words of a line of ``_lines`` as numbers that sort from rare to common.

    Words are told apart by their hashes. Without a null among them Spark sorts numbers as such.
    """

    def number(h: Column) -> Column:
        step = F.coalesce(F.get(rarity, h.bitwiseAND(RARITY_SLOTS - 1).cast("int")), F.lit(0).cast("tinyint")).cast("long")
        return F.call_function("shiftleft", step, F.lit(56)).bitwiseOR(h.bitwiseAND((1 << 56) - 1))

    hashes = F.array_except(F.transform(F.split(line, " "), lambda x: F.xxhash64(x)), F.array(F.xxhash64(F.lit(""))))
    return F.sort_array(F.transform(hashes, number))


def _similar(t: Fraction, n: Column, m: Column, i: Column, j: Column, a: Column, b: Column) -> Column:
    """Whether two lines may be similar that have their first common token at ``i`` and ``j``.

    Similar sets differ by no more than ``most`` tokens. Those before ``i`` and ``j`` differ,
    and so does what is longer after them. The bits of two sketches differ no more often
    than the sets do.
    """
    p, q = t.denominator - t.numerator, t.denominator + t.numerator
    most = (n + m) * p
    differ = i + j + F.abs((n - i) - (m - j))
    return (differ * q <= most) & (F.bit_count(a.bitwiseXOR(b)) * q <= most)


def _verified(docs: DataFrame, pairs: DataFrame, places: DataFrame, t: Fraction) -> DataFrame:
    """Whether the token sets of the lines with the numbers ``later`` and ``earlier`` have Jaccard similarity ``t`` or more.

    ``places`` has the number ``c`` and the ``place`` of each line of the pairs. Only the word sets of these lines are sent, not their
    documents, if their places can go to all tasks.
    """
    lists = places.select("place.id", "place.row", F.struct("place.line", "c").alias("line")).groupBy("id", "row")
    lists = lists.agg(F.map_from_entries(F.collect_list("line")).alias("numbers"))
    found = with_lists(docs, lists if places.count() > FEW_PLACES else F.broadcast(lists), "inner", few=True)
    # Lines are picked before they become rows, so that no row holds a whole text.
    lines = F.transform(_lines(F.col("text")), lambda x, k: F.struct(F.try_element_at("numbers", k).alias("c"), x.alias("body")))
    found = found.select(F.explode(F.filter(lines, lambda x: x["c"].isNotNull())).alias("line"))
    sets = found.select("line.c", F.array_distinct(F.array_remove(F.split("line.body", " "), "")).alias("set"))
    both = pairs.join(sets.select(F.col("c").alias("later"), F.col("set").alias("a")), "later")
    both = both.join(sets.select(F.col("c").alias("earlier"), F.col("set").alias("b")), "earlier")
    common = F.size(F.array_intersect("a", "b"))
    union = F.size("a") + F.size("b") - common
    return both.select("later", "earlier", "star", (common * t.denominator >= union * t.numerator).alias("ok"))


def later_similar(classes: DataFrame, t: Fraction, verified: Callable[[DataFrame, DataFrame], DataFrame], linked: DataFrame | None = None) -> DataFrame:
    """``later``: the numbers of token sets that are similar to an earlier one.

    ``classes`` has a row for each different set: its number ``c`` in the order of places, ``place``,
    size ``n``, sketch ``bits``, ``prefix`` of rarest tokens, how many ``rows`` have it, and, if there is that column, for long
    sets the ``half`` of the sketch that every other token makes. ``verified`` says of
    pairs ``(later, earlier, star)`` whether they are similar; it is given ``c`` and ``place`` of each class in them, too.
    ``linked`` are pairs ``(later, earlier)`` that seem similar to another method: they are verified first, and what is
    later in a similar one is not looked at again, but as an earlier set.
    """

    def checked_pairs(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("later").alias("c")).union(pairs.select("earlier")).distinct()
        wanted = stored_lean(classes.select("c", "place").join(wanted, "c"), "line-places")
        return verified(pairs, wanted)

    open_ = []
    if linked is not None:
        known = stored_lean(checked_pairs(linked.select("later", "earlier", F.lit(False).alias("star"))).where("ok").select("later").distinct(), "line-known")
        classes = classes.join(known.withColumnRenamed("later", "known"), F.col("c") == F.col("known"), "left").withColumn("open", F.col("known").isNull())
        open_ = ["open"]

    # Classes that share a prefix token. The fullest, else earliest, class of a token answers for
    # the whole token: what seems similar to it and is later is not paired with others yet.
    sketches = [c for c in ("bits", "half") if c in classes.columns]
    each = classes.select(F.posexplode("prefix").alias("i", "token"), "n", *sketches, "c", "rows", *open_).where("token is not null")
    each = each.select("token", "c", *sketches, (F.shiftleft(F.col("n").cast("long"), 32) + F.col("i")).alias("ni"), "rows", *open_)

    def n_(x: str) -> Column:
        return F.shiftright(f"{x}ni", 32)

    def i_(x: str) -> Column:
        return F.col(f"{x}ni").bitwiseAND((1 << 32) - 1)

    def fits(one: str, two: str) -> Column:
        fit = _similar(t, n_(one), n_(two), i_(one), i_(two), F.col(f"{one}bits"), F.col(f"{two}bits"))
        if "half" not in sketches:
            return fit
        own = F.col(f"{one}half").bitwiseXOR(F.col(f"{two}half"))
        other = own.bitwiseXOR(F.col(f"{one}bits")).bitwiseXOR(F.col(f"{two}bits"))
        far = (F.bit_count(own) + F.bit_count(other)) * (t.denominator + t.numerator) > (n_(one) + n_(two)) * (t.denominator - t.numerator)
        return fit & ~F.coalesce(far, F.lit(False))

    def paired() -> DataFrame:
        # Sizes are in bands so wide that a similar larger set is in the band of the smaller one or the next, and rows meet by token
        # and band. Of two sets that fit, the smaller has the token among its first ``n * (1 - t) / (1 + t)``: so much follows from
        # their places and sizes. One side of the join holds these rows only, and the class that answers for others is one of them.
        width = 1.001 * math.log(t.denominator / t.numerator) + 1e-6
        band = F.floor(F.log(n_("").cast("double")) / width)
        small = i_("") * (t.denominator + t.numerator) <= n_("") * (t.denominator - t.numerator)
        key = F.shiftleft(F.col("token").cast("long"), 32)
        group = W.partitionBy("key")
        first = F.when(F.count("*").over(group) >= MANY, F.max(F.when(small, F.struct("rows", (-F.col("c")).alias("d"), "ni", *sketches, "c"))).over(group))
        seen = each.select((key + band).alias("key"), "c", *sketches, "ni", "rows", *open_).repartition("key")
        seen = seen.withColumn("p", first).drop("rows")
        seen = seen.withColumn("star", F.when((F.col("p.c") < F.col("c")) & fits("", "p."), F.col("p.c")))
        # The largest set that a row with this place and size fits.
        most = (n_("") * t.denominator - i_("") * (t.denominator + t.numerator) + F.lit(0.5)) / t.numerator
        bands = F.when(F.floor(F.log(most) / width) > band, F.array(key + band, key + band + 1)).otherwise(F.array(key + band))
        other = each.where(small).select(F.explode(bands).alias("o_key"), *[F.col(c).alias(f"o_{c}") for c in ("c", *sketches, "ni", *open_)])
        other = other.repartition("o_key")
        mine = F.col("c") > F.col("o_c")
        larger = (n_("") > n_("o_")) | ((n_("") == n_("o_")) & mine)
        to_first = F.coalesce(F.col("star") == F.col("o_c"), F.lit(False))
        of_first = F.coalesce(F.col("p.c") == F.col("c"), F.lit(False)) & ~mine
        answered = F.coalesce((F.col("p.c") < F.col("o_c")) & fits("o_", "p."), F.lit(False))
        rest = larger & fits("", "o_") & F.when(mine, F.col("star").isNull()).otherwise(of_first | ~answered)
        found = (to_first & F.col("open")) | (rest & F.when(mine, F.col("open")).otherwise(F.col("o_open"))) if open_ else to_first | rest
        both = seen.join(other, (F.col("key") == F.col("o_key")) & found)
        both = both.select(F.greatest("c", "o_c").alias("later"), F.least("c", "o_c").alias("earlier"), (to_first | of_first).alias("star"))
        return both.groupBy("later", "earlier").agg(F.max("star").alias("star"))

    pairs = stored_lean(paired(), "line-pairs")
    checked = stored_lean(checked_pairs(pairs), "line-checked")
    gone = checked.where("ok").select("later")
    gone = (gone if linked is None else gone.unionByName(known)).distinct()

    # Those that only seemed similar to a token's class are paired with all others after all.
    missed = checked.where("not ok and star").select("later").distinct().join(gone, "later", "left_anti")
    missed = stored_lean(missed.withColumnRenamed("later", "c"), "line-missed")
    if not missed.isEmpty():
        other = each.select(*[F.col(c).alias(f"o_{c}") for c in each.columns])
        lost = stored_lean(each.join(missed, "c", "left_semi"), "line-lost")
        lost = lost if lost.count() > FEW else F.broadcast(lost)
        again = lost.join(other, (F.col("token") == F.col("o_token")) & (F.col("o_c") < F.col("c")) & fits("", "o_"))
        again = again.select(F.col("c").alias("later"), F.col("o_c").alias("earlier"), F.lit(False).alias("star")).distinct()
        again = stored_lean(again.join(checked, ["later", "earlier"], "left_anti"), "line-pairs")
        gone = gone.unionByName(checked_pairs(again).where("ok").select("later")).distinct()
    return gone


def kept_lines(docs: DataFrame, similarity: float = 0.8, least: int = 1) -> DataFrame:
    """Places of judged lines that stay, ``(id, row, line)``."""
    t = Fraction(similarity).limit_denominator(1000)
    lines = docs.select("id", "row", F.posexplode(_lines(F.col("text"))).alias("line", "body"))
    lines = lines.select("id", "row", "line", _ranked(F.col("body"), _rarity(docs)).alias("v"))
    keep = F.ceil(F.size("v") * F.lit(t.numerator) / F.lit(t.denominator)).cast("int")
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int"))
    none = F.lit(0).cast("long")

    even = F.aggregate("v", none, lambda a, x: F.when(x.bitwiseAND(64) == 0, a.bitwiseXOR(bit(x))).otherwise(a))
    half = F.when(F.size("v") >= LONG_LINE, even)
    bits = F.aggregate("v", none, lambda a, x: a.bitwiseXOR(bit(x)))
    prefix = F.transform(F.slice("v", 1, F.size("v") - keep + 1), lambda x: x.bitwiseAND(0x7FFFFFFF).cast("int"))
    lines = lines.select("id", "row", "line", F.size("v").alias("n"), F.xxhash64("v").alias("set"), bits.alias("bits"), half.alias("half"), prefix.alias("prefix"))

    # One row for each token set, with its first place; classes are numbered in the order of places.
    classes = lines.groupBy("set", "n").agg(
        F.min(F.struct("id", "row", "line")).alias("place"), F.count("*").alias("rows"), *[F.first(c).alias(c) for c in ("bits", "half", "prefix")]
    )
    # Not a condition on the words alone: that would be pushed down, and they would be made twice.
    classes = stored_lean(classes.where(F.col("n") * F.least("rows", F.lit(1)) >= max(least, 1)), "line-sets")
    numbered = stored_lean(classes.sort("place.id", "place.row", "place.line").withColumn("c", F.monotonically_increasing_id()), "line-classes")
    drop_stored(classes)

    gone = later_similar(numbered, t, lambda pairs, places: _verified(docs, pairs, places, t))
    return numbered.select("c", "place").join(gone, F.col("c") == F.col("later"), "left_anti").select("place.*")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, least: int = 1) -> DataFrame:
    """Remove every line that is similar to an earlier one, of the same document or another.

    Lines are parted by line feeds, words by ASCII white space. Two lines are similar if
    their sets of words have Jaccard similarity ``similarity`` or more. Earlier means a
    smaller id, then a smaller hash of the text, then a smaller line number; a null id
    comes first. Lines are judged on the input, not on what is left. Lines of fewer than
    ``least`` different words stay; by default every line with a word is judged.

    Words are ordered from rare to common; lines with a common word in their prefixes are
    compared if length, place of that word and a sketch of the set allow it, and then word
    by word. Lines with equal sets are one from the start.

    Returns the documents with the lines left; all other columns come back as they were,
    ``n_chars``, where there is one, counts the new text. A document that loses lines and
    has no word left goes; one that had none before stays as it is. Rows equal in id and
    text are one document and are treated alike.
    """
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("doc"), F.col(id_col).alias("doc_key"), F.col(text_col).alias("body"))
    stay = kept_lines(keyed(docs, id_col, text_col), similarity, least)
    lists = stay.groupBy("id", "row").agg(F.collect_list("line").alias("kept"))
    named = packed.select(F.col("doc_key").alias("id"), F.xxhash64("body").alias("row"), F.col("body").alias("text"), "doc")
    found = with_lists(named, lists, "left")
    kept = F.coalesce("kept", F.array().cast("array<int>"))
    lines = F.split("text", "\n")
    unjudged = (lambda x: ~F.rlike(x, F.lit(WORD))) if least <= 1 else (lambda x: F.size(_tokens(x)) < least)
    left = F.filter(lines, lambda x, i: unjudged(x) | F.array_contains(kept, i))
    out = found.withColumn("left", left).withColumn("all", F.size(lines))
    out = out.withColumn("new", F.when(F.size("left") < F.col("all"), F.array_join("left", "\n")).otherwise(F.col("text")))
    out = out.where("text is null or size(left) = `all` or new rlike '[^\\\\x20\\\\x09-\\\\x0D]'")

    def column(c: str) -> Column:
        if c == text_col:
            return F.col("new").alias(c)
        if c == "n_chars":
            return F.char_length("new").cast(docs.schema[c].dataType).alias(c)
        return F.col(f"doc.{c}")

    return out.select(*[column(c) for c in docs.columns])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stay = kept_lines(keyed(documents(spark, sf_dir)))
    kept = stay.groupBy("id", "row").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("line")), ",").alias("kept_lines"))
    counted = [
        F.when(F.col("text").isNull(), 0).otherwise(F.size("all_lines")).cast("long").alias("n_lines"),
        F.size(F.filter("all_lines", lambda x: F.ltrim(x, F.lit(" \t\x0b\x0c\r")) != "")).cast("long").alias("n_judged"),
    ]
    every = keyed(documents(spark, sf_dir)).select("id", "row", "text", F.split(F.coalesce("text", F.lit("")), "\n").alias("all_lines"))
    every = every.select("id", "row", *counted).alias("d")
    out = every.join(kept.alias("k"), F.col("d.id").eqNullSafe(F.col("k.id")) & (F.col("d.row") == F.col("k.row")), "left")
    return out.select(
        F.col("d.id").alias("doc_id"),
        "n_lines",
        "n_judged",
        (F.col("n_judged") - F.coalesce("n", F.lit(0))).cast("long").alias("n_removed"),
        F.coalesce("kept_lines", F.lit("")).alias("kept_lines"),
    )
