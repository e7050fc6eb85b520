"""Plans and skew: hot groups are salted, small figures broadcast, nothing runs in Python."""

import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from canvass.catalog import QUERIES
from canvass.operators import duplicates, grouping, outliers, summaries, visits

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows sits in one unit and a good part has none."""
    base = spark.range(6000).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 7 != 0, F.concat(F.lit("u"), (F.col("id") % 900).cast("string")))
        .alias("unit"),
        (F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(hours=(F.col("id") * 37 % 2000).cast("int"))).alias("ts"),
        (F.col("id") * 7919 % 11).alias("code"),
    )
    return base.cache()


@pytest.fixture(scope="module")
def by_unit(skewed):
    groups = defaultdict(list)
    for r in skewed.collect():
        groups[r["unit"]].append(r)
    return groups


def test_latest_with_salted_hot_units(skewed, by_unit):
    want = {
        r["key"]: int(r is sorted(rows, key=lambda x: (-x["ts"].timestamp(), x["key"]))[0])
        for rows in by_unit.values()
        for r in rows
    }
    for hot_rows in (0, grouping.HOT_ROWS):
        out = visits.mark_latest(skewed, "unit", "ts", "key", hot_rows=hot_rows)
        assert {r["key"]: r["is_final"] for r in out.collect()} == want
    kept = {r["key"] for r in visits.latest_only(skewed, "unit", "ts", "key").collect()}
    assert kept == {k for k, v in want.items() if v}


def test_attempts_match_a_plain_sort(skewed, by_unit):
    want = {}
    for rows in by_unit.values():
        for i, r in enumerate(sorted(rows, key=lambda x: (x["ts"], x["key"])), start=1):
            want[r["key"]] = i
    for hot_rows in (0, grouping.HOT_ROWS):
        out = visits.number_attempts(skewed, "unit", "ts", "key", hot_rows=hot_rows)
        assert {r["key"]: r["attempt"] for r in out.collect()} == want


def test_a_hot_unit_without_times_is_numbered_by_many_tasks(spark):
    """Half of all rows are one unit, most of them without a time, the others within one hour."""
    start = datetime(2026, 1, 1, 12)
    rows = [(f"k{i * 7919 % 5000:04d}", "hot" if i % 2 else None if i % 10 == 0 else f"u{i % 40}", None if i % 3 else start + timedelta(seconds=i % 900)) for i in range(5000)]
    df = spark.createDataFrame(rows, "key string, unit string, ts timestamp").repartition(7)
    want, units = {}, defaultdict(list)
    for key, unit, ts in rows:
        units[unit].append((ts is None, ts or start, key))
    for own in units.values():
        want.update({key: n for n, (_, _, key) in enumerate(sorted(own), 1)})
    out = visits.number_attempts(df, "unit", "ts", "key", hot_rows=1000, piece_sample=50)
    assert {r["key"]: r["attempt"] for r in out.collect()} == want
    pieces = visits._pieces(df, "unit", F.struct(F.col("ts").isNull().alias("u"), "ts", F.lit(False).alias("n"), "key"), F.xxhash64("key"), 1000, 50).collect()
    assert [(r["unit"], sum(map(len, r["splits"]))) for r in pieces] == [("hot", 49)]
    # A table without a hot unit is numbered in one pass.
    assert "__piece" not in visits.number_attempts(df, "unit", "ts", "key")._jdf.queryExecution().toString()


def test_daily_sketches_merge_to_the_distinct_units(spark):
    """Sketches kept by day and block agree with the exact counts over days, blocks and all, within four standard errors."""
    visits_ = spark.range(60_000).selectExpr(
        "cast(id % 10 as int) as day", "cast(id % 7 as int) as block", "case when id % 50 > 0 then cast(hash(id) % 20000 as string) end as unit"
    )
    daily = summaries.distinct_sketches(visits_, ["day", "block"], "unit")
    assert daily.count() == 70
    for keys in (["day", "block"], ["block"], []):
        exact = {tuple(r[k] for k in keys): r["n"] for r in visits_.groupBy(*keys).agg(F.countDistinct("unit").alias("n")).collect()}
        merged = {tuple(r[k] for k in keys): r["n"] for r in summaries.distinct_of_sketches(daily, keys).collect()}
        assert set(exact) == set(merged)
        assert all(abs(merged[k] - n) <= 0.033 * n + 1 for k, n in exact.items())


def test_quartiles_of_any_shape_are_exact(spark):
    import numpy as np

    chance = np.random.default_rng(2)
    shapes = [
        chance.normal(size=30_000) ** 5,
        np.repeat([0.0, 1.0], [22_500, 7_500]),
        np.append(np.repeat(5.0, 29_000), np.arange(1000) / 7),
        np.exp(chance.normal(size=30_001) * 40),
        np.array([3.0]),
        np.array([2.0, 1.0]),
    ]
    for values in shapes:
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 3, "x double").repartition(5)
        got = summaries.describe_number(df, "x", accuracy=100).collect()[0]
        want = np.percentile(values, [25, 50, 75])
        assert [got["q1"], got["median"], got["q3"]] == pytest.approx(want.tolist(), rel=1e-12)
        assert (got["minimum"], got["maximum"], got["nulls"]) == (values.min(), values.max(), 3)
    assert summaries.describe_number(df.filter("x > 99"), "x").collect()[0]["median"] is None


def test_closure_history_with_salted_hot_units(skewed, by_unit):
    want = {}
    for rows in by_unit.values():
        closed, flags = False, {}
        for r in sorted(rows, key=lambda x: (x["ts"], x["key"])):
            flags[r["key"]] = closed
            closed = closed or r["code"] == 1
        if any(flags.values()):
            want |= flags
    for hot_rows in (0, grouping.HOT_ROWS):
        out = visits.closure_history(
            skewed, "unit", "ts", "key", F.col("code") == 1, hot_rows=hot_rows
        )
        assert {r["key"]: r["closed_before"] for r in out.collect()} == want


def test_matching_and_repeated_history(skewed, by_unit):
    want = {r["key"] for rows in by_unit.values() if any(x["code"] == 3 for x in rows) for r in rows}
    out = visits.history_of_matching(skewed, "unit", "key", F.col("code") == 3, hot_rows=0)
    assert Counter(r["key"] for r in out.collect()) == Counter(want)
    want = {r["key"] for rows in by_unit.values() if len(rows) > 1 for r in rows}
    out = visits.history_of_repeated(skewed, "unit", "key", hot_rows=0)
    assert Counter(r["key"] for r in out.collect()) == Counter(want)


def test_duplicates_with_a_hot_identity(skewed, by_unit):
    want = {
        r["key"]: (None if unit is None else 1) if len(rows) > 1 else 0
        for unit, rows in by_unit.items()
        for r in rows
    }
    out = duplicates.flag_duplicates(skewed, "unit", "key", hot_rows=0)
    assert {r["key"]: r["duplicate"] for r in out.collect()} == want


def test_hot_rows_spread_over_salts(skewed):
    """Rows of the hot unit carry many salts, others one."""
    groups = grouping.group_figures(skewed, ["unit"], {})
    seen = {}
    original = grouping._join_on

    def spy(df, right, keys, how, extra=()):
        seen["salts"] = {
            r["unit"]: r["n"]
            for r in df.groupBy("unit").agg(F.count_distinct("__salt").alias("n")).collect()
        }
        return original(df, right, keys, how, extra)

    grouping._join_on = spy
    try:
        grouping._attach(skewed, groups, groups, ["unit"], "left", ["key"], 0).count()
    finally:
        grouping._join_on = original
    assert seen["salts"]["hot"] > 500
    assert seen["salts"]["u1"] == 1


def test_parts_grow_with_the_data(spark):
    """Ten times the rows make ten times the parts, so that the largest part stays as it is."""
    largest = []
    for n in (4000, 40_000):
        rows = spark.range(n).select(F.col("id").alias("key"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("unit"))
        groups = grouping.group_figures(rows, ["unit"], {"top": F.max("key")})
        _, parts = grouping.hot_groups(groups, ["unit"], 200)
        part = F.coalesce(F.pmod(F.xxhash64("key"), parts.cast("bigint")), F.lit(0))
        largest.append(rows.groupBy("unit", part.alias("p")).count().agg(F.max("count")).first()[0])
    assert largest[1] < 1.5 * largest[0] and largest[1] < 400


def test_figures_and_hot_keys_share_one_aggregation(spark):
    from canvass.catalog import QUERIES

    df = QUERIES["latest_visit"](spark, SF_DIR)
    df.collect()
    assert plan(df).split("Initial Plan")[0].count("ReusedExchange") >= 1


def test_many_groups_fall_back_to_the_salted_join(skewed):
    figures = {"mu": F.avg("code")}
    few = grouping.attach_small(skewed, ["unit"], figures, spread_by=["key"])
    many = grouping.attach_small(skewed, ["unit"], figures, spread_by=["key"], max_rows=5)
    assert "element_at" not in plan(few) and "element_at" in plan(many)
    pick = lambda df: {r["key"]: r["mu"] for r in df.select("key", "mu").collect()}
    assert pick(few) == pick(many)


def test_small_copy_is_bounded(spark):
    assert grouping.small_copy(spark.range(11), 10) is None
    assert grouping.small_copy(spark.range(10), 10).count() == 10


def test_latest_limits_groups_before_the_shuffle(spark):
    text = plan(QUERIES["latest_visit_only"](spark, SF_DIR))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_group_figures_come_back_by_broadcast(spark):
    for name in ("duration_flags", "numeric_outliers", "nsnr_flags"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Window" not in text


def test_detail_texts_need_no_shuffle(spark):
    from canvass.plans import reports as rp
    from canvass.plans.survey import Survey

    rows = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    flags = {
        f: F.lit(1)
        for f in (
            "flag_geofencing flag_duration_outlier flag_garbage_text flag_nsnr flag_extreme_values "
            "flag_duplicated flag_missing audit_alert"
        ).split()
    }
    texts = "garbage_detail nsnr_detail outlier_detail identity missing_detail".split()
    s = Survey()
    roles = (s.key, s.started, s.supervisor, s.agent, s.interviewer, s.block, s.unit)
    df = rows.withColumns(
        {
            **flags,
            **{t: F.col("o_orderstatus") for t in texts},
            **{c: F.col("o_orderkey") for c in roles},
            "category": F.lit("EFECTIVA"),
            "distance_m": F.col("o_totalprice"),
            "duration_min": F.col("o_totalprice"),
        }
    )
    assert "Exchange" not in plan(rp.alert_table(df, s))


def test_scans_read_only_what_is_used(spark):
    text = plan(QUERIES["final_status_per_unit"](spark, SF_DIR))
    read = re.search(r"FileScan parquet \[([^]]*)\]", text).group(1)
    assert "o_custkey" in read and "o_orderstatus" not in read
    kept = plan(QUERIES["whitelist"](spark, SF_DIR))
    assert "EqualTo(toxic,1)" in kept


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_time_slices_never_reorder(spark):
    """Visits around midnight and at equal times keep their order."""
    start = datetime(2026, 1, 1, 23, 59, 58)
    rows = [(i, "u", start + timedelta(seconds=i // 2)) for i in range(10)] + [(10, "u", None)]
    df = spark.createDataFrame(rows, "key long, unit string, ts timestamp")
    out = visits.number_attempts(df, "unit", "ts", "key", hot_rows=0).orderBy("key")
    assert [r["attempt"] for r in out.collect()] == list(range(1, 12))


def test_outlier_figures_match_brute_force(spark):
    rows = [(i, f"g{i % 3}", float((i * 37) % 101)) for i in range(300)] + [(999, "g0", 5000.0)]
    df = spark.createDataFrame(rows, "key long, g string, a double")
    out = {r["key"]: r["ex_a"] for r in outliers.flag_outliers(df, "g", ["a"], "key").collect()}
    groups = defaultdict(list)
    for _, g, a in rows:
        if a not in (-1, 98, 99):
            groups[g].append(a)
    for key, g, a in rows:
        v = groups[g]
        mu = sum(v) / len(v)
        sd = (sum((x - mu) ** 2 for x in v) / (len(v) - 1)) ** 0.5
        assert out[key] == int(abs(a - mu) > 3 * sd)
