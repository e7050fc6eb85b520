"""Duration, numeric and don't-know/no-answer alerts against the figures of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.functions.columns import as_column, present, row_count, row_sum
from canvass.functions.numbers import (
    SENTINELS,
    at_least,
    flag,
    is_sentinel_text,
    number,
    percent,
    without_sentinels,
)
from canvass.functions.rules import first_match
from canvass.operators.grouping import attach_small

# Texts of the duration label.
SHORT, LONG, NORMAL = "Tiempo corto", "Tiempo excesivo", "Normal"


def _moments(value: Column, name: str) -> dict[str, Column]:
    return {f"__mu_{name}": F.avg(value), f"__sd_{name}": F.stddev_samp(value)}


def duration_figures(duration: str) -> dict[str, Column]:
    return _moments(as_column(duration), "duration")


def duration_flags(df: DataFrame, duration: str, *, k_low: float = 3, k_high: float = 5) -> DataFrame:
    """Short/long flags from figures already attached."""
    value = as_column(duration)
    low = F.col("__mu_duration") - k_low * F.col("__sd_duration")
    high = F.col("__mu_duration") + k_high * F.col("__sd_duration")
    short, long = flag(value < low), flag(value > high)
    return df.withColumns(
        {
            "group_mean": F.col("__mu_duration"),
            "group_sd": F.col("__sd_duration"),
            "threshold_short": low,
            "threshold_long": high,
            "alert_short": short,
            # a row is labelled once, and short comes first
            "alert_long": F.when(short == 1, 0).otherwise(long),
            "duration_alert": first_match([(short == 1, SHORT), (long == 1, LONG)], NORMAL),
        }
    ).drop("__mu_duration", "__sd_duration")


def outlier_figures(names: Sequence[str], sentinels: Sequence[float] = SENTINELS) -> dict[str, Column]:
    figures: dict[str, Column] = {}
    for name in names:
        figures |= _moments(without_sentinels(name, sentinels), name)
    return figures


def outlier_flags(
    df: DataFrame,
    names: Sequence[str],
    *,
    k: float = 3,
    test: str = "raw",
    sentinels: Sequence[float] = SENTINELS,
) -> DataFrame:
    """``ex_*`` flags and ``mu_*`` means per column from figures already attached.

    The tested value is the raw one, sentinel codes included, unless ``test="clean"``.
    An unknown value gives an unknown flag when the group has a spread, 0 when it has none.
    """
    new: dict[str, Column] = {}
    for name in names:
        mu, sd = F.col(f"`__mu_{name}`"), F.col(f"`__sd_{name}`")
        value = number(name) if test == "raw" else without_sentinels(name, sentinels)
        spread = sd.isNotNull() & (sd > 0)
        far = (F.abs(value - mu) > k * sd) & (value != mu)
        new[f"ex_{name}"] = F.when(spread, far.cast("int")).otherwise(F.lit(0))
        new[f"mu_{name}"] = mu
    out = df.withColumns(new).drop(*[f"__{p}_{n}" for n in names for p in ("mu", "sd")])
    total = row_sum([f"ex_{n}" for n in names])
    return out.withColumns({"total_extremes": total, "flag_extreme_values": flag(total > 0)})


def nsnr_counts(
    df: DataFrame, names: Sequence[str], *, sentinels: Sequence[int] = SENTINELS, trim: bool = True
) -> DataFrame:
    """Don't-know/no-answer count, answered count and rate in percent over a column list."""
    have = present(df, names)
    total = row_count([is_sentinel_text(n, sentinels, trim) for n in have])
    seen = row_count([as_column(n).isNotNull() for n in have])
    rate = F.when(seen > 0, total / seen * 100).otherwise(F.lit(0.0))
    return df.withColumns({"total_nsnr": total, "questions_seen": seen, "nsnr_rate": rate})


def nsnr_figures() -> dict[str, Column]:
    return _moments(F.col("total_nsnr"), "nsnr")


def nsnr_flags(
    df: DataFrame, *, k: float = 5, floor: float = 5, min_count: int = 4, use_dynamic: bool = False
) -> DataFrame:
    """Excess flag: a fixed count by default, the group threshold with ``use_dynamic``."""
    threshold = at_least(F.col("__mu_nsnr") + k * F.col("__sd_nsnr"), floor)
    limit = threshold if use_dynamic else F.lit(min_count)
    return df.withColumns(
        {
            "mu_nsnr": F.col("__mu_nsnr"),
            "sd_nsnr": F.col("__sd_nsnr"),
            "nsnr_threshold": threshold,
            "alert_nsnr": flag(F.col("total_nsnr") >= limit),
        }
    ).drop("__mu_nsnr", "__sd_nsnr")


def flag_durations(
    df: DataFrame, group: str, duration: str, key: str, *, k_low: float = 3, k_high: float = 5
) -> DataFrame:
    """Duration alerts against mean and standard deviation of the row's group."""
    joined = attach_small(df, [group], duration_figures(duration), spread_by=[key])
    return duration_flags(joined, duration, k_low=k_low, k_high=k_high)


def flag_outliers(
    df: DataFrame,
    group: str,
    names: Sequence[str],
    key: str,
    *,
    k: float = 3,
    test: str = "raw",
    sentinels: Sequence[float] = SENTINELS,
) -> DataFrame:
    """Numeric outliers of many columns; all figures come from one aggregation."""
    have = present(df, names)
    joined = attach_small(df, [group], outlier_figures(have, sentinels), spread_by=[key])
    return outlier_flags(joined, have, k=k, test=test, sentinels=sentinels)


def flag_nsnr(
    df: DataFrame,
    group: str,
    names: Sequence[str],
    key: str,
    *,
    k: float = 5,
    floor: float = 5,
    min_count: int = 4,
    use_dynamic: bool = False,
    sentinels: Sequence[int] = SENTINELS,
) -> DataFrame:
    """Don't-know/no-answer excess per row."""
    counted = nsnr_counts(df, names, sentinels=sentinels)
    joined = attach_small(counted, [group], nsnr_figures(), spread_by=[key])
    return nsnr_flags(joined, k=k, floor=floor, min_count=min_count, use_dynamic=use_dynamic)


def _top_agent(long: DataFrame) -> DataFrame:
    """Per question the agent with the highest ``n``; ties go to the first agent in order."""
    w = Window.partitionBy("question").orderBy(F.desc("n"), F.col("agent").asc_nulls_last())
    return long.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def _per_question(df: DataFrame, names: Sequence[str], agent: str, measure) -> DataFrame:
    """One row per (question, agent) with ``measure`` counted before any reshaping.

    All questions are counted in one aggregation by agent; only its small result is turned
    long, so the answers themselves are never multiplied by the number of questions.
    """
    wide = df.groupBy(as_column(agent).alias("agent")).agg(
        F.count(F.lit(1)).alias("__rows"), *[measure(n).alias(n) for n in names]
    )
    return wide.unpivot(["agent", "__rows"], list(names), "question", "n")


def question_outlier_summary(
    df: DataFrame,
    names: Sequence[str],
    agent: str,
    *,
    k: float = 3,
    sentinels: Sequence[float] = SENTINELS,
    digits: int = 2,
) -> DataFrame:
    """Per question: mean, minimum, maximum, outliers, and the agent with most of them.

    Here the figures run over all given rows, not per group as in ``flag_outliers``.
    """
    have = present(df, names)
    clean = df.select(as_column(agent), *[without_sentinels(n, sentinels).alias(n) for n in have])
    figures = clean.agg(
        *[
            F.struct(
                F.avg(n).alias("mean"),
                F.stddev_samp(n).alias("sd"),
                F.min(n).alias("lo"),
                F.max(n).alias("hi"),
            ).alias(n)
            for n in have
        ]
    )
    one_row = figures.select(F.struct(*have)).scalar()

    def outliers(name: str) -> Column:
        mu, sd = one_row[name]["mean"], one_row[name]["sd"]
        return F.count_if(F.abs(as_column(name) - mu) > k * sd)

    by_agent = _per_question(clean, have, agent, outliers)
    totals = by_agent.groupBy("question").agg(F.sum("n").alias("outliers"))
    top = _top_agent(by_agent)
    per_question = figures.unpivot([], have, "question", "s")
    return (
        per_question.join(totals, "question", "left")
        .join(top.select("question", "agent", "n"), "question", "left")
        .select(
            "question",
            F.round("s.mean", digits).alias("mean"),
            F.col("s.lo").alias("minimum"),
            F.col("s.hi").alias("maximum"),
            F.when((F.col("n") > 0) & (F.col("s.sd") > 0), F.col("agent")).alias("top_agent"),
            F.coalesce("outliers", F.lit(0)).alias("outliers"),
        )
    )


def question_nsnr_summary(
    df: DataFrame,
    names: Sequence[str],
    agent: str,
    *,
    sentinels: Sequence[int] = SENTINELS,
    digits: int = 2,
) -> DataFrame:
    """Per question: rows, don't-know/no-answer count, rate, top agent and its count."""
    have = present(df, names)
    by_agent = _per_question(
        df, have, agent, lambda n: F.count_if(is_sentinel_text(n, sentinels))
    )
    totals = by_agent.groupBy("question").agg(
        F.sum("__rows").alias("surveys"), F.sum("n").alias("total_nsnr")
    )
    top = _top_agent(by_agent)
    return totals.join(top.select("question", "agent", "n"), "question", "left").select(
        "question",
        "surveys",
        "total_nsnr",
        percent("total_nsnr", "surveys", digits).alias("incidence_rate"),
        F.when(F.col("n") > 0, F.col("agent")).alias("top_agent"),
        F.coalesce("n", F.lit(0)).alias("top_agent_count"),
    )
